"""Connection configuration: building it, selecting from it, matching it to facts."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from functools import reduce

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import ts_lit, utc
from ..schemas import CONNECTION_CONFIG, struct

PART = "\u001f"
DEFAULT_TS = "timestamp"
DEFAULT_PROCESSING_TS = "gold_processing_timestamp"


@dataclass(frozen=True)
class ConnectionTemplate:
    """How a dimension row becomes a connection.

    ``id_format`` is filled with the text of ``id_cols``; ``fixed`` holds constant config
    columns; ``columns`` maps config columns to expressions over the dimension; ``key`` is
    the surrogate key column of dimension and fact; ``metadata`` lists further columns
    (as text) for the JSON attributes.
    """

    id_format: str
    id_cols: Sequence[str]
    key: str
    fixed: dict[str, object]
    columns: dict[str, Column] = field(default_factory=dict)
    metadata: Sequence[str] = ()
    ts_col: str = DEFAULT_TS


def build_connection_config(dim: DataFrame, template: ConnectionTemplate, now: datetime | str) -> DataFrame:
    """One configuration row per dimension row."""
    attributes = F.to_json(F.struct(
        F.col(template.key),
        *[F.col(c).cast("string").alias(c) for c in template.metadata],
        F.lit(template.ts_col).alias("timestamp_col"),
        F.format_string(f"{template.key} = '%s'", F.col(template.key)).alias("filter_clause"),
    ))
    made = {
        "connection_id": F.format_string(template.id_format, *[F.col(c).cast("string") for c in template.id_cols]),
        "other_metadata": attributes,
        "created_at": ts_lit(now),
        "updated_at": ts_lit(now),
        **{k: F.lit(v) for k, v in template.fixed.items()},
        **template.columns,
    }
    return dim.select(*[
        made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in struct(CONNECTION_CONFIG).fields
    ])


def select_connections(
    config: DataFrame, connection_id: str | None = None, connector: str | None = None
) -> DataFrame:
    """One connection, or all of a connector; the id wins when both are given."""
    if connection_id:
        return config.filter(F.col("connection_id") == connection_id)
    if connector:
        return config.filter(F.col("connector") == connector)
    raise ValueError("give a connection_id or a connector")


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Return ``df`` or raise when it is empty (runs one small job)."""
    if df.isEmpty():
        raise ValueError(f"no configuration found for {what}")
    return df


def meter_status(config: DataFrame) -> Column:
    return F.get_json_object(config["other_metadata"], "$.meterStatus")


def active_only(config: DataFrame, missing_is_active: bool = False) -> DataFrame:
    """Connections whose attributes say they are active; what a missing mark means is a choice."""
    status = meter_status(config)
    return config.filter(F.coalesce(status == "active", F.lit(missing_is_active)))


def config_counts(config: DataFrame, missing_is_active: bool = False) -> DataFrame:
    """Connections per connector, active and inactive."""
    active = F.coalesce(meter_status(config) == "active", F.lit(missing_is_active))
    return config.groupBy("connector").agg(
        F.count(F.lit(1)).alias("connections"),
        F.count_if(active).alias("active"),
        F.count_if(~active).alias("inactive"),
    )


def skip_already_checked(config: DataFrame, status: DataFrame, as_of: datetime | str) -> DataFrame:
    """Drop connections that have a status row on the (UTC) day of ``as_of``."""
    day = utc(as_of).replace(hour=0, minute=0, second=0, microsecond=0)
    today = status.filter(
        (F.col("checked_at") >= ts_lit(day)) & (F.col("checked_at") < ts_lit(day + timedelta(days=1)))
    )
    return config.join(today.select("connection_id"), "connection_id", "left_anti")


def connection_predicate(config: DataFrame) -> DataFrame:
    """Turn the JSON attributes into join columns.

    ``match_on`` names the fact columns (comma-joined), ``match_key`` holds their values.
    Precedence: ean with key, ean, building, free clause, none. A clause of the form
    ``column = 'value'``, or several of them tied by AND, becomes an equality of keys (columns by name), so that
    it costs no more than a key; any other is kept as ``clause:…``. Attributes that are not JSON give the defaults.
    """
    meta = F.from_json(
        "other_metadata",
        "ean string, key string, building_uuid string, filter_clause string, "
        "timestamp_col string, processing_timestamp_col string",
    ).alias("_meta")
    # As a generator the JSON is parsed once per connection, and later filters on what is
    # in it stay above, instead of being parsed again for every row the config comes from.
    parsed = config.select("*", F.inline(F.array(F.struct(meta))))

    def attr(name: str) -> Column:
        return F.nullif(F.col("_meta")[name], F.lit(""))

    ean, key, building, clause = (attr(n) for n in ("ean", "key", "building_uuid", "filter_clause"))
    one = r"(\w+)\s*=\s*'([^']*)'"
    columns, values = (F.regexp_extract_all(clause, F.lit(one), F.lit(i)) for i in (1, 2))
    pairs = F.array_sort(F.arrays_zip(columns.alias("c"), values.alias("v")))
    tied = clause.rlike(rf"(?i)^\s*{one}(\s+and\s+{one})*\s*$") & (F.size(F.array_distinct(columns)) == F.size(columns))
    column = F.when(tied, F.array_join(F.transform(pairs, lambda p: p["c"]), ","))
    match_on = (
        F.when(ean.isNotNull() & key.isNotNull(), "ean,key")
        .when(ean.isNotNull(), "ean")
        .when(building.isNotNull(), "building_uuid")
        .when(column.isNotNull(), column)
        .when(clause.isNotNull(), F.concat(F.lit("clause:"), clause))
        .otherwise("")
    )
    match_key = (
        F.when(ean.isNotNull() & key.isNotNull(), F.concat(ean, F.lit(PART), key))
        .when(ean.isNotNull(), ean)
        .when(building.isNotNull(), building)
        .when(column.isNotNull(), F.array_join(F.transform(pairs, lambda p: p["v"]), PART))
        .otherwise("")
    )
    return parsed.withColumns({
        "match_on": match_on,
        "match_key": match_key,
        "ts_col": F.coalesce(F.col("_meta.timestamp_col"), F.lit(DEFAULT_TS)),
        "processing_ts_col": F.coalesce(F.col("_meta.processing_timestamp_col"), F.lit(DEFAULT_PROCESSING_TS)),
    }).drop("_meta")


@contextmanager
def _lenient(spark: SparkSession) -> Iterator[None]:
    """What is resolved in here gives NULL where it cannot be evaluated, instead of ending the job."""
    name = "spark.sql.ansi.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@dataclass(frozen=True)
class FactSource:
    """A fact table that connections refer to by name.

    ``key_sets`` lists the column sets that predicates may use, ``()`` for connections that
    own the whole table; ``clauses`` lists free clauses. ``discover_sources`` finds both in a configuration.
    ``date_col`` is the event date that the table is partitioned by. ``frame`` is None when the table does not
    exist, or when it cannot be read: then ``error`` says why. ``other_processing_ts`` are further processing
    columns that connections name; delays of all of them come from the same scan.
    """

    table: str
    frame: DataFrame | None
    ts: str = DEFAULT_TS
    processing_ts: str = DEFAULT_PROCESSING_TS
    key_sets: Sequence[Sequence[str]] = (("sk",),)
    clauses: Sequence[str] = ()
    date_col: str | None = None
    other_processing_ts: Sequence[str] = ()
    error: str | None = None

    @property
    def has_processing_ts(self) -> bool:
        return self.frame is not None and self.processing_ts in self.frame.columns

    @property
    def processing(self) -> list[str]:
        """The processing columns that the table has."""
        columns = self.frame.columns if self.frame is not None else []
        return [c for c in dict.fromkeys((self.processing_ts, *self.other_processing_ts)) if c in columns]

    @property
    def answers(self) -> list[str]:
        """The values of ``match_on`` that the source can answer; their places number the selections."""
        return [",".join(keys) for keys in self.key_sets] + [f"clause:{c}" for c in self.clauses]

    @property
    def key_columns(self) -> list[str]:
        return list(dict.fromkeys(c for keys in self.key_sets for c in keys))

    def selected(self, rows: DataFrame, **columns: Column) -> DataFrame:
        """The given columns of ``rows``, once for every way to select them: ``_set`` numbers it, and key columns that it
        does not use are NULL. However many selections there are, the rows are scanned once.

        A row on which a clause cannot be evaluated does not fulfil it.
        """
        names, sets = self.key_columns, list(self.key_sets)
        if self.clauses:
            with _lenient(rows.sparkSession):
                held = [F.when(F.expr(c), F.lit(len(sets) + i)) for i, c in enumerate(self.clauses)]
                rows = rows.withColumn("_held", F.filter(F.array(*held), lambda n: n.isNotNull()))
        plain = F.array(*map(F.lit, range(len(sets)))).cast("array<int>")
        if len(sets) == 1 and not self.clauses:
            number = F.lit(0)
        else:
            number = F.explode(F.concat(plain, "_held") if self.clauses else plain)
        picked = rows.select(*names, *[c.alias(n) for n, c in columns.items()], number.alias("_set"))
        own = {c: [i for i, keys in enumerate(sets) if c in keys] for c in names}
        return picked.withColumns({c: F.when(F.col("_set").isin(where), F.col(c)) for c, where in own.items() if len(where) < len(self.answers)})


def _all_hold(frame: DataFrame, clauses: Sequence[str]) -> bool:
    """Whether all clauses are conditions on the rows of the table."""
    log = logging.getLogger("SQLQueryContextLogger")  # a bad clause becomes an error record, not a page of log
    before, log.disabled = log.disabled, True
    try:
        with _lenient(frame.sparkSession):
            frame.filter(reduce(lambda a, b: a & b, map(F.expr, clauses)))
        return True
    except AnalysisException:
        return False
    finally:
        log.disabled = before


def usable_clauses(frame: DataFrame, clauses: Sequence[str]) -> list[str]:
    """The clauses that Spark can resolve on the table. All are tried at once first, as most configurations have no bad one."""
    empty = frame.sparkSession.createDataFrame([], frame.schema)
    if not clauses or _all_hold(empty, clauses):
        return list(clauses)
    return [c for c in clauses if _all_hold(empty, [c])]


def discover_sources(
    config: DataFrame,
    tables: Mapping[str, DataFrame | Callable[[], DataFrame] | None],
    date_cols: Mapping[str, str] | None = None,
) -> list[FactSource]:
    """A source per table and time column of the configuration, with all key sets and clauses that its connections use.

    ``tables`` maps names to tables, or to functions that open them; a table that is missing or NULL does not exist, one that
    cannot be opened becomes a source with its error. What a table cannot answer (unknown columns, clauses that are no
    condition) is left out, and its connections alone become errors. The driver sees the distinct ways to select, not the connections.
    """
    wanted = connection_predicate(config).select("gold_table_name", "ts_col", "processing_ts_col", "match_on").distinct().collect()
    opened: dict[str, tuple[DataFrame | None, str | None]] = {}
    out = []
    for table, ts in sorted({(r["gold_table_name"], r["ts_col"]) for r in wanted if r["gold_table_name"] is not None}):
        if table not in opened:
            given = tables.get(table)
            try:
                opened[table] = (given() if callable(given) else given), None
            except PySparkException as wrong:
                opened[table] = None, str(wrong)
        frame, error = opened[table]
        if frame is None:
            out.append(FactSource(table, None, ts, error=error))
            continue
        if ts not in frame.columns:
            continue
        mine = [r for r in wanted if (r["gold_table_name"], r["ts_col"]) == (table, ts)]
        ways = sorted({r["match_on"] for r in mine})
        keys = [tuple(w.split(",")) if w else () for w in ways if not w.startswith("clause:")]
        processing = sorted({r["processing_ts_col"] for r in mine}, key=lambda c: (c != DEFAULT_PROCESSING_TS, c))
        out.append(FactSource(
            table, frame, ts, processing[0],
            key_sets=tuple(k for k in keys if set(k) <= set(frame.columns)),
            clauses=tuple(usable_clauses(frame, [w.removeprefix("clause:") for w in ways if w.startswith("clause:")])),
            date_col=(date_cols or {}).get(table), other_processing_ts=tuple(processing[1:]),
        ))
    return out


def distinct_sources(sources: Sequence[FactSource]) -> Sequence[FactSource]:
    """The sources, if no table is given twice for one time column: its records would count twice."""
    pairs = [(s.table, s.ts) for s in sources]
    twice = sorted({p for p in pairs if pairs.count(p) > 1})
    if twice:
        raise ValueError(f"fact tables given more than once for a time column: {twice}")
    return sources


def answered(sources: Sequence[FactSource]) -> Column:
    """Whether one of the sources can match a connection of ``connection_predicate``."""
    out = F.lit(False)
    for s in sources:
        if s.frame is not None:
            out = out | ((F.col("gold_table_name") == s.table) & (F.col("ts_col") == s.ts) & F.col("match_on").isin(s.answers))
    return F.coalesce(out, F.lit(False))


def match_connections(aggregated: DataFrame, config: DataFrame, source: FactSource) -> DataFrame:
    """Join facts, already reduced per selection and key, to the connections that select them.

    Aggregating first keeps a hot key away from the join: it meets the configuration
    as a handful of rows. Spark broadcasts the smaller side only if its size allows.
    """
    return asked_of(config, source).join(keyed(aggregated, source), ["match_on", "match_key"])


def keyed(aggregated: DataFrame, source: FactSource) -> DataFrame:
    """``match_on`` and ``match_key`` in place of the selection and its key columns."""
    number = F.col("_set")
    key = F.when(number >= len(source.key_sets), F.lit(""))
    for i, keys in enumerate(source.key_sets):
        parts = [x for c in keys for x in (F.lit(PART), F.col(c).cast("string"))]
        key = F.when(number == i, F.concat(*parts[1:]) if keys else F.lit("")).otherwise(key)
    name = F.element_at(F.array(*map(F.lit, source.answers)), number + 1)
    return aggregated.withColumns({"match_on": name, "match_key": key}).drop("_set", *source.key_columns)


def asked_of(config: DataFrame, source: FactSource) -> DataFrame:
    """The connections of ``connection_predicate`` that ask this source, their keys in the types of its columns."""
    types = {c: source.frame.schema[c].dataType for c in source.key_columns}
    asked = F.col("match_key")
    for keys in source.key_sets:
        if keys:  # as SQL compares: '007' is the number 7 for a column of numbers
            given = F.split("match_key", PART)
            typed = [x for j, c in enumerate(keys) for x in (F.lit(PART), F.get(given, j).try_cast(types[c]).cast("string"))]
            asked = F.when(F.col("match_on") == ",".join(keys), F.concat(*typed[1:])).otherwise(asked)
    mine = (F.col("gold_table_name") == source.table) & (F.col("ts_col") == source.ts)
    return config.filter(mine).withColumn("match_key", asked)
