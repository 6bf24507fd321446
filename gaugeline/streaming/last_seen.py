"""Health of a growing table from state: each fact is read once, by the micro-batch that brings it.

The state has two tables, both in folders named by the micro-batch, so that a repeated one replaces what it had written.
``newest`` holds the newest processing time per way to select and key, a row per key however long the history is; each
micro-batch merges its own into that of the one before. ``points`` holds what the micro-batches added: counts per
key, hour and distinct time, which add up over micro-batches whatever their order, so a refresh sums the folders that reach
into the last 24 hours. The time range of each folder is kept beside it, in ``reach``; folders that have left the window are not
opened, and `forget` removes them.

A way to select that the configuration names for the first time starts to count with the micro-batch at hand; give
``whole``, the table so far, and its newest records are looked up there once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import rolling_window, utc
from ..operators.config import DEFAULT_PROCESSING_TS, DEFAULT_TS, FactSource, asked_of, connection_predicate, discover_sources, keyed
from ..operators.metrics import POINTS, _configured, _ingestion_delay, _own_delay, per_bucket, per_connection, per_time
from ..operators.rollup import any_null
from ..operators.status import status_of_facts

KEY = ["match_on", "match_key"]
REACH = "newest timestamp, ways array<string>"
POINT_SUMS = {"_points": F.sum, "_nulls": F.sum, "_newest": F.max, "_delay_sum_0": F.sum, "_delay_n_0": F.sum, "_delay_max_0": F.max}


def _reach(spark: SparkSession, state: str, before: int) -> dict[int, tuple[datetime | None, list[str]]]:
    """Per earlier micro-batch its newest time, in microseconds, and the ways to select that were known; one small row for each."""
    if not before:
        return {}
    schema = f"{REACH}, batch bigint"
    rows = spark.read.schema(schema).parquet(f"{state}/reach").filter(F.col("batch") < before)
    return {r["batch"]: (r["micros"], r["ways"]) for r in rows.select("batch", "ways", F.unix_micros("newest").alias("micros")).collect()}


def _source(config: DataFrame, facts: DataFrame, table: str, ts: str, processing_ts: str) -> FactSource:
    found = [s for s in discover_sources(config, {table: facts}) if s.table == table and s.ts == ts]
    ways = found[0] if found else FactSource(table, facts, ts, key_sets=())
    return FactSource(table, facts, ts, processing_ts, ways.key_sets, ways.clauses)


def _added(source: FactSource, critical_cols: Sequence[str], ingestion_ts: str) -> DataFrame:
    """What a micro-batch adds, per way to select, key, hour and time."""
    proc = F.col(source.processing_ts)
    rows = source.frame.filter(proc.isNotNull())
    delays = _ingestion_delay(source, ingestion_ts) or [F.lit(None)]
    each = per_time(source, rows, F.date_trunc("hour", proc), F.col(source.ts), proc, delays, any_null(rows, critical_cols))
    return keyed(each, source).select(*KEY, "_bucket", "_at", *POINT_SUMS)


def stream_health_from_state(
    facts: DataFrame,
    config: Callable[[], DataFrame],
    table: str,
    path: str,
    state: str,
    checkpoint: str,
    ts: str = DEFAULT_TS,
    processing_ts: str = DEFAULT_PROCESSING_TS,
    every: str | None = "15 minutes",
    critical_cols: Sequence[str] = (),
    ingestion_ts: str = "ingestionTimestamp",
    delayed_days: float = 0,
    offline_days: float = 1,
    whole: Callable[[], DataFrame] | None = None,
):
    """Start a query that adds a status record per connection for every micro-batch of ``facts``, the stream of the table itself.

    The records are those of `streaming_status` over the whole table, one second after the newest processing time seen so
    far, for connections of ``table`` with the time column ``ts``. A micro-batch without a processing time is no refresh.
    """

    def refresh(batch: DataFrame, batch_id: int) -> None:
        spark, connections = batch.sparkSession, config()
        matched = connection_predicate(connections)
        source = _source(connections, batch, table, ts, processing_ts)
        earlier = _reach(spark, state, batch_id)
        added_at = f"{state}/points/batch={batch_id}"
        if source.answers:
            _added(source, critical_cols, ingestion_ts).write.mode("overwrite").parquet(added_at)
        else:  # no connection of this table yet
            schema = "match_on string, match_key string, _bucket timestamp, _at timestamp, _points bigint, _nulls bigint, _newest timestamp, " \
                     "_delay_sum_0 double, _delay_n_0 bigint, _delay_max_0 double"
            spark.createDataFrame([], schema).write.mode("overwrite").parquet(added_at)
        added = spark.read.parquet(added_at)
        # Every fact is under some key of a key set; clauses may leave facts out.
        newest_fact = added.agg(F.max("_newest").alias("t")) if source.key_sets else batch.agg(F.max(processing_ts).alias("t"))
        moment = newest_fact.select(F.unix_micros("t")).first()[0]
        newest = added.groupBy(*KEY).agg(F.max("_newest").alias("_newest"))
        if batch_id:
            newest = newest.unionByName(spark.read.parquet(f"{state}/newest/batch={batch_id - 1}"))
        known = {w for _, ways in earlier.values() for w in ways}
        unknown = [a for a in source.answers if a not in known]
        if earlier and unknown and whole is not None:
            keys = tuple(k for k in source.key_sets if ",".join(k) in unknown)
            clauses = tuple(c for c in source.clauses if f"clause:{c}" in unknown)
            past = FactSource(table, whole(), ts, processing_ts, keys, clauses)
            seen = past.selected(past.frame, _newest=F.col(processing_ts)).groupBy("_set", *past.key_columns).agg(F.max("_newest").alias("_newest"))
            newest = newest.unionByName(keyed(seen, past))
        newest = newest.groupBy(*KEY).agg(F.max("_newest").alias("_newest"))
        newest.write.mode("overwrite").parquet(f"{state}/newest/batch={batch_id}")
        newest = spark.read.schema(newest.schema).parquet(f"{state}/newest/batch={batch_id}")
        so_far = [m for m in [moment, *(m for m, _ in earlier.values())] if m is not None]
        # The ways known after this micro-batch, and how far its records reach: the mark that it is part of the state.
        spark.createDataFrame([(moment, sorted(known | set(source.answers)))], "micros bigint, ways array<string>").select(
            F.timestamp_micros("micros").alias("newest"), "ways").write.mode("overwrite").parquet(f"{state}/reach/batch={batch_id}")
        if not so_far:
            return
        now = utc("1970-01-01") + timedelta(microseconds=max(so_far) + 1_000_000)
        start, end = rolling_window(now)
        floor = int((start - utc("1970-01-01")).total_seconds()) * 1_000_000
        live = [f"{state}/points/batch={b}" for b, (m, _) in earlier.items() if m is not None and m >= floor] + [added_at]
        points = spark.read.schema(added.schema).parquet(*live).filter((F.col("_bucket") >= F.lit(start)) & (F.col("_bucket") < F.lit(end)))
        each = points.groupBy(*KEY, "_bucket", "_at").agg(*[how(c).alias(c) for c, how in POINT_SUMS.items()])
        hours = per_bucket(each, KEY, 1)
        nothing = {c: F.lit(None).cast(t) for c, t in hours.dtypes if c not in (*KEY, "_newest")}
        rows = hours.unionByName(newest.withColumns(nothing).select(*hours.columns))
        asked = asked_of(_configured(matched), source)
        found = _own_delay(asked.join(rows, KEY), [None]).select(
            "connection_id", "expected_interval_minutes", "_bucket", *POINTS, "_first", "_last", "_newest")
        status = status_of_facts(matched, [source], per_connection(found, start, True), now, f"refresh-{batch_id}", delayed_days, offline_days)
        status.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = facts.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def forget(spark: SparkSession, state: str) -> list[int]:
    """Remove the folders of ``points`` that no later refresh can need, and of ``newest`` but the last two. Returns the micro-batches."""
    marks = spark.read.schema(f"{REACH}, batch bigint").parquet(f"{state}/reach").select("batch", F.unix_micros("newest").alias("m")).collect()
    so_far = [r["m"] for r in marks if r["m"] is not None]
    if not so_far:
        return []
    start, _ = rolling_window(utc("1970-01-01") + timedelta(microseconds=max(so_far) + 1_000_000))
    floor, last = int((start - utc("1970-01-01")).total_seconds()) * 1_000_000, max(r["batch"] for r in marks)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(state).getFileSystem(spark._jsc.hadoopConfiguration())
    gone = sorted(r["batch"] for r in marks if r["batch"] < last - 1 and (r["m"] is None or r["m"] < floor))
    for batch in gone:
        fs.delete(path(f"{state}/points/batch={batch}"), True)
    for batch in sorted(r["batch"] for r in marks if r["batch"] < last - 1):
        fs.delete(path(f"{state}/newest/batch={batch}"), True)
    return gone
