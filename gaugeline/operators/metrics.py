"""Completeness, duplicates, delay and uptime of connections per hour or day."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.health import DAILY_MINUTES, HOUR_FIELDS, completeness_pct, expected_per_hour, uptime_pct
from ..functions.time import DEFAULT_ZONE, local_day_bounds, minutes_between, rolling_window, since, ts_lit, utc, within
from .config import FactSource, match_connections
from .rollup import any_null

POINTS = ("_points", "_distinct", "_nulls", "_delay_sum", "_delay_n", "_delay_max")
STRETCH_SECONDS = 90  # divides an hour; shorter than one and a half of the shortest interval


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def reduced(
    source: FactSource, rows: DataFrame, bucket: Column, at: Column, newest: Column,
    delays: Sequence[Column] = (), nulls: Column | None = None,
) -> DataFrame:
    """One scan of ``rows``, reduced per selection, key and bucket: counts, delay sums per processing column, first and last
    ``at`` and the newest record.

    First per distinct ``at``, which spreads a key with most of the rows over the tasks and counts distinct times on
    the way; then per bucket.
    """
    return per_bucket(per_time(source, rows, bucket, at, newest, delays, nulls), ["_set", *source.key_columns], len(delays))


def per_time(
    source: FactSource, rows: DataFrame, bucket: Column, at: Column, newest: Column,
    delays: Sequence[Column] = (), nulls: Column | None = None,
) -> DataFrame:
    """The first step of `reduced`: a row per selection, key, bucket and distinct ``at``."""
    keys = source.key_columns
    columns = {"_bucket": bucket, "_at": at, "_newest": newest, "_null": F.lit(False) if nulls is None else nulls,
               **{f"_delay_{i}": d.cast("double") for i, d in enumerate(delays)}}
    which = range(len(delays))
    return source.selected(rows, **columns).groupBy("_set", *keys, "_bucket", "_at").agg(
        F.count(F.lit(1)).alias("_points"), F.count_if("_null").alias("_nulls"), F.max("_newest").alias("_newest"),
        *[F.sum(f"_delay_{i}").alias(f"_delay_sum_{i}") for i in which], *[F.count(f"_delay_{i}").alias(f"_delay_n_{i}") for i in which],
        *[F.max(f"_delay_{i}").alias(f"_delay_max_{i}") for i in which])


def per_bucket(each: DataFrame, keys: Sequence[str], n_delays: int) -> DataFrame:
    """The second step of `reduced`; ``each`` may hold an ``_at`` once only."""
    which = range(n_delays)
    return each.groupBy(*keys, "_bucket").agg(
        F.sum("_points").alias("_points"), F.count("_at").alias("_distinct"), F.sum("_nulls").alias("_nulls"),
        F.min("_at").alias("_first"), F.max("_at").alias("_last"), F.max("_newest").alias("_newest"),
        *[F.sum(f"_delay_sum_{i}").alias(f"_delay_sum_{i}") for i in which], *[F.sum(f"_delay_n_{i}").alias(f"_delay_n_{i}") for i in which],
        *[F.max(f"_delay_max_{i}").alias(f"_delay_max_{i}") for i in which])


def _own_delay(matched: DataFrame, names: Sequence[str | None]) -> DataFrame:
    """The delay figures of the processing column that the connection names; ``None`` stands for any."""
    nothing = {"_delay_sum": "double", "_delay_n": "bigint", "_delay_max": "double"}
    return matched.withColumns({
        c: F.coalesce(F.lit(None).cast(t), *[
            F.when(F.lit(True) if n is None else F.col("processing_ts_col") == n, F.col(f"{c}_{i}")) for i, n in enumerate(names)])
        for c, t in nothing.items()
    })


def _finish(points: DataFrame, period: Column, expected: Column, delay_scale: int | None = None, more: Sequence[Column] = ()) -> DataFrame:
    """Hour rows of the published struct from summed points, and ``more`` aggregates. Rows without a period have no figures."""

    def delay(c: Column) -> Column:
        return c if delay_scale is None else F.bround(F.round(c, 9), delay_scale)

    interval = F.col("expected_interval_minutes")
    grouped = points.withColumns({"_period": period, "_expected": expected}).groupBy("connection_id", interval, "_expected", "_period")
    total = grouped.agg(*[(F.max(c) if c == "_delay_max" else F.sum(c)).alias(c) for c in POINTS], *more)
    kept = [c for c in total.columns if c not in ("connection_id", "expected_interval_minutes", "_expected", "_period", *POINTS)]
    values = {
        "hour": F.col("_period"),
        "data_points": F.col("_points"),
        "expected_records": F.col("_expected"),
        "completeness_pct": completeness_pct(F.col("_points"), F.col("_expected")),
        "duplicate_timestamps": F.col("_points") - F.col("_distinct"),
        "null_values": F.col("_nulls"),
        "avg_delay_minutes": delay(F.try_divide(F.col("_delay_sum"), F.col("_delay_n"))),
        "max_delay_minutes": delay(F.col("_delay_max")),
        "uptime_pct": uptime_pct(F.col("_points")),
        "total_validation_errors": F.col("_points") - F.col("_distinct") + F.col("_nulls"),
    }
    return total.select(
        "connection_id", interval,
        *[F.when(F.col("_period").isNotNull(), _int(values[n]) if t == "int" else values[n].cast(t)).alias(n) for n, t in HOUR_FIELDS], *kept
    )


def _ingestion_delay(source: FactSource, ingestion_ts: str) -> list[Column]:
    return [minutes_between(F.col(ingestion_ts), F.col(source.ts))] if ingestion_ts in source.frame.columns else []


def _as_list(sources: FactSource | Sequence[FactSource]) -> list[FactSource]:
    return [sources] if isinstance(sources, FactSource) else list(sources)


def _readable(sources: FactSource | Sequence[FactSource]) -> list[FactSource]:
    return [s for s in _as_list(sources) if s.frame is not None and s.answers]


def _same_columns(found: Sequence[DataFrame]) -> DataFrame:
    columns = ["connection_id", "expected_interval_minutes", "_bucket", *POINTS, "_first", "_last", "_newest"]
    return union_all([f.select(*columns) for f in found])


def _configured(interval_ok: DataFrame) -> DataFrame:
    return interval_ok.select(
        "connection_id", "gold_table_name", "expected_interval_minutes",
        "match_on", "match_key", "ts_col", "processing_ts_col",
    )


def period_metrics(
    sources: FactSource | Sequence[FactSource], config: DataFrame, as_of: datetime | str, zone: str = DEFAULT_ZONE
) -> DataFrame:
    """Hour rows of all connections for the previous local day, from one scan per fact table.

    Connections expected once a day or less often get a single row for the whole window,
    with one record expected. ``config`` comes from ``connection_predicate``.
    """
    start, end = local_day_bounds(as_of, zone)
    usable = _configured(config.filter(F.col("expected_interval_minutes") != 0))
    found = []
    for source in _readable(sources):
        ts = F.col(source.ts)
        points = reduced(
            source, source.frame.filter(within(source.ts, start, end, source.date_col)), F.date_trunc("hour", ts), ts, ts,
            [minutes_between(F.col(p), ts) for p in source.processing])
        found.append(_own_delay(match_connections(points, usable, source), source.processing))
    hour, daily = F.col("_bucket"), F.col("expected_interval_minutes") >= DAILY_MINUTES
    return _finish(
        _same_columns(found),
        F.when(daily, ts_lit(start)).otherwise(hour),
        F.when(daily, F.lit(1)).otherwise(expected_per_hour(F.col("expected_interval_minutes"))),
    )


def hourly_metrics(
    sources: FactSource | Sequence[FactSource],
    config: DataFrame,
    as_of: datetime | str,
    zone: str = DEFAULT_ZONE,
    dense_hours: bool = False,
) -> DataFrame:
    """Hours with data of the connections expected more than once a day.

    ``dense_hours`` adds the silent hours of the window with zero points, for
    connections with a positive interval.
    """
    below = config.filter(F.col("expected_interval_minutes") < DAILY_MINUTES)
    hours = period_metrics(sources, below, as_of, zone)
    if not dense_hours:
        return hours
    start, end = local_day_bounds(as_of, zone)
    spine = below.filter(F.col("expected_interval_minutes") > 0).select(
        "connection_id", "expected_interval_minutes",
        F.explode(F.sequence(
            ts_lit(start), ts_lit(end) - F.expr("INTERVAL 1 SECOND"), F.expr("INTERVAL 1 HOUR")
        )).alias("hour"),
    )
    filled = spine.join(hours.drop("expected_interval_minutes"), ["connection_id", "hour"], "left")
    zero = {
        n: F.coalesce(F.col(n), F.lit(0).cast(t))
        for n, t in HOUR_FIELDS if n not in ("hour", "expected_records", "avg_delay_minutes", "max_delay_minutes")
    }
    return filled.withColumns({
        **zero,
        "expected_records": expected_per_hour(F.col("expected_interval_minutes")),
    }).select(*hours.columns)


def daily_metrics(
    sources: FactSource | Sequence[FactSource], config: DataFrame, as_of: datetime | str, zone: str = DEFAULT_ZONE
) -> DataFrame:
    """One row for the window of the connections expected at most once a day."""
    daily = config.filter(F.col("expected_interval_minutes") >= DAILY_MINUTES)
    return period_metrics(sources, daily, as_of, zone)


def streaming_hourly_metrics(
    sources: FactSource | Sequence[FactSource],
    config: DataFrame,
    as_of: datetime | str,
    critical_cols: Sequence[str] = (),
    ingestion_ts: str = "ingestionTimestamp",
) -> DataFrame:
    """The last 24 hours by processing time: distinct event times, NULLs in critical columns.

    ``ingestion_ts`` minus event time is the delay, if the column exists, to 2 decimals.
    """
    start, end = rolling_window(as_of)
    usable = _configured(config.filter(F.col("expected_interval_minutes") != 0))
    found = []
    for source in _readable(sources):
        rows, proc = source.frame.filter(within(source.processing_ts, start, end)), F.col(source.processing_ts)
        points = reduced(source, rows, F.date_trunc("hour", proc), F.col(source.ts), proc, _ingestion_delay(source, ingestion_ts), any_null(rows, critical_cols))
        found.append(_own_delay(match_connections(points, usable, source), [None] if ingestion_ts in rows.columns else []))
    return _finish(
        _same_columns(found), F.col("_bucket"), expected_per_hour(F.col("expected_interval_minutes")), delay_scale=2
    )


def connection_facts(
    sources: FactSource | Sequence[FactSource],
    config: DataFrame,
    window: tuple[datetime | str, datetime | str],
    newest_from: datetime | str | None = None,
    on_processing_ts: bool = False,
    critical_cols: Sequence[str] = (),
    ingestion_ts: str = "ingestionTimestamp",
) -> DataFrame:
    """All that a status needs to know of the facts, per connection, from one scan of each table: ``hourly_metrics`` and its
    summary, ``last_sync_timestamp``, and ``edges``, first and last record of each stretch of `STRETCH_SECONDS` in the
    window, between which gaps may lie (at most 960 stretches a day, for connections that can have gaps).

    Newest records are looked for in the whole table, or from ``newest_from`` on. The window is [start, end) by event
    time, or by ``on_processing_ts`` by processing time; then hours have no edges.
    """
    start, end = window
    found = []
    for source in _readable(sources):
        ts, proc = F.col(source.ts), F.col(source.processing_ts)
        clock, date_col = (source.processing_ts, None) if on_processing_ts else (source.ts, source.date_col)
        rows = source.frame
        if newest_from is not None:
            rows = rows.filter(since(clock, min(utc(start), utc(newest_from)), date_col))
        inside = within(clock, start, end)
        if on_processing_ts:
            bucket, delays = F.date_trunc("hour", proc), _ingestion_delay(source, ingestion_ts)
            names: list[str | None] = [None] * len(delays)
        else:
            bucket = F.timestamp_seconds(F.floor(F.unix_timestamp(ts) / STRETCH_SECONDS) * STRETCH_SECONDS)
            names = list(source.processing)
            delays = [minutes_between(F.col(p), ts) for p in source.processing]
        points = reduced(source, rows, F.when(inside, bucket), F.when(inside, ts), F.col(clock), [F.when(inside, d) for d in delays],
                         F.when(inside, any_null(rows, critical_cols)))
        found.append(_own_delay(match_connections(points, _configured(config), source), names))
    return per_connection(_same_columns(found), start, on_processing_ts)


def per_connection(found: DataFrame, start: datetime | str, on_processing_ts: bool = False) -> DataFrame:
    """Hours, summary, newest record and edges of each connection, from buckets that were matched to it."""
    interval = F.col("expected_interval_minutes")
    daily = F.coalesce(interval >= DAILY_MINUTES, F.lit(False)) & F.lit(not on_processing_ts)
    hour = F.date_trunc("hour", "_bucket")
    period = F.when(F.col("_bucket").isNotNull() & (interval != 0), F.when(daily, ts_lit(start)).otherwise(hour))
    edge = F.when(F.col("_first").isNotNull() & (interval > 0) & (interval < DAILY_MINUTES), F.struct("_first", "_last"))
    more = [F.max("_newest").alias("_newest")] + ([] if on_processing_ts else [F.collect_list(edge).alias("_edges")])
    hours = _finish(found, period, F.when(daily, F.lit(1)).otherwise(expected_per_hour(interval)), 2 if on_processing_ts else None, more)
    entries = F.array_sort(F.collect_list(F.when(F.col("hour").isNotNull(), F.struct(*[n for n, _ in HOUR_FIELDS]))))
    edges = F.lit(None) if on_processing_ts else F.array_sort(F.flatten(F.collect_list("_edges")))
    return hours.groupBy("connection_id").agg(
        F.when(F.size(entries) > 0, entries).alias("hourly_metrics"), *summary_columns(), F.max("_newest").alias("last_sync_timestamp"),
        edges.alias("edges"))


def latest_per_connection(
    sources: FactSource | Sequence[FactSource],
    config: DataFrame,
    on_processing_ts: bool = False,
    start: datetime | str | None = None,
) -> DataFrame:
    """Newest record of each connection, over the whole fact or from ``start`` on."""
    found = []
    for source in _readable(sources):
        ts = source.processing_ts if on_processing_ts else source.ts
        rows = source.frame
        if start is not None:
            rows = rows.filter(since(ts, start, None if on_processing_ts else source.date_col))
        newest = source.selected(rows, _newest=F.col(ts)).groupBy("_set", *source.key_columns).agg(F.max("_newest").alias("last_sync_timestamp"))
        found.append(match_connections(newest, _configured(config), source).select("connection_id", "last_sync_timestamp"))
    return union_all(found).groupBy("connection_id").agg(F.max("last_sync_timestamp").alias("last_sync_timestamp"))


def collect_hourly(hours: DataFrame) -> DataFrame:
    """The hour rows of a connection as one array in time order, at most one entry per hour."""
    entry = F.struct(*[n for n, _ in HOUR_FIELDS])
    return hours.groupBy("connection_id").agg(F.array_sort(F.collect_list(entry)).alias("hourly_metrics"))


def _mean(col: str) -> Column:
    """A mean freed of the noise that the order of a distributed sum leaves in its last digits,
    which would otherwise decide how halves are rounded and thresholds crossed."""
    return F.round(F.avg(col), 9)


def _int(total: Column) -> Column:
    """Published counts are INT: what is larger stays at the largest INT instead of stopping all statuses. No count stays NULL."""
    return F.when(total.isNotNull(), F.least(total, F.lit(2**31 - 1))).cast("int")


def summary_columns() -> list[Column]:
    """Aggregates over the hour rows of a connection: sums, and means of the hourly values."""
    return [
        _int(F.sum("data_points")).alias("data_points_24h"),
        F.bround(_mean("completeness_pct"), 1).alias("completeness_pct"),
        F.bround(_mean("uptime_pct"), 1).alias("uptime_pct_24h"),
        F.bround(_mean("avg_delay_minutes"), 1).alias("avg_delay_minutes"),
        _int(F.sum("total_validation_errors")).alias("total_validation_errors"),
        _int(F.sum("duplicate_timestamps")).alias("duplicate_timestamps_24h"),
        _int(F.sum("null_values")).alias("null_values_24h"),
        _mean("completeness_pct").alias("mean_completeness"),
    ]


def summary_24h(hours: DataFrame) -> DataFrame:
    return hours.groupBy("connection_id").agg(*summary_columns())


def hourly_and_summary(hours: DataFrame) -> DataFrame:
    """Array and summary together, in one aggregation."""
    entry = F.struct(*[n for n, _ in HOUR_FIELDS])
    return hours.groupBy("connection_id").agg(
        F.array_sort(F.collect_list(entry)).alias("hourly_metrics"), *summary_columns()
    )
