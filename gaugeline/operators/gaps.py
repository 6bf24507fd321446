"""Gaps: spacings between records that are longer than a connection's interval allows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.health import DAILY_MINUTES
from ..functions.time import DEFAULT_ZONE, local_day_bounds, minutes_between, ts_lit, utc, within
from .config import FactSource, match_connections
from .metrics import _as_list, _configured, _readable, union_all


def _clusters(source: FactSource, rows: DataFrame, width: int) -> DataFrame:
    """First and last record per (selection, key, stretch of ``width`` seconds).

    Records of one stretch are closer together than any gap, so the stretches hold all
    that gap detection needs. Their number depends on the window only, not on the number
    of records, and map-side aggregation builds them before anything is shuffled.
    """
    stretch = F.floor(F.unix_timestamp(source.ts) / width)
    picked = source.selected(rows, _at=F.col(source.ts), _stretch=stretch)
    return picked.groupBy("_set", *source.key_columns, "_stretch").agg(
        F.min("_at").alias("_first"), F.max("_at").alias("_last")
    ).drop("_stretch")


def detect_gaps(
    sources: FactSource | Sequence[FactSource],
    config: DataFrame,
    as_of: datetime | str,
    factor: float = 1.5,
    zone: str = DEFAULT_ZONE,
    window: tuple[datetime | str, datetime | str] | None = None,
) -> DataFrame:
    """Gaps of each connection in the previous local day, or in ``window``.

    Both ends of the window count as records, so silence at its start, its end, or all
    through it is found as well, for every connection whose table exists. A spacing of
    more than ``factor`` intervals is a gap; ``missing_records`` is the number of intervals
    it covers, rounded half to even, less one. Connections without an interval below a
    day have none. ``config`` comes from ``connection_predicate``.
    """
    start, end = map(utc, window) if window else local_day_bounds(as_of, zone)
    interval = F.col("expected_interval_minutes")
    eligible = _configured(config.filter((interval > 0) & (interval < DAILY_MINUTES)))
    width = max(1, int(60 * factor))
    sources = [s for s in _as_list(sources) if s.frame is not None]
    pieces = [
        eligible.filter(F.col("gold_table_name").isin([s.table for s in sources])).select(
            "connection_id", "expected_interval_minutes",
            F.explode(F.array(ts_lit(start), ts_lit(end))).alias("_first"),
        ).withColumn("_last", F.col("_first"))
    ]
    for source in _readable(sources):
        clusters = _clusters(source, source.frame.filter(within(source.ts, start, end, source.date_col)), width)
        pieces.append(
            match_connections(clusters, eligible, source).select("connection_id", "expected_interval_minutes", "_first", "_last")
        )
    before = (
        Window.partitionBy("connection_id").orderBy("_first", "_last").rowsBetween(Window.unboundedPreceding, -1)
    )
    spaced = union_all(pieces).withColumn("_prev", F.max("_last").over(before))
    minutes = minutes_between(F.col("_first"), F.col("_prev"))
    return spaced.filter(minutes > interval * F.lit(float(factor))).select(
        "connection_id",
        F.col("_prev").alias("gap_start"),
        F.col("_first").alias("gap_end"),
        F.bround(minutes, 0).cast("int").alias("gap_duration_minutes"),
        F.greatest(F.lit(0), F.bround(minutes / interval, 0).cast("int") - 1).alias("missing_records"),
    )


def gaps_between(edges: Column, interval: Column, start: datetime | str, end: datetime | str, factor: float = 1.5) -> Column:
    """The gaps of one connection as an array in time order, from the ``edges`` of `connection_facts`: the same as `detect_gaps`.

    NULL without a gap, and for connections without an interval below a day.
    """
    bound = [F.array(F.struct(ts_lit(t).alias("_first"), ts_lit(t).alias("_last"))) for t in (start, end)]
    known = F.coalesce(edges, F.slice(bound[0], 1, 0))
    before, after = F.concat(bound[0], known), F.concat(known, bound[1])

    def gap(a: Column, b: Column) -> Column:
        minutes = minutes_between(b["_first"], a["_last"])
        return F.when(minutes > interval * F.lit(float(factor)), F.struct(
            a["_last"].alias("gap_start"), b["_first"].alias("gap_end"), F.bround(minutes, 0).cast("int").alias("gap_duration_minutes"),
            F.greatest(F.lit(0), F.bround(minutes / interval, 0).cast("int") - 1).alias("missing_records")))

    found = F.filter(F.zip_with(before, after, gap), lambda g: g.isNotNull())
    return F.when((interval > 0) & (interval < DAILY_MINUTES) & (F.size(found) > 0), found)


def gap_summary(gaps: DataFrame) -> DataFrame:
    """Number of gaps and the gaps in time order; a day cannot hold more gaps than minutes."""
    entry = F.struct("gap_start", "gap_end", "gap_duration_minutes", "missing_records")
    return gaps.groupBy("connection_id").agg(
        F.count(F.lit(1)).cast("int").alias("data_gap_count"),
        F.array_sort(F.collect_list(entry)).alias("data_gaps"),
    )


def recent_gaps(status: DataFrame, n: int = 20) -> DataFrame:
    """The newest ``n`` status rows that have gaps."""
    return (
        status.filter(F.col("data_gap_count") > 0)
        .orderBy(F.col("checked_at").desc(), F.col("connection_id"))
        .limit(n)
        .select("connection_id", "checked_at", "data_gap_count", "data_gaps")
    )
