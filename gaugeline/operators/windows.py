"""Pause windows, expected slots and the landing backlog."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import date_lit, minutes_between, ts_lit


def active_windows(schedules: DataFrame, as_of: datetime | str, name: str | None = None) -> DataFrame:
    """Schedules in force on the day of ``as_of`` (both ends included); with ``name`` the first one."""
    live = schedules.filter(
        F.col("is_active") & date_lit(as_of).between(F.col("pause_start_date"), F.col("pause_end_date"))
    )
    if name is None:
        return live
    return live.filter(F.col("job_name") == name).orderBy("pause_start_date", "pause_end_date").limit(1)


def pause_intervals(schedules: DataFrame, key: str = "job_name", zone: str = "UTC") -> DataFrame:
    """The active schedules as half-open times [pause_start, pause_end): whole local days, the last one included."""
    start, end = F.col("pause_start_date").cast("timestamp_ntz"), F.date_add("pause_end_date", 1).cast("timestamp_ntz")
    live = schedules.filter(F.col("is_active") & (F.col("pause_start_date") <= F.col("pause_end_date")))
    return live.select(key, F.to_utc_timestamp(start.cast("timestamp"), zone).alias("pause_start"), F.to_utc_timestamp(end.cast("timestamp"), zone).alias("pause_end"))


def merged_intervals(intervals: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Overlapping, touching and nested intervals of a key as one; empty ones and those without an end go."""
    order = Window.partitionBy(key).orderBy(start, end)
    before = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    real = intervals.select(key, start, end).filter((F.col(start) < F.col(end)) & F.col(key).isNotNull())
    new = real.withColumn("_new", (before.isNull() | (F.col(start) > before)).cast("int"))
    islands = new.withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return islands.groupBy(key, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")


def overlaps(left: DataFrame, right: DataFrame, key: str, left_ends: tuple[str, str], right_ends: tuple[str, str], bin_seconds: int = 86_400) -> DataFrame:
    """The pairs of one key whose half-open intervals overlap, as an equality join of time bins.

    An interval stands in each bin it reaches into, and a pair is made in the bin where the later of the two begins, so once.
    Choose bins about as long as the intervals: longer ones compare more pairs, shorter ones copy more rows. Empty
    intervals and those without an end overlap nothing.
    """

    def binned(df: DataFrame, ends: tuple[str, str]) -> DataFrame:
        first, last = (F.floor(F.unix_micros(e) / (bin_seconds * 1_000_000)) for e in (F.col(ends[0]), F.col(ends[1]) - F.expr("INTERVAL 1 MICROSECOND")))
        return df.filter(F.col(ends[0]) < F.col(ends[1])).withColumn("_bin", F.explode(F.sequence(first, last)))

    a, b = (F.col(x) for x in (left_ends[0], right_ends[0]))
    pairs = binned(left, left_ends).join(binned(right, right_ends), [key, "_bin"])
    meet = (a < F.col(right_ends[1])) & (b < F.col(left_ends[1]))
    return pairs.filter(meet & (F.floor(F.unix_micros(F.greatest(a, b)) / (bin_seconds * 1_000_000)) == F.col("_bin"))).drop("_bin")


def masked_gaps(gaps: DataFrame, pauses: DataFrame, key: str = "connection_id", interval: str = "expected_interval_minutes", factor: float = 1.5,
                bin_seconds: int = 86_400) -> DataFrame:
    """Gaps less the planned downtime of their key: shortened, split or gone.

    ``gaps`` has ``gap_start``, ``gap_end`` and the ``interval`` column, ``pauses`` pause_start and pause_end, of any overlap. What
    is left of a gap is one again only if it is longer than ``factor`` intervals; its minutes and missing records are
    counted anew. Other columns of ``gaps`` stay.
    """
    others = [c for c in gaps.columns if c not in ("gap_start", "gap_end", "gap_duration_minutes", "missing_records")]
    marked = gaps.select(*others, "gap_start", "gap_end")
    merged = merged_intervals(pauses, key, "pause_start", "pause_end")
    met = overlaps(marked.select(key, "gap_start", "gap_end").distinct(), merged, key, ("gap_start", "gap_end"), ("pause_start", "pause_end"), bin_seconds)
    # The pauses of one gap, a bounded list: they are apart from each other, and a gap lies within its window.
    within = met.groupBy(key, "gap_start", "gap_end").agg(F.array_sort(F.collect_list(F.struct("pause_start", "pause_end"))).alias("_pauses"))
    joined = marked.join(within, [key, "gap_start", "gap_end"], "left")
    starts = F.concat(F.array("gap_start"), F.transform("_pauses", lambda p: p["pause_end"]))
    ends = F.concat(F.transform("_pauses", lambda p: p["pause_start"]), F.array("gap_end"))
    whole = F.array(F.struct(F.col("gap_start").alias("s"), F.col("gap_end").alias("e")))
    pieces = F.coalesce(F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("s"), e.alias("e"))), whole)
    left = joined.select(*others, F.explode(pieces).alias("_p")).select(*others, F.col("_p.s").alias("gap_start"), F.col("_p.e").alias("gap_end"))
    minutes = minutes_between(F.col("gap_end"), F.col("gap_start"))
    return left.filter(minutes > F.col(interval) * F.lit(float(factor))).select(
        *others, "gap_start", "gap_end", F.bround(minutes, 0).cast("int").alias("gap_duration_minutes"),
        F.greatest(F.lit(0), F.bround(minutes / F.col(interval), 0).cast("int") - 1).alias("missing_records"))


def expected_slots(
    entities: DataFrame, start: datetime | str | Column, end: datetime | str | Column, hours: int = 8
) -> DataFrame:
    """The fetch plan: for each entity the windows of ``hours`` in [start, end).

    ``slot_end`` is the last second of the window, one second before the next begins.
    Bounds may be columns of ``entities``.
    """
    first = start if isinstance(start, Column) else ts_lit(start)
    stop = end if isinstance(end, Column) else ts_lit(end)
    step = F.expr(f"INTERVAL {hours} HOURS")
    second = F.expr("INTERVAL 1 SECOND")
    starts = F.sequence(first, stop - second, step)
    return entities.withColumn("slot_start", F.explode(starts)).withColumns({
        "slot_day": F.to_date("slot_start"),
        "slot_index": F.floor(F.hour("slot_start") / hours).cast("int"),
        "slot_end": F.col("slot_start") + step - second,
    })


def landing_backlog(slots: DataFrame, landed: DataFrame, on: list[str]) -> DataFrame:
    """Slots that have no landed file yet."""
    return slots.join(landed.select(*on).distinct(), on, "left_anti")
