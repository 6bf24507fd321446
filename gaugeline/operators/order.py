"""Latest-row selection and ordered differences, written so that no key can fill one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Order = Sequence[tuple[str, str]]
"""Sort order as (column, 'asc' | 'desc') pairs."""


def sort_columns(order: Order) -> list[Column]:
    """NULLs come last in both directions."""
    return [F.col(c).desc_nulls_last() if d == "desc" else F.col(c).asc_nulls_last() for c, d in order]


def latest_per_snapshot(df: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    """One row per key, the first in ``order``; give a full tie-break to make it repeatable.

    Spark keeps only the best row per key in every map task before the shuffle,
    so many copies of one key cost nothing on the reduce side.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*sort_columns(order)))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def latest_inventory(dim: DataFrame, keys: Sequence[str], order: Order = (("snapshot_date", "desc"),)) -> DataFrame:
    """The current row of every entity of a snapshot dimension."""
    return latest_per_snapshot(dim, keys, order)


def _quantile_slice(df: DataFrame, ts: str, slices: int) -> Column:
    """The number of the quantile of all times that a row lies in.

    A slice of a key cannot hold more rows than its quantile, so however densely the rows of a key lie, and however many it
    has, they spread. One narrow pass finds the bounds; a row is placed by two short searches.
    """
    micros = F.unix_micros(ts)
    cuts = [k / slices for k in range(1, slices)]
    found = df.agg(F.percentile_approx(micros, cuts, 10 * slices).alias("cuts")).first()["cuts"] if cuts else None
    bounds = sorted(set(found or []))
    width = max(1, round(len(bounds) ** 0.5))
    groups = [bounds[k: k + width] for k in range(0, len(bounds), width)] or [[]]

    def passed(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b <= micros))

    def longs(values: list[int]) -> Column:
        return F.array(*map(F.lit, values)).cast("array<bigint>")

    group = passed(longs([g[0] for g in groups[1:]]))
    inner = passed(F.element_at(F.array(*map(longs, groups)), group + 1))
    return (group * (width + 1) + inner).cast("bigint")


def _slices(df: DataFrame, keys: Sequence[str], ts: str, seconds: int | None, slices: int | None = None, whole: bool = False) -> DataFrame:
    """Rows dealt out once by key and time slice; rows without a time are a slice of their own."""
    if seconds is None:
        cut = _quantile_slice(df, ts, slices or min(1024, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    else:
        cut = F.floor(F.unix_timestamp(ts) / seconds)
    if whole:  # a key is a slice, and the windows ask for rows by key themselves; a missing key is no key, and its slices do not meet
        missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        return df.withColumn("_slice", F.when(missing & F.col(ts).isNotNull(), cut).otherwise(F.lit(0)).cast("bigint"))
    return df.withColumn("_slice", F.when(F.col(ts).isNotNull(), cut).otherwise(F.lit(-(1 << 62)))).repartition(*keys, "_slice")


def _lag_in_slices(sliced: DataFrame, keys: Sequence[str], ts: str, cols: dict[str, str], known: Column | None, whole: bool = False) -> DataFrame:
    timed = F.col(ts).isNotNull()
    counts = timed if known is None else timed & known
    before = Window.partitionBy(*keys, "_slice").orderBy(F.col(ts).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    values = F.struct(*(F.col(src).alias(out) for src, out in cols.items()))
    rows = sliced.withColumn("_here", F.last(F.when(counts, values), ignorenulls=True).over(before))
    if whole:
        previous = F.when(counts, F.col("_here"))
        return rows.withColumns({out: previous[out] for out in cols.values()}).drop("_here", "_slice")
    # The last row of each slice, at most one per slice however dense the readings are. It is taken whole, with copies of
    # the keys to join by: no column and no row is then left out before the shuffle, and both branches read the same one.
    edges = sliced.groupBy(*keys, "_slice").agg(F.max_by(F.struct(*sliced.columns), F.when(counts, F.col(ts))).alias("_last"), *(F.first(k).alias(f"_key_{k}") for k in keys))
    edges = edges.filter(F.col("_last").isNotNull())
    passed = edges.withColumn("_last", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_slice")))
    carried = F.struct(*(F.col(f"_last.{src}").alias(out) for src, out in cols.items()))
    passed = passed.filter(F.col("_last").isNotNull()).select(
        *(F.col(f"_key_{k}").alias(k) for k in keys), "_slice", carried.alias("_carried"))
    joined = rows.join(passed, [*keys, "_slice"], "left")
    previous = F.when(counts, F.coalesce("_here", "_carried"))
    return joined.withColumns({out: previous[out] for out in cols.values()}).drop("_here", "_carried", "_slice")


def lag_columns(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    cols: dict[str, str],
    slice_seconds: int | None = None,
    known: Column | None = None,
    slices: int | None = None,
    whole: bool = False,
) -> DataFrame:
    """Add for each ``cols`` entry the value of the previous row of the same key.

    A plain ``lag`` puts the whole history of a key in one task. Here every key is cut into time
    slices, whatever its size: rows are dealt out once, by key and slice, and compared inside their
    slice; only the last row of each slice goes on to the next one, by a join. Slices are ``slices`` quantiles of all times (by
    default four a shuffle partition), so none holds more than its share of the rows; finding them takes a pass over the
    times. ``slice_seconds`` cuts by the clock instead, without that pass; with ``whole`` keys stay
    whole, for rows of which no key has too many for a task. ``(keys, ts)`` must be
    unique and keys not null. Rows without a time, and rows that are not ``known``, get NULL and
    are no one's predecessor.
    """
    return _lag_in_slices(_slices(df, keys, ts, slice_seconds, slices, whole), keys, ts, cols, known, whole)


def counter_delta(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    counter: str,
    out: str = "interval",
    tie_break: Order | None = None,
    carry_over_nulls: bool = False,
    max_gap_seconds: int | None = None,
    slice_seconds: int | None = None,
    seed: tuple[str, str] | None = None,
    slices: int | None = None,
    whole: bool = False,
) -> DataFrame:
    """Interval value of a cumulative counter: the rise since the previous reading.

    First readings and falls (a reset or a new meter) give NULL. With ``tie_break``
    repeated timestamps are reduced to the first row in that order, within the slices of
    ``lag_columns``. A NULL reading makes the next interval NULL too, unless ``carry_over_nulls``
    compares with the last known value. A silence longer than ``max_gap_seconds`` gives NULL.
    ``seed`` names two columns (value, time) with the reading before the first row of the key, for
    data that continues an earlier run. A reading without a time has no interval and changes no other.
    """
    rows = _slices(df, keys, ts, slice_seconds, slices, whole)
    if tie_break:
        rows = latest_per_snapshot(rows, [*keys, "_slice", ts], tie_break)
    known = F.col(counter).isNotNull() if carry_over_nulls else None
    rows = _lag_in_slices(rows, keys, ts, {counter: "_prev", ts: "_prev_ts"}, known, whole)
    before, since = F.col("_prev"), F.col("_prev_ts")
    if seed:
        before = F.when(since.isNull(), F.col(seed[0])).otherwise(before)
        since = F.coalesce(since, F.col(seed[1]))
    rise = F.when(F.col(ts).isNotNull() & (F.col(counter) >= before), F.col(counter) - before)
    if max_gap_seconds is not None:
        silence = F.unix_timestamp(ts) - F.unix_timestamp(since)
        rise = F.when(silence <= max_gap_seconds, rise)
    return rows.withColumn(out, rise).drop("_prev", "_prev_ts")
