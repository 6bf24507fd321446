"""Healing a published fact from rows that came late: only what they change is computed anew and swapped in.

A late reading has an interval of its own and changes that of its successor. Both lie within ``max_gap`` of it, and so does all that
they are compared with; without rows so near they have no interval. So the readings of the keys with late rows, within
that distance of one, are read again, and the days on which something has changed are replaced as parts of one version
(`sources.versions`): readers see all of it or nothing. The fact is kept by day, so days that are out of reach are not opened.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import utc
from ..operators.order import Order, counter_delta, latest_per_snapshot
from ..sources import versions

DAY = "event_date"
DEFAULT_GAP = 8 * 24 * 3600


def publish_fact(rows: DataFrame, root: str, ts: str) -> int:
    """Publish a fact by the days of ``rows``; their days are replaced whole."""
    return versions.publish_parts(rows.withColumn(DAY, F.to_date(ts)), root, DAY)


def _near(rows: DataFrame, late: DataFrame, keys: Sequence[str], ts: str, max_gap_seconds: int) -> DataFrame:
    """The rows within the gap of a late row of their key, as an equality join on time bins of that width; each row once."""
    bin_of = F.floor(F.unix_timestamp(ts) / max_gap_seconds)
    spans = late.select(*keys, F.explode(F.array(bin_of - 1, bin_of, bin_of + 1)).alias("_bin")).distinct()
    return rows.withColumn("_bin", bin_of).join(spans, [*keys, "_bin"], "left_semi").drop("_bin")


def heal_counter_delta(
    spark: SparkSession, root: str, late: DataFrame, keys: Sequence[str], ts: str, counter: str, out: str = "interval",
    tie_break: Order = (), max_gap_seconds: int = DEFAULT_GAP,
) -> list[str]:
    """Take late rows into a fact of interval values and give the days that were written anew.

    ``late`` has the columns of the fact but ``out`` and the day. Of rows with the same keys and time the first in ``tie_break`` stays,
    by default the smallest counter, whether it is a late one or not. Rows without a time, or without a key, change nothing. A repeated
    run changes nothing. Run it on what a stream has put aside as late; one healer at a time (see `versions`).
    """
    order = list(tie_break) or [(counter, "asc")]
    late = late.filter(F.col(ts).isNotNull())
    for k in keys:
        late = late.filter(F.col(k).isNotNull())
    low, high = late.agg(F.min(F.unix_timestamp(ts)), F.max(F.unix_timestamp(ts))).first()
    if low is None:
        return []
    number = versions.versions(spark, root)[-1]
    # A bin to either side of the bins next to a late row: the predecessors of the rows that may change.
    reach = timedelta(seconds=3 * max_gap_seconds)
    first, last = (f"{utc('1970-01-01') + timedelta(seconds=s) + d:%Y-%m-%d}" for s, d in ((low, -reach), (high, reach)))
    columns = [c for c in versions.read_parts(spark, root, lambda _: False).columns if c not in (out, DAY)]
    known = versions.read_parts(spark, root, lambda day: first <= day <= last, number)
    marked = late.select(*columns).withColumn("_late", F.lit(True))
    near = _near(known, late, keys, ts, max_gap_seconds).withColumn("_late", F.lit(False))
    both = latest_per_snapshot(near.select(*columns, "_late").unionByName(marked), [*keys, ts], [*order, ("_late", "asc")])
    again = counter_delta(both, [*keys], ts, counter, out, max_gap_seconds=max_gap_seconds)
    # Rows at the rim have lost what lies before them; they are only context. What counts is near a late row.
    bin_of = F.floor(F.unix_timestamp(ts) / max_gap_seconds)
    old = near.select(*keys, ts, F.struct(*[c for c in columns if c not in (*keys, ts)], out).alias("_old"), F.lit(True).alias("_known"))
    new = again.select(*columns, out, F.struct(*[c for c in columns if c not in (*keys, ts)], out).alias("_new"))
    times = late.select(*keys, F.col(ts).alias("_at")).distinct()
    spread = times.withColumn("_bin", F.explode(F.array(*(F.floor(F.unix_timestamp("_at") / max_gap_seconds) + k for k in (0, 1)))))
    inside = (F.col(ts) >= F.col("_at")) & (F.unix_timestamp(ts) - F.unix_timestamp("_at") <= max_gap_seconds)
    touched = new.withColumn("_bin", bin_of).join(spread, [*keys, "_bin"]).filter(inside).drop("_bin", "_at").dropDuplicates([*keys, ts])
    changed = touched.join(old, [*keys, ts], "left").filter(F.col("_known").isNull() | ~F.col("_old").eqNullSafe(F.col("_new")))
    changed = changed.select(*columns, out).withColumn(DAY, F.to_date(ts)).persist()
    try:
        days = sorted(str(r[0]) for r in changed.select(DAY).distinct().collect())  # days within reach of late rows
        if not days:
            return []
        kept = versions.read_parts(spark, root, lambda day: day in days, number).join(changed.select(*keys, ts), [*keys, ts], "left_anti")
        rows = kept.unionByName(changed.select(*kept.columns))
        versions.publish_parts(rows, root, DAY, after=number)
        return days
    finally:
        changed.unpersist()


def read_fact(spark: SparkSession, root: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """The fact, or its days from ``first`` to ``last``."""
    return versions.read_parts(spark, root, lambda day: (first is None or day >= first) and (last is None or day <= last))
