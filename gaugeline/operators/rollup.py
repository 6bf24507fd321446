"""Fixed-interval rollups and simple aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import bucket_start


def rollup_interval(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    minutes: int = 15,
    mean: Sequence[str] = (),
    last: Sequence[str] = (),
    total: Sequence[str] = (),
    newest: Sequence[str] = (),
    scale: int = 2,
    out: str = "timestamp_bucket",
) -> DataFrame:
    """Epoch-aligned buckets: gauges averaged, counters and stamps at their maximum, deltas summed.

    ``last`` and ``newest`` both take the maximum; two lists keep counters and
    processing times apart for the reader. Partial aggregation runs before the shuffle.
    """
    return df.groupBy(*keys, bucket_start(ts, minutes).alias(out)).agg(
        *[F.round(F.avg(c), scale).alias(c) for c in mean],
        *[F.max(c).alias(c) for c in last],
        *[F.round(F.sum(c), scale).alias(c) for c in total],
        *[F.max(c).alias(c) for c in newest],
    )


def latest_record(fact: DataFrame, keys: Sequence[str], ts: str, out: str = "latest_record_timestamp") -> DataFrame:
    return fact.groupBy(*keys).agg(F.max(ts).alias(out))


def any_null(df: DataFrame, critical: Sequence[str]) -> Column:
    """True when one of the critical columns that exist is NULL."""
    present = [c for c in critical if c in df.columns]
    check = F.lit(False)
    for c in present:
        check = check | F.col(c).isNull()
    return check


def null_count(df: DataFrame, keys: Sequence[str], critical: Sequence[str], out: str = "null_values") -> DataFrame:
    return df.groupBy(*keys).agg(F.count_if(any_null(df, critical)).alias(out))
