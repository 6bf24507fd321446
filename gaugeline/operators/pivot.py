"""Long category rows to wide rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _earliest(value: Column, condition: Column, order: Sequence[str]) -> Column:
    """The value of the first row, by ``order``, for which ``condition`` holds.

    One fixed-width order column keeps this in hash aggregation.
    """
    rank = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    return F.min_by(F.when(condition, value), F.when(condition, rank))


def pivot_categories(
    df: DataFrame,
    keys: Sequence[str],
    category: str,
    value: str,
    mapping: dict[object, str],
    order: Sequence[str],
    drift: str | None = None,
) -> DataFrame:
    """One row per key with a column for each mapped category: its first non-null value.

    Categories outside ``mapping`` are ignored, keys without any metric vanish. The same
    aggregation carries the first non-null ``drift`` text, so no join is needed. Partial
    aggregation shrinks repeated rows before the shuffle.
    """
    known = F.col(value).isNotNull()
    aggs = [
        _earliest(F.col(value), known & (F.col(category) == F.lit(code)), order).alias(name)
        for code, name in mapping.items()
    ]
    if drift:
        aggs.append(_earliest(F.col(drift), F.col(drift).isNotNull(), order).alias(drift))
    return (
        df.filter(F.col(category).isin(*mapping))
        .groupBy(*keys)
        .agg(*aggs)
        .dropna(how="all", subset=list(mapping.values()))
    )
