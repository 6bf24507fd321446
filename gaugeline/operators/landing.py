"""Summaries of what a fetch has landed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def landing_summary(log: DataFrame, by: str = "entity", mark_total: bool = True) -> DataFrame:
    """Files, samples and errors per entity, and one row for all, marked by ``is_total`` unless ``mark_total`` is off.

    ``log`` has a row per fetch: the entity, ``status`` ('success' or 'error') and ``samples``.
    """
    ok = F.col("status") == "success"
    return log.rollup(by).agg(
        F.count(F.lit(1)).alias("fetches"),
        F.count_if(ok).alias("files"),
        F.coalesce(F.sum(F.when(ok, F.col("samples"))), F.lit(0)).alias("samples"),
        F.count_if(~ok).alias("errors"),
        *([(F.grouping(by) == 1).alias("is_total")] if mark_total else []),
    )


def landing_errors(log: DataFrame) -> DataFrame:
    return log.filter(F.col("status") != "success")
