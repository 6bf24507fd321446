"""Retention of landed files: assignment to sources, expiry, summaries, audit."""

from __future__ import annotations

import fnmatch
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import ts_lit

GIGABYTE = 1024 ** 3


def assign_source(
    listing: DataFrame, patterns: Sequence[tuple[str, str, str]], col: str = "path", out: str = "source"
) -> DataFrame:
    """Give each row the first source whose pattern fits; NULL if none does.

    A pattern is (source, 'prefix' | 'glob', text). The list is part of the program,
    so it becomes one expression and no join.
    """
    def fits(kind: str, text: str) -> Column:
        if kind == "prefix":
            return F.col(col).startswith(text)
        return F.col(col).rlike("^" + fnmatch.translate(text))

    return listing.withColumn(out, F.coalesce(F.lit(None).cast("string"), *[
        F.when(fits(kind, text), source) for source, kind, text in patterns
    ]))


def expired_files(
    listing: DataFrame, retention: DataFrame, as_of: datetime | str, on: Sequence[str] = ("volume_name",)
) -> DataFrame:
    """Files last modified before ``as_of`` less the retention days of their volume."""
    age_limit = ts_lit(as_of) - F.make_interval(days=F.col("retention_days"))
    return listing.join(retention.select(*on, "retention_days"), list(on)).filter(F.col("modified_at") < age_limit)


def _extension(path: Column) -> Column:
    name = F.element_at(F.split(path, "/"), -1)
    return F.when(name.contains("."), F.element_at(F.split(name, r"\."), -1)).otherwise("no_extension")


def retention_summary(expired: DataFrame, by: Sequence[str]) -> DataFrame:
    """Files, bytes, oldest path and the set of extensions per group (the extensions of
    a landing area are few, the files are not)."""
    return expired.groupBy(*by).agg(
        F.count(F.lit(1)).alias("files_deleted"),
        F.sum("bytes").alias("bytes_deleted"),
        F.min_by("path", F.struct("modified_at", "path")).alias("oldest_file"),
        F.array_join(F.array_sort(F.collect_set(_extension(F.col("path")))), ",").alias("file_types"),
    )


def cleanup_results(volumes: DataFrame, summary: DataFrame, on: Sequence[str], failed: DataFrame | None = None) -> DataFrame:
    """A result row for every volume; those without expired files have zeros and 'none'.

    ``failed`` names the volumes (columns ``on``) whose clean-up did not go through: they are FAILED, with
    zeros, as nothing of them is known to be deleted.
    """
    rows = volumes.join(summary, list(on), "left")
    bad = F.lit(False)
    if failed is not None:
        rows = rows.join(failed.select(*on).distinct().withColumn("_failed", F.lit(True)), list(on), "left")
        bad = F.coalesce("_failed", F.lit(False))
    return rows.withColumns({
        "files_deleted": F.when(bad, F.lit(0)).otherwise(F.coalesce("files_deleted", F.lit(0))),
        "bytes_deleted": F.when(bad, F.lit(0)).otherwise(F.coalesce("bytes_deleted", F.lit(0))),
        "file_types": F.when(bad, F.lit("none")).otherwise(F.coalesce("file_types", F.lit("none"))),
        "oldest_file": F.when(~bad, F.col("oldest_file")),
        "status": F.when(bad, F.lit("FAILED")).otherwise(F.lit("SUCCESS")),
    }).drop("_failed")


def cleanup_totals(results: DataFrame, by: str = "connector_name") -> DataFrame:
    """Totals per connector, and one row for all of them, marked by ``is_total``."""
    return results.rollup(by).agg(
        F.count(F.lit(1)).alias("volumes"),
        F.sum("files_deleted").alias("files_deleted"),
        F.sum("bytes_deleted").alias("bytes_deleted"),
        F.round(F.sum("bytes_deleted") / F.lit(float(GIGABYTE)), 2).alias("gb_deleted"),
        F.count_if(F.col("status") == "SUCCESS").alias("succeeded"),
        F.count_if(F.col("status") == "FAILED").alias("failed"),
        (F.grouping(by) == 1).alias("is_total"),
    )


def audit_rows(results: DataFrame, as_of: datetime | str, root: str = "/Volumes") -> DataFrame:
    """Results in the shape of the cleanup log, with the status that ``append_audit`` filters on."""
    return results.select(
        ts_lit(as_of).alias("cleanup_timestamp"),
        F.col("client_catalog").alias("catalog_name"),
        F.concat_ws("/", F.lit(root), "client_catalog", F.lit("land"), "volume_name").alias("volume_path"),
        "retention_days",
        F.col("file_types").alias("data_type"),
        F.least("files_deleted", F.lit(2**31 - 1)).cast("int").alias("files_deleted"),
        F.col("bytes_deleted").cast("bigint").alias("bytes_deleted"),
        F.col("oldest_file").alias("oldest_file_deleted"),
        "connector_name",
        "status",
    )
