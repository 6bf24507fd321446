"""Keyed merges on plain tables. Each returns the new content; write it to a new folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _distinct_source(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source with a mark; a repeated key stops the job, as an ambiguous merge must.

    The window needs the same partitioning and order as the join that follows,
    so the check adds no shuffle.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    stop = F.raise_error(F.lit(f"more than one source row for a key {list(keys)}")).cast("boolean")
    return source.withColumn("_present", F.when(n == 1, True).otherwise(stop))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    insert_only_cols: Sequence[str] = (),
    insert_defaults: dict[str, object] | None = None,
) -> DataFrame:
    """Merge ``source`` into ``target`` by key.

    Matched rows take ``update_cols`` from the source and keep the rest. New rows take
    ``update_cols`` and ``insert_only_cols`` from the source and ``insert_defaults``
    (or NULL) elsewhere. Rows without a source row stay as they are.
    """
    insert_defaults = insert_defaults or {}
    types = {f.name: f.dataType for f in target.schema.fields}
    source = _distinct_source(source.select(*keys, *update_cols, *insert_only_cols), keys)
    s = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in source.columns if c not in keys])
    t = target.withColumn("_t_present", F.lit(True))
    joined = t.join(s, list(keys), "full")
    is_new = F.col("_t_present").isNull()
    from_source = F.col("_s__present").isNotNull()
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in update_cols:
            out.append(F.when(from_source, F.col(f"_s_{c}")).otherwise(F.col(c)).cast(types[c]).alias(c))
        elif c in insert_only_cols:
            out.append(F.when(is_new, F.col(f"_s_{c}")).otherwise(F.col(c)).cast(types[c]).alias(c))
        else:
            default = F.lit(insert_defaults.get(c)).cast(types[c])
            out.append(F.when(is_new, default).otherwise(F.col(c)).alias(c))
    return joined.select(*out)


def update_from(target: DataFrame, updates: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Set ``cols`` of the target rows that have an update row; all of them in one job."""
    u = _distinct_source(updates.select(*keys, *cols), keys)
    u = u.select(*keys, "_present", *[F.col(c).alias(f"_u_{c}") for c in cols])
    types = {f.name: f.dataType for f in target.schema.fields}
    hit = F.col("_present").isNotNull()
    return target.join(u, list(keys), "left").select(*[
        F.when(hit, F.col(f"_u_{c}")).otherwise(F.col(c)).cast(types[c]).alias(c) if c in cols else F.col(c)
        for c in target.columns
    ])


def append_audit(log: DataFrame, results: DataFrame) -> DataFrame:
    """The log plus a row for each successful run that did something."""
    done = results.filter((F.col("status") == "SUCCESS") & (F.col("files_deleted") > 0))
    return log.unionByName(done.select(*log.columns))
