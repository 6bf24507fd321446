"""Tables that are replaced as a whole without readers ever seeing a hole.

A table is a folder of versions. Writing makes a new data folder, then publishes it by one small commit file, named by
its number and moved into place when it is complete. Readers follow the newest commit. A write that fails publishes
nothing, so the version before it stays; a reader that has begun keeps reading its own folder, which is kept for
`KEEP` versions. Nothing but commit files passes the driver.

A table can also be replaced by parts (days, buckets): `publish_parts` writes the parts at hand, and the commit file names
the folder of each part, so that the others stay where they are. Parts are told apart by the text of one column.

One writer at a time: a writer that finds the number it wanted taken by another is refused, and its data is removed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .merge import upsert

COMMITS = "_commits"
KEEP = 3


class WriteConflict(RuntimeError):
    """Another writer has published in the meantime."""


def _store(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and a maker of paths on it."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the versions that can be read, oldest first."""
    fs, path = _store(spark, root)
    folder = path(f"{root}/{COMMITS}")
    if not fs.exists(folder):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())


def _commit_of(spark: SparkSession, root: str, number: int) -> dict:
    fs, path = _store(spark, root)
    stream = fs.open(path(f"{root}/{COMMITS}/{number:010d}.json"))
    try:
        return json.loads(str(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def _put(spark: SparkSession, root: str, number: int, commit: dict) -> None:
    """Write a commit file under a name of its own and move it to its number, unless that is taken."""
    fs, path = _store(spark, root)
    fs.mkdirs(path(f"{root}/{COMMITS}"))
    made, wanted = path(f"{root}/{COMMITS}/_{uuid.uuid4().hex}"), path(f"{root}/{COMMITS}/{number:010d}.json")
    stream = fs.create(made, False)
    stream.write(bytearray(json.dumps(commit).encode()))
    stream.close()
    if fs.exists(wanted) or not fs.rename(made, wanted):
        fs.delete(made, False)
        raise WriteConflict(f"version {number} of {root} has been published by another writer")


def publish(df: DataFrame, root: str, partition_by: Sequence[str] = (), keep: int = KEEP, after: int | None = None) -> int:
    """Write ``df`` as the next version of the table and return its number.

    ``df`` may read the table itself. ``after`` is the version it was computed from, by default the newest: if that is no longer
    the newest when the data is written, the write is refused. Versions older than the newest ``keep`` are removed.
    """
    spark = df.sparkSession
    before = versions(spark, root)
    base = after if after is not None else (before[-1] if before else 0)
    folder = f"data-{base + 1:010d}-{uuid.uuid4().hex}"
    fs, path = _store(spark, root)
    try:
        writer = df.write.mode("errorifexists")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{root}/{folder}")
        if any(n > base for n in versions(spark, root)):
            raise WriteConflict(f"{root} has changed since version {base}")
        _put(spark, root, base + 1, {"folder": folder, "schema": df.schema.jsonValue()})
    except Exception:
        fs.delete(path(f"{root}/{folder}"), True)
        raise
    _forget(spark, root, keep)
    return base + 1


def _folders(commit: dict) -> set[str]:
    return {commit["folder"]} if "folder" in commit else set(commit["parts"].values())


def _forget(spark: SparkSession, root: str, keep: int) -> None:
    """Remove versions older than the newest ``keep``, and the folders that no other one names."""
    fs, path = _store(spark, root)
    known = versions(spark, root)
    old, live = known[:-keep], known[-keep:]
    if not old:
        return
    needed = set().union(*(_folders(_commit_of(spark, root, n)) for n in live))
    gone = set().union(*(_folders(_commit_of(spark, root, n)) for n in old)) - needed
    for number in old:
        fs.delete(path(f"{root}/{COMMITS}/{number:010d}.json"), False)
    for folder in gone:
        fs.delete(path(f"{root}/{folder}"), True)


PART = "_part"


def publish_parts(df: DataFrame, root: str, part: str, keep: int = KEEP, about: dict | None = None, after: int | None = None) -> int:
    """Replace the parts that ``df`` has rows of, whole, and keep all others. ``part`` names the column of the part.

    ``about`` is a small dictionary kept with the version, see `about_version`. The commit file grows with the number of parts.
    """
    spark = df.sparkSession
    known = versions(spark, root)
    base = after if after is not None else (known[-1] if known else 0)
    before = _commit_of(spark, root, base) if base else {"parts": {}}
    folder = f"data-{base + 1:010d}-{uuid.uuid4().hex}"
    fs, path = _store(spark, root)
    try:
        df.withColumn(PART, F.coalesce(F.col(part).cast("string"), F.lit(""))).write.partitionBy(PART).parquet(f"{root}/{folder}")
        written = [f.getPath().getName() for f in fs.listStatus(path(f"{root}/{folder}")) if f.isDirectory() and f.getPath().getName().startswith(f"{PART}=")]
        parts = before["parts"] | {_part_name(name): f"{folder}/{name}" for name in written}
        if any(n > base for n in versions(spark, root)):
            raise WriteConflict(f"{root} has changed since version {base}")
        _put(spark, root, base + 1, {"parts": parts, "schema": df.schema.jsonValue(), "about": about or {}})
    except Exception:
        fs.delete(path(f"{root}/{folder}"), True)
        raise
    _forget(spark, root, keep)
    return base + 1


def _part_name(folder: str) -> str:
    name = unquote(folder.split("=", 1)[1])
    return "" if name == "__HIVE_DEFAULT_PARTITION__" else name


def about_version(spark: SparkSession, root: str) -> dict:
    """What was kept with the newest version; empty before the first."""
    known = versions(spark, root)
    return _commit_of(spark, root, known[-1]).get("about", {}) if known else {}


def read_parts(spark: SparkSession, root: str, wanted: Callable[[str], bool] = lambda _: True, number: int | None = None) -> DataFrame:
    """The newest version, or one by number, of a table published by parts; parts that are not ``wanted`` are not opened."""
    known = versions(spark, root)
    if not known or (number is not None and number not in known):
        raise ValueError(f"{root} has no version {number or ''}".rstrip())
    commit = _commit_of(spark, root, number or known[-1])
    schema, folders = StructType.fromJson(commit["schema"]), sorted(f for part, f in commit["parts"].items() if wanted(part))
    return spark.read.schema(schema).parquet(*[f"{root}/{f}" for f in folders]) if folders else spark.createDataFrame([], schema)


def read_version(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The newest version, or one by number; what is published later does not change the result."""
    known = versions(spark, root)
    if not known or (number is not None and number not in known):
        raise ValueError(f"{root} has no version {number or ''}".rstrip())
    commit = _commit_of(spark, root, number or known[-1])
    return spark.read.schema(StructType.fromJson(commit["schema"])).parquet(f"{root}/{commit['folder']}")


def update(spark: SparkSession, root: str, change: Callable[[DataFrame], DataFrame], tries: int = 3, **kw) -> int:
    """Publish ``change(newest version)``; if another writer was faster, compute it anew from what that one published."""
    for left in reversed(range(tries)):
        base = versions(spark, root)[-1]
        try:
            return publish(change(read_version(spark, root, base)), root, after=base, **kw)
        except WriteConflict:
            if not left:
                raise
    raise ValueError("tries must be positive")


def upsert_into(
    spark: SparkSession, root: str, source: DataFrame, keys: Sequence[str], update_cols: Sequence[str],
    insert_only_cols: Sequence[str] = (), insert_defaults: dict[str, object] | None = None, **kw,
) -> int:
    """Merge rows into the table by key, as `merge.upsert` does, and publish the result as one version."""
    return update(spark, root, lambda target: upsert(target, source, keys, update_cols, insert_only_cols, insert_defaults), **kw)
