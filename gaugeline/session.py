"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_base: str | None = None


def build_session(master: str | None = None, shuffle_partitions: int | None = None, **conf) -> SparkSession:
    """A session with the settings the library is written for.

    On a cluster leave ``shuffle_partitions`` unset (or high): adaptive execution
    coalesces small partitions and splits skewed join partitions at run time.
    """
    builder = SparkSession.builder.appName("gaugeline")
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.ui.enabled": "false",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for checkpoints and intermediate tables.

    It lies in the shared folder named by ``spark.checkpoint.dir``. Only a local
    session without that setting falls back to a temporary folder of its own.
    """
    global _local_base
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if _local_base is None:
            _local_base = tempfile.mkdtemp(prefix="gaugeline-")
        base = _local_base
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
