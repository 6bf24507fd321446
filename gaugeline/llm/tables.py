"""Reading given tables and keeping intermediate ones in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.session import work_dir


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the shared folder and read it again: it is computed once and survives lost executors."""
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of at most a few dozen bytes that may go to every executor.
SENT_ROWS = 2_000_000


def sent_if_small(ids: DataFrame, purpose: str) -> DataFrame:
    """A stored table of ids for the small side of a join: broadcast up to SENT_ROWS rows, joined by a shuffle beyond.

    The rows of the join are the same either way.
    """
    ids = stored(ids, purpose)
    return F.broadcast(ids) if ids.count() <= SENT_ROWS else ids
