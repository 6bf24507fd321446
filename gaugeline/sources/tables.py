"""Tables on files: streams, snapshots, history, declared schemas, serving view."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.health import missing_data_pct
from ..functions.time import since, utc
from ..operators.quality import holds_or_stop
from ..schemas import struct


def stream_table(
    spark: SparkSession, path: str, schema: StructType | str, max_files_per_trigger: int | None = 1000
) -> DataFrame:
    """An upstream parquet table as a stream. Micro-batches are bounded, oldest files first."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def run_incremental(
    stream_df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()
) -> None:
    """Append everything that is new since the last run, then stop."""
    writer = (
        stream_df.writeStream.outputMode("append")
        .format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.start().awaitTermination()


def materialize(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Recompute a table as a whole. ``df`` must not read from ``path`` itself."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def append_history(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append rows; later rows may have more columns or struct fields than earlier ones."""
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def read_history(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """History with the union of all columns ever written.

    With a declared ``schema`` no file footers are read to find it.
    """
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.option("mergeSchema", True).parquet(path)


def conform(
    df: DataFrame, schema: StructType | str, required: Sequence[str] = (), allow_extra: bool = False
) -> DataFrame:
    """Align to a declared table: add missing columns as NULL, cast, keep comments.

    Columns the table does not have are refused unless ``allow_extra`` drops them;
    a NULL in a ``required`` column stops the job.
    """
    schema = struct(schema) if isinstance(schema, str) else schema
    extra = [c for c in df.columns if c not in schema.names]
    if extra and not allow_extra:
        raise ValueError(f"columns not in the declared table: {extra}")
    for name in required:
        df = df.filter(holds_or_stop(F.col(name).isNotNull(), f"required column {name} is NULL"))
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name, metadata=f.metadata)
        for f in schema.fields
    ])


def recent_view(
    fact: DataFrame, ts_col: str, as_of: datetime | str, days: int = 2, cols: Sequence[str] | None = None,
    date_col: str | None = None,
) -> DataFrame:
    """Rows of the last ``days`` days before ``as_of``; ``date_col`` as in ``within``."""
    recent = fact.filter(since(ts_col, utc(as_of) - timedelta(days=days), date_col))
    return recent.select(*cols) if cols else recent


def serving_projection(status: DataFrame) -> DataFrame:
    """Flat mirror for a serving database: nested arrays as JSON, derived share of missing data.

    Stateless, so it also runs on a stream of the status history.
    """
    nested = {f.name for f in status.schema.fields if f.dataType.typeName() in ("array", "struct", "map")}
    return status.select(
        *[F.to_json(c).alias(c) if c in nested else F.col(c) for c in status.columns],
        missing_data_pct(F.col("completeness_pct")).alias("missing_data_pct"),
    )
