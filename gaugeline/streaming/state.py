"""What the stateful operators share: ordering of a group, the state timer, the late split."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from ..operators.order import Order

DEFAULT_HORIZON = "8 days"


def one_frame(frames: Iterator[pd.DataFrame]) -> pd.DataFrame:
    parts = list(frames)
    return parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)


def ordered_group(frames: Iterator[pd.DataFrame], ts: str, tie_break: Order = ()) -> pd.DataFrame:
    """All rows of a key in this micro-batch in time order.

    Spark hands a large key over in several Arrow batches in no particular order. Ordering
    each on its own would take early rows of a later batch for late data. The size is
    bounded by the micro-batch limits of the source; for larger ones, and for keys that
    dominate them, use the set-based runs in ``incremental``.
    """
    rows = one_frame(frames)
    if tie_break:
        by = [ts, *[c for c, _ in tie_break]]
        return rows.sort_values(by, ascending=[True, *[d == "asc" for _, d in tie_break]], kind="stable")
    return rows.take(np.argsort(rows[ts].to_numpy(), kind="stable"))


def keep_until(state, newest: pd.Timestamp, horizon: pd.Timedelta) -> None:
    """Let the state expire ``horizon`` after its newest event.

    A timer has to lie after the watermark, which may have passed that point when only
    late rows came in.
    """
    deadline = int((newest + horizon).timestamp() * 1000)
    state.setTimeoutTimestamp(max(deadline, state.getCurrentWatermarkMs() + 1))


def keep_earliest(state, kept: list[list]) -> None:
    """Keep the arrays of a group of keys, of which the last are deadlines, until the first of these; without keys, nothing."""
    if not kept[-1]:
        if state.exists:
            state.remove()
        return
    state.update(tuple(kept))
    state.setTimeoutTimestamp(max(min(kept[-1]), state.getCurrentWatermarkMs() + 1))


def write_with_late(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Run once over what is new; rows marked ``is_late`` go to a partition of their own.

    Each micro-batch writes into the folder of its number, so a batch repeated after a
    failure replaces its earlier attempt, and its plan runs only once.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("is_late").parquet(f"{path}/batch={batch_id}")

    (
        stream.writeStream.outputMode("append")
        .foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def read_split(spark: SparkSession, path: str, schema: StructType, late: bool = False) -> DataFrame:
    """The accepted or the late rows; the other partition is not read.

    ``schema`` is that of the stream that was written.
    """
    stored = StructType([*[f for f in schema.fields if f.name != "is_late"], StructField("batch", LongType()),
                         StructField("is_late", BooleanType())])
    rows = spark.read.schema(stored).parquet(path)
    return rows.filter(rows["is_late"] == late).drop("batch", "is_late")
