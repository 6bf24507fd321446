"""Periodic health refresh over a growing table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import utc
from ..operators.config import FactSource
from ..operators.status import streaming_status


def stream_health(
    stream: DataFrame,
    config: Callable[[], DataFrame],
    sources: Callable[[], Sequence[FactSource]],
    path: str,
    checkpoint: str,
    every: str | None = "15 minutes",
    as_of: Callable[[DataFrame], datetime | None] | None = None,
    critical_cols: Sequence[str] = (),
    ingestion_ts: str = "ingestionTimestamp",
    delayed_days: float = 0,
    offline_days: float = 1,
):
    """Start a query that adds a status record per connection for every micro-batch.

    ``stream`` is the trigger: each micro-batch of new facts is a refresh. ``config`` and
    ``sources`` are called per refresh, to see the tables as they are then; the status
    itself is one batch plan over the last 24 hours. ``as_of`` derives the time of the
    refresh from the batch, by default the current time; a batch for which it gives None is no
    refresh. ``every=None`` handles what is there and stops. A repeated micro-batch replaces its earlier output.
    """

    def refresh(batch: DataFrame, batch_id: int) -> None:
        now = as_of(batch) if as_of else utc(datetime.now().astimezone())
        if now is None:
            return
        status = streaming_status(
            config(), list(sources()), now, f"refresh-{batch_id}", critical_cols, ingestion_ts,
            delayed_days, offline_days,
        )
        status.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = stream.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def newest(ts: str) -> Callable[[DataFrame], datetime | None]:
    """An ``as_of`` one second after the newest value of ``ts`` in the micro-batch, None if it has none."""

    def pick(batch: DataFrame) -> datetime | None:
        micros = batch.agg(F.max(F.unix_micros(ts))).first()[0]
        if micros is None:
            return None
        return utc("1970-01-01") + timedelta(microseconds=micros + 1_000_000)

    return pick
