"""Connection status and its published record."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.health import status_expr
from ..functions.time import DEFAULT_ZONE, local_day_bounds, rolling_window, ts_lit
from ..schemas import CONNECTION_STATUS, struct
from .config import FactSource, active_only, answered, connection_predicate, distinct_sources, skip_already_checked
from .gaps import gaps_between
from .metrics import _as_list, connection_facts

STATIC = ["data_name", "type", "data_type", "protocol", "location", "object_id", "brand", "processing_type"]
RANK = {"ACTIVE": 0, "DELAYED": 1, "OFFLINE": 2}


def connection_status(
    connections: DataFrame,
    as_of: datetime | str,
    delayed_days: float = 2,
    offline_days: float = 4,
    out: str = "status",
) -> DataFrame:
    """Add the status of each connection.

    Needs ``last_sync_timestamp``, ``mean_completeness`` (NULL without hours), ``job_state``
    and the two threshold columns in days; the arguments are used where those are NULL.
    """
    # Microseconds, because a threshold is crossed by any fraction of a second.
    age = (F.unix_micros(ts_lit(as_of)) - F.unix_micros("last_sync_timestamp")) / F.lit(60e6)
    status = status_expr(
        age,
        F.col("mean_completeness"),
        F.coalesce(F.col("delayed_threshold_days"), F.lit(delayed_days)) * 1440,
        F.coalesce(F.col("offline_threshold_days"), F.lit(offline_days)) * 1440,
        F.coalesce(F.col("job_state") == "FAILED", F.lit(False)),
    )
    return connections.withColumn(out, status)


def _assemble(
    config: DataFrame,
    sources: Sequence[FactSource],
    facts: DataFrame,
    gaps: Column | None,
    as_of: datetime | str,
    run_id: str,
    job_state: str,
    delayed_days: float,
    offline_days: float,
) -> DataFrame:
    """Join the facts to the configuration; silent connections stay in.

    ``config`` comes from ``connection_predicate``, ``facts`` from ``connection_facts``, a row per connection. A
    connection whose interval is NULL or zero, or whose predicate or time column none of the
    sources of its table knows, or whose table cannot be read, cannot be judged: it becomes OFFLINE / ERROR with nothing else filled in.
    """
    interval = F.col("expected_interval_minutes")
    exists = F.col("gold_table_name").isin([s.table for s in sources if s.frame is not None])
    failed = F.col("gold_table_name").isin([s.table for s in sources if s.error is not None])
    joined = config.join(facts, "connection_id", "left")
    if gaps is not None:
        joined = joined.withColumn("data_gaps", F.when(exists, gaps))
        count = F.when(exists, F.when(F.col("data_gaps").isNull(), 0).otherwise(F.size("data_gaps")))
    else:
        joined = joined.withColumn("data_gaps", F.lit(None))
        count = F.lit(None)
    judged = connection_status(
        joined.withColumns({"data_gap_count": count, "job_state": F.lit(job_state)}),
        as_of, delayed_days, offline_days,
    )
    error = failed | (exists & (interval.isNull() | (interval == 0) | ~answered(sources)))
    fixed = {
        "status": F.when(error, "OFFLINE").otherwise(F.col("status")),
        "job_state": F.when(error, "ERROR").otherwise(F.col("job_state")),
        "job_run_id": F.lit(run_id),
        "checked_at": ts_lit(as_of),
    }
    plain = {"connection_id", *STATIC}
    columns = []
    for f in struct(CONNECTION_STATUS).fields:
        if f.name in plain:
            c = F.col(f.name)
        elif f.name in fixed:
            c = fixed[f.name]
        else:
            c = F.when(~F.coalesce(error, F.lit(False)), F.col(f.name))
        columns.append(c.cast(f.dataType).alias(f.name))
    return judged.select(*columns)


def status_snapshot(
    config: DataFrame,
    sources: FactSource | Sequence[FactSource],
    as_of: datetime | str,
    run_id: str,
    job_state: str = "SUCCESS",
    zone: str = DEFAULT_ZONE,
    delayed_days: float = 2,
    offline_days: float = 4,
    history: DataFrame | None = None,
    history_until: datetime | str | None = None,
) -> DataFrame:
    """One status record per connection for the previous local day, as a single plan with one scan per fact table.

    The newest record of a connection is looked for in the whole fact. Where that is too
    much to read every day, give the status ``history`` and a time ``history_until`` up to
    which its ``last_sync_timestamp`` is complete: only later facts are read then.
    """
    sources = distinct_sources(_as_list(sources))
    matched = connection_predicate(config)
    start, end = local_day_bounds(as_of, zone)
    facts = connection_facts(sources, matched, (start, end), history_until)
    if history is not None:
        earlier = history.groupBy("connection_id").agg(F.max("last_sync_timestamp").alias("_earlier"))
        facts = facts.join(earlier, "connection_id", "full").withColumn(
            "last_sync_timestamp", F.greatest("last_sync_timestamp", "_earlier")).drop("_earlier")
    return _assemble(
        matched, sources, facts, gaps_between(F.col("edges"), F.col("expected_interval_minutes"), start, end),
        as_of, run_id, job_state, delayed_days, offline_days,
    )


def streaming_status(
    config: DataFrame,
    sources: FactSource | Sequence[FactSource],
    as_of: datetime | str,
    run_id: str,
    critical_cols: Sequence[str] = (),
    ingestion_ts: str = "ingestionTimestamp",
    delayed_days: float = 0,
    offline_days: float = 1,
) -> DataFrame:
    """Status of continuously fed connections over the last 24 hours of processing time.

    With the default of 0 days any age makes a connection DELAYED; set ``delayed_days`` (a
    fraction will do) or the threshold in the configuration to allow for the refresh period.
    """
    sources = distinct_sources(_as_list(sources))
    matched = connection_predicate(config)
    facts = connection_facts(sources, matched, rolling_window(as_of), None, True, critical_cols, ingestion_ts)
    return _assemble(matched, sources, facts, None, as_of, run_id, "RUNNING", delayed_days, offline_days)


def status_of_facts(
    matched: DataFrame, sources: Sequence[FactSource], facts: DataFrame, as_of: datetime | str, run_id: str,
    delayed_days: float = 0, offline_days: float = 1,
) -> DataFrame:
    """The record of `streaming_status` from facts that were gathered elsewhere, a row per connection as `per_connection` gives."""
    return _assemble(matched, sources, facts, None, as_of, run_id, "RUNNING", delayed_days, offline_days)


def failure_status(
    config: DataFrame,
    status: DataFrame,
    as_of: datetime | str,
    run_id: str,
    missing_is_active: bool = False,
) -> DataFrame:
    """DELAYED / FAILED records for active connections without a record today, after a failed fetch."""
    waiting = skip_already_checked(active_only(config, missing_is_active), status, as_of)
    values = {
        "status": F.lit("DELAYED"),
        "job_run_id": F.lit(run_id),
        "job_state": F.lit("FAILED"),
        "checked_at": ts_lit(as_of),
    }
    plain = {"connection_id", *STATIC}
    return waiting.select(*[
        (F.col(f.name) if f.name in plain else values.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name)
        for f in struct(CONNECTION_STATUS).fields
    ])


def overall_status(status: DataFrame) -> DataFrame:
    """The worst status and how many connections have each; ACTIVE when there are none."""
    rank = F.coalesce(*[F.when(F.col("status") == s, r) for s, r in RANK.items()])
    worst = F.coalesce(F.max(rank), F.lit(0))
    counted = status.agg(
        worst.alias("_worst"),
        F.count(F.lit(1)).alias("connections"),
        *[F.count_if(F.col("status") == s).alias(s.lower()) for s in RANK],
        F.count_if(F.col("job_state") == "ERROR").alias("errors"),
    )
    name = F.coalesce(*[F.when(F.col("_worst") == r, s) for s, r in RANK.items()])
    return counted.select(name.alias("overall_status"), "connections", *[s.lower() for s in RANK], "errors")
