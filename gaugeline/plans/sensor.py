"""Sensor feed: 30-second readings with a cumulative counter. Batch unless said otherwise."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import constants, event_date, flow_direction, map_to_structs, natural_key, surrogate_key
from ..operators.config import ConnectionTemplate
from ..operators.flatten import flatten_readings, flatten_sensor_snapshot
from ..operators.order import counter_delta, latest_per_snapshot
from ..operators.quality import apply_rules
from ..operators.rollup import rollup_interval
from ..schemas import DIM_VARIABLE_FIELDS, READING_COLUMNS
from ..sources.tables import recent_view
from ..streaming.delta import stream_counter_delta
from . import rules

KEYS = ["gateway_id", "object_id"]
GAUGES = ["current_rms", "current", "dc_current", "power"]
MEASURES = [*GAUGES, "energy_cumulative", "energy_interval"]
MAX_GAP_SECONDS = 8 * 24 * 3600
REFETCH_ORDER = [("_ingested_at", "desc"), ("_source_file", "asc")]


def bronze_readings(envelopes: DataFrame) -> DataFrame:
    return flatten_readings(envelopes)


def bronze_snapshots(envelopes: DataFrame) -> DataFrame:
    return apply_rules(flatten_sensor_snapshot(envelopes), rules.SENSOR_SNAPSHOT_BRONZE)


def _canonical(bronze: DataFrame) -> DataFrame:
    return bronze.withColumnsRenamed(READING_COLUMNS)


def silver_readings(bronze: DataFrame, max_gap_seconds: int | None = MAX_GAP_SECONDS) -> DataFrame:
    """Repeated fetches removed and interval energy added, over the full order of each sensor.

    The rules run first: what they drop must not break the chain of readings.
    """
    clean = apply_rules(_canonical(bronze), rules.SENSOR_SILVER)
    order = [o for o in REFETCH_ORDER if o[0] in clean.columns]
    rows = counter_delta(
        clean, KEYS, "timestamp", "energy_cumulative", "energy_interval",
        tie_break=order or [("energy_cumulative", "asc")], max_gap_seconds=max_gap_seconds,
    )
    return rows.withColumn("silver_processing_timestamp", F.current_timestamp())


def stream_silver_readings(bronze: DataFrame) -> DataFrame:
    """The same on a stream, one state per sensor; see ``stream_counter_delta`` for late rows."""
    clean = apply_rules(_canonical(bronze), rules.SENSOR_SILVER)
    return stream_counter_delta(
        clean, KEYS, "timestamp", "energy_cumulative",
        carry=[*GAUGES, "resolution", "_rescued_data"], out="energy_interval",
        tie_break=[o for o in REFETCH_ORDER if o[0] in clean.columns],
    ).withColumn("silver_processing_timestamp", F.current_timestamp())


def fact_readings(silver: DataFrame, now: Column | None = None) -> DataFrame:
    """Stateless projection to the published fact; works on a batch and on a stream."""
    fact = silver.select(
        surrogate_key(*KEYS, strict=True).alias("sk"),
        "timestamp",
        event_date("timestamp").alias("event_date"),
        *KEYS,
        *[F.round(m, 2).alias(m) for m in MEASURES],
        (F.current_timestamp() if now is None else now).alias("gold_processing_timestamp"),
    )
    return apply_rules(fact, rules.SENSOR_FACT)


def dim_sensors(bronze: DataFrame, asset_type: str, manufacturer: str, now: Column | None = None) -> DataFrame:
    """One row per sensor and snapshot date, the last one fetched."""
    latest = latest_per_snapshot(bronze, ["gatewayId", "objectId", "snapshotDate"], REFETCH_ORDER)
    dim = latest.select(
        surrogate_key("gatewayId", "objectId", strict=True).alias("sk"),
        natural_key("gatewayId", "objectId").alias("original_id"),
        "name",
        F.col("serialNumber").alias("serial_number"),
        flow_direction("isEnergyExport").alias("direction"),
        F.col("gatewayId").alias("gateway_id"),
        F.col("gatewayIp").alias("gateway_ip"),
        F.col("gatewaySerialNumber").alias("gateway_serial_number"),
        F.col("objectId").alias("object_id"),
        F.col("modbusId").alias("modbus_id"),
        map_to_structs("variables", DIM_VARIABLE_FIELDS).alias("variables"),
        F.col("snapshotDate").alias("snapshot_date"),
    )
    dim = constants(
        dim, {"asset_type": asset_type, "manufacturer": manufacturer}, "gold_processing_timestamp", now
    )
    return apply_rules(dim, rules.DIMENSION)


def quarter_hour_view(fact: DataFrame, as_of: datetime | str, days: int = 2) -> DataFrame:
    """The last days in 15-minute buckets."""
    cols = ["sk", *KEYS, "timestamp", *MEASURES, "gold_processing_timestamp"]
    return rollup_interval(
        recent_view(fact, "timestamp", as_of, days, cols, date_col="event_date"), ["sk", *KEYS], "timestamp", 15,
        mean=GAUGES, last=["energy_cumulative"], total=["energy_interval"], newest=["gold_processing_timestamp"],
    )


def connection_template(source: str, view: str, brand: str, client: str, job: str) -> ConnectionTemplate:
    """Sensor connections: watched on the quarter-hour view."""
    return ConnectionTemplate(
        id_format=f"{source}_%s_%s", id_cols=KEYS, key="sk", metadata=KEYS, ts_col="timestamp_bucket",
        fixed={
            "type": "IoT Sensor", "data_type": "Current Sensor", "protocol": "HTTP",
            "client": client, "brand": brand, "connector": f"{source}_api", "processing_type": "Batch",
            "job_name": job, "gold_table_name": view, "expected_interval_minutes": 15,
            "aggregation_level": "quarterly", "delayed_threshold_days": 1, "offline_threshold_days": 4,
        },
        columns={"data_name": F.col("name"), "object_id": F.col("gateway_id")},
    )
