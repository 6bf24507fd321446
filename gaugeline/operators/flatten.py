"""Landing envelopes to typed rows.

``explode`` leaves out envelopes with an empty list, as intended: they hold no reading.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key
from ..schemas import BUNDLE_TIME_FORMAT, READING_VARIABLES, SNAPSHOT_DATE_FORMAT

PROVENANCE = ("_source_file", "_file_modification_time", "_ingested_at", "_rescued_data")


def _extra(df: DataFrame, names: Iterable[str] = PROVENANCE) -> list[str]:
    return [c for c in names if c in df.columns]


def flatten_readings(env: DataFrame, variables: Sequence[str] = READING_VARIABLES) -> DataFrame:
    """Envelope -> samples -> sensors: one row per (timestamp, sensor), variables as columns."""
    extra = _extra(env)
    samples = env.select(
        "resolution",
        F.col("raw_response.id").alias("gateway_id"),
        F.col("raw_response.ip").alias("gateway_ip"),
        *extra,
        F.explode("raw_response.data").alias("sample"),
    )
    sensors = samples.select(
        F.timestamp_seconds("sample.timestamp").alias("timestamp"),
        "gateway_id", "gateway_ip", "resolution", *extra,
        F.explode("sample.values").alias("sensor", "vars"),
    )
    return sensors.select(
        "timestamp",
        F.col("sensor").try_cast("int").alias("object_id"),
        *[F.col("vars")[v].try_cast("double").alias(v) for v in variables],
        "gateway_id", "gateway_ip", "resolution", *extra,
    )


def flatten_bundles(env: DataFrame) -> DataFrame:
    """One row per (account, asset, category, hour)."""
    extra = _extra(env)
    return env.select(
        F.col("account_id").alias("accountId"), "target_date", "processing_timestamp", *extra,
        F.explode("raw_response.energyassetbundles").alias("b"),
    ).select(
        "accountId", "target_date", "processing_timestamp",
        F.col("b.energyasset").alias("energyassetId"),
        F.col("b.energyassetcategory").alias("energyassetcategory"),
        F.col("b.bundle").alias("bundle"),
        F.col("b.expectedvalue").alias("expectedvalue"),
        F.try_to_timestamp("b.timestamp", F.lit(BUNDLE_TIME_FORMAT)).alias("timestamp"),
        F.col("b.value").alias("value"),
        *extra,
    )


def flatten_sensor_snapshot(env: DataFrame) -> DataFrame:
    """One row per sensor and snapshot, with the gateway header on every row."""
    extra = _extra(env)
    return env.select(
        F.try_to_timestamp("snapshot_date", F.lit(SNAPSHOT_DATE_FORMAT)).cast("date").alias("snapshotDate"),
        F.col("raw_response.id").alias("gatewayId"),
        F.col("raw_response.ip").alias("gatewayIp"),
        F.col("raw_response.serialNumber").alias("gatewaySerialNumber"),
        *extra,
        F.explode("raw_response.CurrentSensor").alias("s"),
    ).select(
        "snapshotDate", "gatewayId", "gatewayIp", "gatewaySerialNumber",
        F.col("s.name").alias("name"),
        F.col("s.object_id").alias("objectId"),
        F.col("s.is_energy_export").cast("boolean").alias("isEnergyExport"),
        F.col("s.modbus_id").alias("modbusId"),
        F.col("s.serial_number").alias("serialNumber"),
        F.col("s.variables").alias("variables"),
        *extra,
    )


def flatten_asset_snapshot(env: DataFrame) -> DataFrame:
    """One row per asset and snapshot."""
    extra = _extra(env)
    return env.select(
        F.try_to_timestamp("snapshot_date", F.lit(SNAPSHOT_DATE_FORMAT)).cast("date").alias("snapshotDate"),
        F.col("account_id").alias("accountId"), "processing_timestamp", *extra,
        F.explode("raw_response.energyassets").alias("a"),
    ).select(
        "snapshotDate", "accountId", "processing_timestamp",
        F.col("a.energyasset").alias("energyassetId"),
        F.try_to_timestamp("a.validated").alias("validated"),
        F.col("a.bundles").alias("bundles"),
        *extra,
    )


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def split_facts(wide: DataFrame, specs: dict[str, dict]) -> dict[str, DataFrame]:
    """One fact per asset class from the same wide rows.

    A spec holds ``keys``, ``metrics``, ``tag`` and optionally ``sk`` (name of the key
    column), ``ts`` and ``scale``. Rows without any of the class's metrics are left out.
    Works on a stream as well.
    """
    facts = {}
    for name, spec in specs.items():
        ts = spec.get("ts", "timestamp")
        scale = spec.get("scale", 4)
        facts[name] = wide.dropna(how="all", subset=spec["metrics"]).select(
            surrogate_key(*spec["keys"], tag=spec["tag"]).alias(spec.get("sk", "sk")),
            F.col(ts),
            F.to_date(ts).alias("event_date"),
            *spec["keys"],
            *[F.round(m, scale).alias(m) for m in spec["metrics"]],
        )
    return facts
