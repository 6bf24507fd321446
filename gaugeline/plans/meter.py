"""Meter feed: hourly values, one row per category. Batch unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import constants, natural_key, surrogate_key
from ..operators.config import ConnectionTemplate
from ..operators.flatten import flatten_asset_snapshot, flatten_bundles, split_facts
from ..operators.order import latest_per_snapshot
from ..operators.pivot import pivot_categories
from ..operators.quality import apply_rules
from ..schemas import BUNDLE_CATEGORIES
from ..streaming.pivot import stream_pivot
from . import rules
from .sensor import REFETCH_ORDER

KEYS = ["account_id", "energyasset_id"]
GRID, PRODUCTION = "EConnection", "PVInstallation"
FACTS = {
    GRID: {"keys": KEYS, "metrics": ["energy_import", "energy_export"], "tag": GRID, "scale": 4},
    PRODUCTION: {"keys": KEYS, "metrics": ["energy_production"], "tag": PRODUCTION, "scale": 4},
}
FACT_RULES = {GRID: rules.GRID_FACT, PRODUCTION: rules.PRODUCTION_FACT}


def bronze_bundles(envelopes: DataFrame) -> DataFrame:
    return flatten_bundles(envelopes)


def bronze_assets(envelopes: DataFrame) -> DataFrame:
    return apply_rules(flatten_asset_snapshot(envelopes), rules.ASSET_SNAPSHOT_BRONZE)


def _canonical(bronze: DataFrame) -> DataFrame:
    return bronze.withColumnsRenamed({"accountId": "account_id", "energyassetId": "energyasset_id"})


def silver_meters(bronze: DataFrame) -> DataFrame:
    """Wide hours, complete whatever the order in which categories arrived."""
    order = [c for c in ("_ingested_at", "_source_file") if c in bronze.columns] or ["value"]
    wide = pivot_categories(
        _canonical(bronze), [*KEYS, "timestamp"], "energyassetcategory", "value", BUNDLE_CATEGORIES,
        order=order, drift="_rescued_data",
    )
    return apply_rules(wide, rules.METER_SILVER).withColumn("silver_processing_timestamp", F.current_timestamp())


def stream_silver_meters(bronze: DataFrame) -> DataFrame:
    """The same on a stream; see ``stream_pivot`` for late categories."""
    wide = stream_pivot(
        _canonical(bronze), KEYS, "timestamp", "energyassetcategory", "value", BUNDLE_CATEGORIES,
        drift="_rescued_data",
    )
    return apply_rules(wide, rules.METER_SILVER).withColumn("silver_processing_timestamp", F.current_timestamp())


def fact_meters(silver: DataFrame, now: Column | None = None) -> dict[str, DataFrame]:
    """The grid fact and the production fact; works on a batch and on a stream."""
    stamp = F.current_timestamp() if now is None else now
    return {
        name: apply_rules(fact.withColumn("gold_processing_timestamp", stamp), FACT_RULES[name])
        for name, fact in split_facts(silver, FACTS).items()
    }


def dim_assets(bronze: DataFrame, tag: str, manufacturer: str, now: Column | None = None) -> DataFrame:
    """One row per asset and snapshot date, for one asset class."""
    latest = latest_per_snapshot(bronze, ["accountId", "energyassetId", "snapshotDate"], REFETCH_ORDER)
    dim = latest.select(
        surrogate_key("accountId", "energyassetId", tag=tag, strict=True).alias("sk"),
        natural_key("accountId", "energyassetId").alias("original_id"),
        F.col("accountId").alias("account_id"),
        F.col("energyassetId").alias("energyasset_id"),
        "validated",
        F.col("snapshotDate").alias("snapshot_date"),
    )
    dim = constants(
        dim, {"asset_type": f"{manufacturer} {tag}", "manufacturer": manufacturer}, "gold_processing_timestamp", now
    )
    return apply_rules(dim, rules.DIMENSION)


def connection_template(source: str, tag: str, view: str, brand: str, client: str, job: str) -> ConnectionTemplate:
    """Meter connections of one asset class."""
    short, data_type = {GRID: ("econn", "Electricity Meter"), PRODUCTION: ("pv", "PV Installation")}[tag]
    return ConnectionTemplate(
        id_format=f"{source}_{short}_%s_%s", id_cols=KEYS, key="sk", metadata=KEYS,
        fixed={
            "type": "Energy Asset", "data_type": data_type, "protocol": "HTTP",
            "client": client, "brand": brand, "connector": f"{source}_api", "processing_type": "Batch",
            "job_name": job, "gold_table_name": view, "expected_interval_minutes": 60,
            "aggregation_level": "hourly", "delayed_threshold_days": 1, "offline_threshold_days": 4,
        },
        columns={
            "data_name": F.format_string(f"{brand} {tag} %s", F.col("energyasset_id").cast("string")),
            "object_id": F.col("energyasset_id").cast("string"),
        },
    )
