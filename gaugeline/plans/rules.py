"""Quality rules of the published tables. The rules are fixed values."""

from __future__ import annotations

from ..operators.quality import Rule

SENSOR_SILVER = [
    Rule("valid_gateway_id", "gateway_id IS NOT NULL", "fail"),
    Rule("expected_resolution", "resolution = '30s'", "fail"),
    Rule("valid_timestamp", "timestamp IS NOT NULL", "drop"),
    Rule("valid_object_id", "object_id IS NOT NULL", "drop"),
    Rule("at_least_one_value",
         "coalesce(current_rms, current, dc_current, power, energy_cumulative) IS NOT NULL", "drop"),
    Rule("no_schema_drift", "_rescued_data IS NULL"),
    Rule("non_negative_current", "current_rms IS NULL OR current_rms >= 0"),
    Rule("reasonable_current", "current_rms IS NULL OR current_rms < 1000"),
]

SENSOR_SNAPSHOT_BRONZE = [
    Rule("valid_gateway_id", "gatewayId IS NOT NULL", "fail"),
    Rule("valid_object_id", "objectId IS NOT NULL", "drop"),
    Rule("no_schema_drift", "_rescued_data IS NULL"),
]

SENSOR_FACT = [
    Rule("valid_sk", "sk IS NOT NULL", "fail"),
    Rule("valid_timestamp", "timestamp IS NOT NULL", "drop"),
    Rule("non_negative_cumulative", "energy_cumulative IS NULL OR energy_cumulative >= 0"),
    Rule("reasonable_interval_energy", "energy_interval IS NULL OR energy_interval < 5"),
    Rule("reasonable_active_power", "power IS NULL OR abs(power) < 1000000"),
]

METER_SILVER = [
    Rule("valid_account", "account_id IS NOT NULL", "fail"),
    Rule("valid_energyasset", "energyasset_id IS NOT NULL", "fail"),
    Rule("valid_timestamp", "timestamp IS NOT NULL", "drop"),
    Rule("at_least_one_metric", "coalesce(energy_production, energy_export, energy_import) IS NOT NULL", "drop"),
    Rule("no_schema_drift", "_rescued_data IS NULL"),
    Rule("non_negative_production", "energy_production IS NULL OR energy_production >= 0"),
    Rule("non_negative_export", "energy_export IS NULL OR energy_export >= 0"),
    Rule("non_negative_import", "energy_import IS NULL OR energy_import >= 0"),
]

ASSET_SNAPSHOT_BRONZE = [
    Rule("valid_account", "accountId IS NOT NULL", "fail"),
    Rule("valid_energyasset", "energyassetId IS NOT NULL", "drop"),
    Rule("valid_snapshot_date", "snapshotDate IS NOT NULL", "drop"),
    Rule("no_unexpected_drift", "_rescued_data IS NULL"),
]

GRID_FACT = [
    Rule("valid_sk", "sk IS NOT NULL", "fail"),
    Rule("valid_timestamp", "timestamp IS NOT NULL", "drop"),
    Rule("non_negative_import", "energy_import IS NULL OR energy_import >= 0"),
    Rule("non_negative_export", "energy_export IS NULL OR energy_export >= 0"),
]

PRODUCTION_FACT = [
    Rule("valid_sk", "sk IS NOT NULL", "fail"),
    Rule("valid_timestamp", "timestamp IS NOT NULL", "drop"),
    Rule("non_negative_production", "energy_production IS NULL OR energy_production >= 0"),
]

# The sensor dimension and both meter dimensions.
DIMENSION = [
    Rule("valid_sk", "sk IS NOT NULL", "fail"),
    Rule("valid_snapshot_date", "snapshot_date IS NOT NULL", "drop"),
]

# Declared keys.
FACT_KEY = ["sk", "timestamp"]
CONFIG_KEY = ["connection_id"]
