"""Declared schemas of landing envelopes and tables.

The names and types below are fixed values: they are the wire formats of the sources
and the columns that readers of the tables expect.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

# Wire formats.
READING_VARIABLES = (
    "currentTrms",
    "currentAc",
    "currentDc",
    "activePowerTotal",
    "activeEnergyTotal",
)

READING_COLUMNS = {
    "currentTrms": "current_rms",
    "currentAc": "current",
    "currentDc": "dc_current",
    "activePowerTotal": "power",
    "activeEnergyTotal": "energy_cumulative",
}

BUNDLE_CATEGORIES = {
    10: "energy_production",
    26: "energy_export",
    27: "energy_import",
}

SNAPSHOT_DATE_FORMAT = "yyyyMMdd"
BUNDLE_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"

READINGS_ENVELOPE = """
    target_date string, window_index bigint, begin_timestamp bigint, end_timestamp bigint,
    resolution string, processing_timestamp string,
    raw_response struct<id: string, ip: string,
        data: array<struct<timestamp: bigint, values: map<string, map<string, string>>>>>
"""

BUNDLES_ENVELOPE = """
    account_id int, target_date string, range_from string, range_to string, processing_timestamp string,
    raw_response struct<energyassetbundles: array<struct<
        energyasset: int, energyassetcategory: int, bundle: double, expectedvalue: double,
        timestamp: string, value: double>>>
"""

VARIABLE = """struct<
    category: string, dataType: string, modbusDataType: string, address: int, virtualRegisterAddress: int,
    size: int, readInterval: int, dbWriteInterval: int, dbStorePolicy: string, invalidValues: array<string>,
    multiplier: double, unit: string, writable: boolean, endianness: string, function: int,
    readable: boolean, relation: array<string>>"""

SENSOR_SNAPSHOT_ENVELOPE = f"""
    snapshot_date string, processing_timestamp string,
    raw_response struct<id: string, ip: string, serialNumber: string,
        CurrentSensor: array<struct<
            name: string, object_id: int, is_energy_export: int, modbus_id: int, serial_number: string,
            variables: map<string, {VARIABLE}>>>>
"""

ASSET_SNAPSHOT_ENVELOPE = """
    snapshot_date string, processing_timestamp string, account_id int,
    raw_response struct<energyassets: array<struct<
        energyasset: int, account: int, validated: string, bundles: map<string, array<double>>>>>
"""

# Fields of a variable that the sensor dimension publishes.
DIM_VARIABLE_FIELDS = [
    "category",
    "dataType",
    "unit",
    "multiplier",
    "dbWriteInterval",
    "dbStorePolicy",
    "readable",
    "writable",
    "invalidValues",
    "relation",
]

# Tables.
CONNECTION_CONFIG = """
    connection_id string, data_name string, type string, data_type string, protocol string, location string,
    object_id string, client string, brand string, connector string, processing_type string, job_id string,
    job_name string, gold_table_name string, expected_interval_minutes int, aggregation_level string,
    delayed_threshold_days int, offline_threshold_days int, other_metadata string,
    created_at timestamp, updated_at timestamp
"""

HOUR = """struct<hour: timestamp, data_points: int, expected_records: int, completeness_pct: double,
    duplicate_timestamps: int, null_values: int, avg_delay_minutes: double, max_delay_minutes: double,
    uptime_pct: double, total_validation_errors: int>"""

GAP = "struct<gap_start: timestamp, gap_end: timestamp, gap_duration_minutes: int, missing_records: int>"

CONNECTION_STATUS = f"""
    connection_id string, data_name string, type string, data_type string, protocol string, location string,
    object_id string, brand string, processing_type string, status string, last_sync_timestamp timestamp,
    job_run_id string, job_state string, hourly_metrics array<{HOUR}>, data_points_24h int,
    completeness_pct double, uptime_pct_24h double, avg_delay_minutes double, total_validation_errors int,
    duplicate_timestamps_24h int, null_values_24h int, data_gap_count int, data_gaps array<{GAP}>,
    checked_at timestamp
"""

PAUSE_SCHEDULE = """
    job_name string, pause_start_date date, pause_end_date date, reason string, created_by string,
    created_at timestamp, is_active boolean
"""

VOLUME_CONFIG = """
    connector_name string, client_catalog string, volume_name string, retention_days int,
    last_discovered timestamp, last_cleaned timestamp, files_deleted_last_run int, bytes_deleted_last_run bigint
"""

CLEANUP_AUDIT = """
    cleanup_timestamp timestamp, catalog_name string, volume_path string, retention_days int, data_type string,
    files_deleted int, bytes_deleted bigint, oldest_file_deleted string, connector_name string
"""

REQUIRED = {
    "connection_config": ("connection_id",),
    "connection_status": ("connection_id", "checked_at"),
}


def struct(ddl: str) -> StructType:
    """A declared schema as StructType."""
    return StructType.fromDDL(ddl)


def with_comments(schema: StructType, comments: dict[str, str]) -> StructType:
    """The schema with column comments as field metadata."""
    for field in schema.fields:
        if field.name in comments:
            field.metadata = {**field.metadata, "comment": comments[field.name]}
    return schema
