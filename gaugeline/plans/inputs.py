"""Telemetry views of the given tables: what the registered queries run on.

A sensor is (event_type, user_id) and its counter the event value; a connection is a user
or such a sensor. Everything is derived from whole tables by Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key
from ..functions.time import ts_lit
from ..operators.config import ConnectionTemplate, FactSource, build_connection_config

# Schemas of the given tables. Times are read as TIMESTAMP, so that filters on them
# need no cast and reach the scan.
TABLES = {
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}

AS_OF = "2024-01-20 12:00:00"
CHECKED_AT = "2024-01-31 12:00:00"  # after the last event
CREATED = "2024-01-01 00:00:00"
FACTS = "facts.readings"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def naive(df: DataFrame) -> DataFrame:
    """TIMESTAMP columns without zone, as the given tables store them."""
    return df.select(*[
        F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(c) for c, t in df.dtypes
    ])


def level(props: str = "props") -> Column:
    """The number in the ``props`` JSON."""
    return F.get_json_object(props, "$.k").cast("int")


def known_value() -> Column:
    """The event value, missing where the level is low: a tenth of all readings."""
    return F.when(level() >= 10, F.col("value"))


def bronze_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as bronze sensor readings, each of them fetched twice."""
    once = table(spark, sf_dir, "events").select(
        F.col("ts").alias("timestamp"),
        F.col("user_id").cast("int").alias("object_id"),
        F.col("value").alias("currentTrms"),
        (F.col("value") * 2).alias("currentAc"),
        (F.col("value") * 3).alias("currentDc"),
        (F.col("value") * 10).alias("activePowerTotal"),
        known_value().alias("activeEnergyTotal"),
        F.col("event_type").alias("gateway_id"),
        F.lit("30s").alias("resolution"),
        F.lit("first").alias("_source_file"),
        (F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("_ingested_at"),
        F.lit(None).cast("string").alias("_rescued_data"),
    )
    return refetched(once)


def refetched(once: DataFrame) -> DataFrame:
    """Every row a second time, as a fetch of the next day would bring it.

    An explode keeps it to one scan.
    """
    day = F.make_interval(days=F.col("_fetch"))
    return once.withColumn("_fetch", F.explode(F.array(F.lit(0), F.lit(1)))).withColumns({
        "_ingested_at": F.col("_ingested_at") + day,
        "_source_file": F.when(F.col("_fetch") == 0, F.col("_source_file")).otherwise("second"),
    }).drop("_fetch")


def long_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_long(table(spark, sf_dir, "events"))


def as_long(events: DataFrame) -> DataFrame:
    """Events as long meter rows: a category per row, several rows per hour."""
    return events.select(
        F.col("user_id").cast("int").alias("account_id"),
        F.date_trunc("hour", "ts").alias("timestamp"),
        F.col("event_type").alias("category"),
        known_value().alias("value"),
        F.when(level() >= 90, F.col("props")).alias("drift"),
        "event_id",
    )


CATEGORIES = {"view": "energy_production", "click": "energy_export", "purchase": "energy_import"}


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of connections: key, event time, processing and ingestion time, value."""
    return table(spark, sf_dir, "events").select(
        surrogate_key("user_id").alias("sk"),
        "ts",
        (F.col("ts") + F.make_dt_interval(secs=F.col("event_id") % 600)).alias("gold_processing_timestamp"),
        (F.col("ts") + F.make_dt_interval(secs=F.col("event_id") % 300)).alias("ingestionTimestamp"),
        known_value().alias("value"),
    )


def repeated_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts with every reading twice, so that duplicates are counted."""
    return facts(spark, sf_dir).withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("_copy")


def connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A connection per user, expected every 30 minutes, hour or day in turn."""
    users = table(spark, sf_dir, "events").select("user_id").distinct().withColumn("sk", surrogate_key("user_id"))
    template = ConnectionTemplate(
        id_format="sensor_%s", id_cols=["user_id"], key="sk", metadata=["user_id"], ts_col="ts",
        fixed={"type": "IoT Sensor", "connector": "sensor_api", "gold_table_name": FACTS,
               "delayed_threshold_days": 1, "offline_threshold_days": 4},
        columns={
            "data_name": F.format_string("User %s", F.col("user_id").cast("string")),
            "expected_interval_minutes": F.element_at(
                F.array(F.lit(30), F.lit(60), F.lit(1440)), (F.col("user_id") % 3 + 1).cast("int")
            ),
        },
    )
    return build_connection_config(users, template, CREATED)


def source(frame: DataFrame) -> FactSource:
    return FactSource(FACTS, frame, ts="ts", key_sets=(("sk",),))


def landed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a listing of landed files, one file per hour."""
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("/land/"), F.col("source"), F.lit("/"), F.col("lang"), F.lit("/"),
                 F.col("doc_id").cast("string"), F.when(F.col("lang") == "en", ".json").otherwise(".csv")
                 ).alias("path"),
        (ts_lit(CREATED) + F.make_dt_interval(hours=F.col("doc_id").cast("int"))).alias("modified_at"),
        F.col("n_chars").alias("bytes"),
        F.col("source").alias("volume_name"),
    )


def volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A volume per document source, with 10 days of retention and more for longer names."""
    return table(spark, sf_dir, "documents").select("source").distinct().select(
        F.when(F.col("source").startswith("src1"), "sensor").otherwise("meter").alias("connector_name"),
        F.lit("client").alias("client_catalog"),
        F.col("source").alias("volume_name"),
        (F.length("source") + 6).alias("retention_days"),
        ts_lit(CREATED).alias("last_discovered"),
        F.lit(None).cast("timestamp").alias("last_cleaned"),
        F.lit(0).alias("files_deleted_last_run"),
        F.lit(0).cast("bigint").alias("bytes_deleted_last_run"),
    )
