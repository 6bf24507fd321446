"""The registered queries, each with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import keys as K
from ..functions.time import local_day_window, ts_lit, within
from ..operators import config as C
from ..operators import flatten, gaps, landing, metrics, order, pivot, quality, retention, rollup, status, windows
from ..operators.quality import Rule
from ..schemas import CLEANUP_AUDIT, CONNECTION_STATUS, READINGS_ENVELOPE, struct
from ..session import work_dir
from ..sources import envelopes, merge, tables, versions
from ..streaming.delta import stream_counter_delta
from ..streaming.heal import heal_counter_delta, publish_fact, read_fact
from ..streaming.health import newest, stream_health
from ..streaming.last_seen import stream_health_from_state
from ..streaming.incremental import incremental_counter_delta, incremental_pivot
from ..streaming.pivot import stream_pivot
from ..streaming.state import read_split, write_with_late
from . import inputs as I
from . import meter, rules, sensor

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return I.naive(fn(spark, sf_dir))

        QUERIES[fn.__name__] = run
        if sql:
            ORACLE[fn.__name__] = sql
        return run

    return register


# --------------------------------------------------------------------------- sensor feed

BRONZE_SQL = """
    bronze AS (
        SELECT event_type AS gateway_id, CAST(user_id AS INTEGER) AS object_id, ts, value,
               CASE WHEN CAST(props->>'$.k' AS INTEGER) >= 10 THEN value END AS v
        FROM events
    )
"""


@query(f"""
WITH {BRONZE_SQL},
silver AS (
    SELECT *, lag(v) OVER w AS pv, lag(ts) OVER w AS pts
    FROM bronze WINDOW w AS (PARTITION BY gateway_id, object_id ORDER BY ts)
)
SELECT sha256(concat_ws('|', gateway_id, object_id)) AS sk, ts AS "timestamp", CAST(ts AS DATE) AS event_date,
       gateway_id, object_id, round(value, 2) AS current_rms, round(value * 2, 2) AS "current",
       round(value * 3, 2) AS dc_current, round(value * 10, 2) AS power, round(v, 2) AS energy_cumulative,
       round(CASE WHEN v >= pv AND floor(epoch(ts)) - floor(epoch(pts)) <= 691200 THEN v - pv END, 2)
           AS energy_interval
FROM silver
""")
def sensor_fact(spark, sf_dir):
    """Flagship: bronze readings, fetched twice, through silver rules and deltas to the fact."""
    fact = sensor.fact_readings(sensor.silver_readings(I.bronze_readings(spark, sf_dir)))
    return fact.drop("gold_processing_timestamp")


DELTA_COLUMNS = ["gateway_id", "object_id", "timestamp", "activeEnergyTotal"]


@query(f"""
WITH {BRONZE_SQL}
SELECT gateway_id, object_id, ts AS "timestamp", v AS "activeEnergyTotal",
       CASE WHEN v >= lag(v) OVER w THEN v - lag(v) OVER w END AS "interval"
FROM bronze WINDOW w AS (PARTITION BY gateway_id, object_id ORDER BY ts)
""")
def counter_delta(spark, sf_dir):
    rows = I.bronze_readings(spark, sf_dir).select(*DELTA_COLUMNS, "_ingested_at", "_source_file")
    return order.counter_delta(
        rows, ["gateway_id", "object_id"], "timestamp", "activeEnergyTotal", tie_break=sensor.REFETCH_ORDER
    ).select(*DELTA_COLUMNS, "interval")


@query(f"""
WITH {BRONZE_SQL},
known AS (
    SELECT gateway_id, object_id, ts, v, lag(v) OVER w AS pv, lag(ts) OVER w AS pts
    FROM bronze WHERE v IS NOT NULL WINDOW w AS (PARTITION BY gateway_id, object_id ORDER BY ts)
)
SELECT gateway_id, object_id, ts AS "timestamp", v AS "activeEnergyTotal",
       CASE WHEN v >= pv AND floor(epoch(ts)) - floor(epoch(pts)) <= 86400 THEN v - pv END AS "interval"
FROM known
UNION ALL
SELECT gateway_id, object_id, ts, v, NULL FROM bronze WHERE v IS NULL
""")
def counter_delta_carry(spark, sf_dir):
    """Deltas to the last known value, none over a silence of more than a day."""
    rows = I.bronze_readings(spark, sf_dir).select(*DELTA_COLUMNS, "_ingested_at", "_source_file")
    return order.counter_delta(
        rows, ["gateway_id", "object_id"], "timestamp", "activeEnergyTotal", tie_break=sensor.REFETCH_ORDER,
        carry_over_nulls=True, max_gap_seconds=86400,
    ).select(*DELTA_COLUMNS, "interval")


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # As a pattern the path may be a table folder or a single file.
    return tables.stream_table(spark, f"{sf_dir}/events.parque[t]", I.TABLES["events"])


@query("""
SELECT event_type, user_id, ts, value, event_id,
       CASE WHEN value >= lag(value) OVER w AND epoch(ts) - epoch(lag(ts) OVER w) <= 691200
            THEN value - lag(value) OVER w END AS "interval"
FROM events WINDOW w AS (PARTITION BY event_type, user_id ORDER BY ts)
""")
def counter_delta_stream(spark, sf_dir):
    """The stateful stream over all files of the table, run until it has caught up."""
    deltas = stream_counter_delta(
        _event_stream(spark, sf_dir), ["event_type", "user_id"], "ts", "value", carry=["event_id"]
    )
    out = work_dir(spark, "delta")
    write_with_late(deltas, f"{out}/table", f"{out}/checkpoint")
    return read_split(spark, f"{out}/table", deltas.schema)


@query(f"""
WITH {BRONZE_SQL}
SELECT gateway_id, object_id, ts AS "timestamp", v AS energy_cumulative,
       CASE WHEN v >= lag(v) OVER w AND floor(epoch(ts)) - floor(epoch(lag(ts) OVER w)) <= 691200
            THEN v - lag(v) OVER w END AS "interval"
FROM bronze WINDOW w AS (PARTITION BY gateway_id, object_id ORDER BY ts)
""")
def counter_delta_incremental(spark, sf_dir):
    """The same as set-based micro-batches with a state table."""
    stream = _event_stream(spark, sf_dir).select(
        F.col("event_type").alias("gateway_id"), F.col("user_id").cast("int").alias("object_id"),
        F.col("ts").alias("timestamp"), I.known_value().alias("energy_cumulative"),
    )
    out = work_dir(spark, "increment")
    incremental_counter_delta(
        stream, ["gateway_id", "object_id"], "timestamp", "energy_cumulative",
        f"{out}/table", f"{out}/state", f"{out}/checkpoint",
    )
    schema = stream.schema.add("interval", "double")
    return read_split(spark, f"{out}/table", schema)


@query("""
SELECT event_type, user_id, ts, value, event_id,
       CASE WHEN value >= lag(value) OVER w AND floor(epoch(ts)) - floor(epoch(lag(ts) OVER w)) <= 172800
            THEN value - lag(value) OVER w END AS "interval"
FROM events WINDOW w AS (PARTITION BY event_type, user_id ORDER BY ts)
""")
def late_heal(spark, sf_dir):
    """A fact published without a tenth of the readings, which come late and are healed in."""
    rows = I.table(spark, sf_dir, "events").select("event_type", "user_id", "ts", "value", "event_id")
    keys, late = ["event_type", "user_id"], F.col("event_id") % 10 == 0
    root = work_dir(spark, "healed")
    publish_fact(order.counter_delta(rows.filter(~late), keys, "ts", "value", max_gap_seconds=172_800), root, "ts")
    heal_counter_delta(spark, root, rows.filter(late), keys, "ts", "value", max_gap_seconds=172_800)
    return read_fact(spark, root).drop("event_date")


MOVING = 6  # micro-batches
MOVING_HOURS = 36  # a horizon short enough for keys to fall silent


def _batch_number() -> str:
    """The micro-batch of an event: by time, but every ninth comes with the next but one."""
    return f"least({MOVING - 1}, CAST(floor((epoch(ts) - epoch(TIMESTAMP '2024-01-01')) / 86400 / 5) AS BIGINT) + CASE WHEN event_id % 9 = 0 THEN 2 ELSE 0 END)"


def _moving_sql() -> str:
    """Each micro-batch against what the ones before have left: last accepted reading per key, the newest time of all, and keys
    that two horizons of silence have made forgotten."""
    parts = [f"ev AS (SELECT event_type, user_id, ts, value, event_id, {_batch_number()} AS batch FROM events)",
             "s0 AS (SELECT event_type, user_id, ts AS last_ts, value AS last_v FROM ev WHERE FALSE)"]
    for b in range(MOVING):
        parts.append(f"""
        r{b} AS (SELECT e.*, l.last_ts, l.last_v, coalesce(e.ts <= l.last_ts, FALSE)
                 OR coalesce(e.ts < (SELECT max(last_ts) - INTERVAL {MOVING_HOURS} HOUR FROM s{b}), FALSE) AS is_late
                 FROM ev e LEFT JOIN (SELECT * FROM s{b} WHERE last_ts >= (SELECT max(last_ts) - INTERVAL {2 * MOVING_HOURS} HOUR FROM s{b})) l
                 USING (event_type, user_id) WHERE batch = {b}),
        a{b} AS (SELECT *, coalesce(lag(value) OVER (PARTITION BY event_type, user_id ORDER BY ts), last_v) AS pv FROM r{b} WHERE NOT is_late),
        s{b + 1} AS (SELECT event_type, user_id, max(last_ts) AS last_ts, arg_max(last_v, last_ts) AS last_v
                 FROM (SELECT * FROM s{b} UNION ALL SELECT event_type, user_id, ts, value FROM a{b}) GROUP BY ALL)""")
    rows = [f"SELECT event_type, user_id, ts, value, event_id, FALSE AS is_late, CASE WHEN value >= pv THEN value - pv END AS \"interval\" FROM a{b} "
            f"UNION ALL SELECT event_type, user_id, ts, value, event_id, TRUE, NULL FROM r{b} WHERE is_late" for b in range(MOVING)]
    return "WITH " + ",".join(parts) + " " + " UNION ALL ".join(rows)


@query(_moving_sql())
def moving_event_time(spark, sf_dir):
    """Ordered micro-batches: the newest time advances, state is carried on and forgotten, and late rows have a table of their own."""
    day = F.floor((F.unix_timestamp("ts") - F.unix_timestamp(ts_lit("2024-01-01"))) / 86_400 / 5)
    number = F.least(F.lit(MOVING - 1), day + F.when(F.col("event_id") % 9 == 0, 2).otherwise(0))
    events = I.table(spark, sf_dir, "events").select("event_type", "user_id", "ts", "value", "event_id")
    out = work_dir(spark, "moving")
    for b in range(MOVING):
        events.filter(number == b).write.mode("append").parquet(f"{out}/events")
        incremental_counter_delta(
            tables.stream_table(spark, f"{out}/events", events.schema), ["event_type", "user_id"], "ts", "value", f"{out}/table", f"{out}/state",
            f"{out}/checkpoint", horizon=f"{MOVING_HOURS} hours", max_gap_seconds=None)
    schema = struct("event_type string, user_id bigint, ts timestamp, value double, event_id bigint, interval double")
    return metrics.union_all([read_split(spark, f"{out}/table", schema, late).withColumn("is_late", F.lit(late)) for late in (False, True)])


@query("""
SELECT sha256(concat_ws('|', event_type, user_id)) AS sk, ts, CAST(ts AS DATE) AS event_date,
       event_type, user_id, round(value, 2) AS value
FROM events
""")
def sensor_fact_stream(spark, sf_dir):
    """Stateless projection of a stream to a fact table."""
    stream = _event_stream(spark, sf_dir).select(
        K.surrogate_key("event_type", "user_id").alias("sk"), "ts", K.event_date("ts").alias("event_date"),
        "event_type", "user_id", F.round("value", 2).alias("value"),
    )
    out = work_dir(spark, "fact")
    tables.run_incremental(stream, f"{out}/table", f"{out}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{out}/table")


@query("""
SELECT event_type, user_id, to_timestamp(floor(epoch(ts) / 900) * 900)::TIMESTAMP AS timestamp_bucket,
       round(avg(value), 6) AS value, max(value) AS counter, round(sum(value), 6) AS total,
       max(ts) AS newest
FROM events GROUP BY ALL
""")
def rollup_15min(spark, sf_dir):
    rows = I.table(spark, sf_dir, "events").select(
        "event_type", "user_id", "ts", "value", F.col("value").alias("counter"), F.col("value").alias("total"),
        F.col("ts").alias("newest"),
    )
    return rollup.rollup_interval(
        rows, ["event_type", "user_id"], "ts", 15, mean=["value"], last=["counter"], total=["total"],
        newest=["newest"], scale=6,
    )


@query("""
SELECT event_id, ts, user_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-18 12:00:00'
""")
def recent_view(spark, sf_dir):
    return tables.recent_view(
        I.table(spark, sf_dir, "events"), "ts", I.AS_OF, 2, ["event_id", "ts", "user_id", "value"]
    )


# --------------------------------------------------------------------------- meter feed

LONG_SQL = """
    long AS (
        SELECT CAST(user_id AS INTEGER) AS account_id, date_trunc('hour', ts)::TIMESTAMP AS "timestamp",
               event_type AS category, event_id,
               CASE WHEN CAST(props->>'$.k' AS INTEGER) >= 10 THEN value END AS v,
               CASE WHEN CAST(props->>'$.k' AS INTEGER) >= 90 THEN props END AS drift
        FROM events WHERE event_type IN ('view', 'click', 'purchase')
    ),
    wide AS (
        SELECT account_id, "timestamp",
               arg_min(v, event_id) FILTER (category = 'view' AND v IS NOT NULL) AS energy_production,
               arg_min(v, event_id) FILTER (category = 'click' AND v IS NOT NULL) AS energy_export,
               arg_min(v, event_id) FILTER (category = 'purchase' AND v IS NOT NULL) AS energy_import,
               arg_min(drift, event_id) FILTER (drift IS NOT NULL) AS drift
        FROM long GROUP BY ALL
        HAVING count(v) > 0
    )
"""


@query(f"WITH {LONG_SQL} SELECT * FROM wide")
def pivot_wide(spark, sf_dir):
    return pivot.pivot_categories(
        I.long_readings(spark, sf_dir), ["account_id", "timestamp"], "category", "value", I.CATEGORIES,
        ["event_id"], drift="drift",
    )


def _long_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.as_long(_event_stream(spark, sf_dir))


@query(f"WITH {LONG_SQL} SELECT * FROM wide")
def pivot_wide_stream(spark, sf_dir):
    wide = stream_pivot(
        _long_stream(spark, sf_dir), ["account_id"], "timestamp", "category", "value", I.CATEGORIES,
        tie_break=[("event_id", "asc")], drift="drift",
    )
    out = work_dir(spark, "pivot")
    write_with_late(wide, f"{out}/table", f"{out}/checkpoint")
    return read_split(spark, f"{out}/table", wide.schema)


@query(f"WITH {LONG_SQL} SELECT * FROM wide")
def pivot_wide_incremental(spark, sf_dir):
    """The same as set-based micro-batches with a state table."""
    out = work_dir(spark, "pivoting")
    stream = _long_stream(spark, sf_dir)
    incremental_pivot(
        stream, ["account_id"], "timestamp", "category", "value", I.CATEGORIES, ["event_id"],
        f"{out}/table", f"{out}/state", f"{out}/checkpoint", drift="drift",
    )
    schema = struct("account_id int, timestamp timestamp, energy_production double, energy_export double, "
                    "energy_import double, drift string")
    return read_split(spark, f"{out}/table", schema)


@query(f"""
WITH {LONG_SQL}
SELECT 'EConnection' AS asset_class, sha256(concat_ws('|', account_id, 'EConnection')) AS sk, "timestamp",
       CAST("timestamp" AS DATE) AS event_date, account_id, round(energy_import, 4) AS energy_import,
       round(energy_export, 4) AS energy_export, NULL::DOUBLE AS energy_production
FROM wide WHERE energy_import IS NOT NULL OR energy_export IS NOT NULL
UNION ALL
SELECT 'PVInstallation', sha256(concat_ws('|', account_id, 'PVInstallation')), "timestamp",
       CAST("timestamp" AS DATE), account_id, NULL, NULL, round(energy_production, 4)
FROM wide WHERE energy_production IS NOT NULL
""")
def split_facts(spark, sf_dir):
    wide = pivot_wide.__wrapped__(spark, sf_dir)
    specs = {name: {**spec, "keys": ["account_id"]} for name, spec in meter.FACTS.items()}
    made = flatten.split_facts(wide, specs)
    return metrics.union_all([
        made[name].select(
            F.lit(name).alias("asset_class"), "sk", "timestamp", "event_date", "account_id",
            *[(F.col(m) if m in made[name].columns else F.lit(None).cast("double")).alias(m)
              for m in ("energy_import", "energy_export", "energy_production")],
        )
        for name in specs
    ])


# --------------------------------------------------------------------------- landing

@query("""
SELECT make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000) AS "timestamp",
       CAST(user_id AS INTEGER) AS object_id, value AS "currentTrms", value * 10 AS "activePowerTotal",
       event_type AS gateway_id, '30s' AS resolution
FROM events
""")
def envelope_roundtrip(spark, sf_dir):
    """Events landed as JSON envelopes, scanned again with the declared schema and flattened."""
    root = work_dir(spark, "land")
    land_events(spark, sf_dir, root)
    scanned = envelopes.with_provenance(
        envelopes.scan_envelopes(spark, root, READINGS_ENVELOPE, one_per_file=False)
    )
    return flatten.flatten_readings(scanned).select(
        "timestamp", "object_id", "currentTrms", "activePowerTotal", "gateway_id", "resolution"
    )


def land_events(spark: SparkSession, sf_dir: str, root: str) -> None:
    """An envelope per reading, in the folders of its gateway and day."""
    seconds = F.unix_timestamp("ts")
    sample = F.struct(
        seconds.alias("timestamp"),
        F.create_map(
            F.col("user_id").cast("string"),
            F.create_map(
                F.lit("currentTrms"), F.col("value").cast("string"),
                F.lit("activePowerTotal"), (F.col("value") * 10).cast("string"),
            ),
        ).alias("values"),
    )
    envelopes.write_envelopes(
        I.table(spark, sf_dir, "events").select(
            F.col("event_type").alias("entity"),
            F.date_format("ts", "yyyyMMdd").alias("day"),
            F.date_format("ts", "yyyy-MM-dd").alias("target_date"),
            F.floor(F.hour("ts") / 8).alias("window_index"),
            seconds.alias("begin_timestamp"), seconds.alias("end_timestamp"),
            F.lit("30s").alias("resolution"),
            F.date_format("ts", "yyyyMMdd_HHmmss").alias("processing_timestamp"),
            F.struct(F.col("event_type").alias("id"), F.lit("-").alias("ip"), F.array(sample).alias("data"))
            .alias("raw_response"),
        ),
        root, "entity", "data", "day",
    )


@query("""
SELECT DISTINCT event_type AS entity, 'data' AS kind, strftime(ts, '%Y%m%d') AS day, TRUE AS has_bytes FROM events
""")
def list_landed(spark, sf_dir):
    root = work_dir(spark, "listing")
    land_events(spark, sf_dir, root)
    return envelopes.list_landed(spark, root).groupBy("entity", "kind", "day").agg(
        (F.sum("bytes") > 0).alias("has_bytes")
    )


@query("""
SELECT event_type AS entity, strftime(ts, '%Y%m%d') AS day, count(*) AS envelopes, TRUE AS dated FROM events GROUP BY ALL
""")
def envelope_provenance(spark, sf_dir):
    """Where each envelope was read from, and that file and reading have their times."""
    root = work_dir(spark, "provenance")
    land_events(spark, sf_dir, root)
    rows = envelopes.with_provenance(envelopes.scan_envelopes(spark, root, READINGS_ENVELOPE, one_per_file=False))
    part = [F.regexp_extract("_source_file", r"/entity=([^/]+)/kind=data/day=(\d{8})/[^/]+$", i) for i in (1, 2)]
    dated = F.col("_file_modification_time").isNotNull() & (F.col("_file_modification_time") <= F.col("_ingested_at"))
    return rows.groupBy(part[0].alias("entity"), part[1].alias("day")).agg(F.count(F.lit(1)).alias("envelopes"), F.every(dated).alias("dated"))


@query("""
SELECT event_type AS entity, strftime(ts, '%Y%m%d') AS day, count(*) AS envelopes
FROM events WHERE event_type <> 'view' AND strftime(ts, '%Y%m%d') BETWEEN '20240105' AND '20240110' GROUP BY ALL
""")
def scan_landed(spark, sf_dir):
    """Envelopes of some entities and days; the folders of all others are left alone."""
    root = work_dir(spark, "pruned")
    land_events(spark, sf_dir, root)
    rows = envelopes.scan_landed(
        spark, root, READINGS_ENVELOPE, F.col("entity") != "view", F.col("kind") == "data", F.col("day").between("20240105", "20240110"), one_per_file=False)
    return rows.groupBy("entity", "day").agg(F.count(F.lit(1)).alias("envelopes"))


@query("""
SELECT CAST(user_id AS INTEGER) AS "accountId", CAST(event_id AS INTEGER) AS "energyassetId",
       CASE event_type WHEN 'view' THEN 10 WHEN 'click' THEN 26 ELSE 27 END AS energyassetcategory,
       make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000) AS "timestamp", value
FROM events WHERE event_type IN ('view', 'click', 'purchase')
""")
def bundle_flatten(spark, sf_dir):
    """Hourly bundles from envelopes, limited to the three categories in use."""
    category = F.when(F.col("event_type") == "view", 10).when(F.col("event_type") == "click", 26)
    category = category.when(F.col("event_type") == "purchase", 27).otherwise(99)
    env = I.table(spark, sf_dir, "events").select(
        F.col("user_id").cast("int").alias("account_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("target_date"),
        F.date_format("ts", "yyyyMMdd_HHmmss").alias("processing_timestamp"),
        F.struct(F.array(F.struct(
            F.col("event_id").cast("int").alias("energyasset"), category.alias("energyassetcategory"),
            F.lit(1.0).alias("bundle"), F.lit(0.0).alias("expectedvalue"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"), "value",
        )).alias("energyassetbundles")).alias("raw_response"),
    )
    return flatten.flatten_bundles(env).filter(F.col("energyassetcategory").isin(10, 26, 27)).select(
        "accountId", "energyassetId", "energyassetcategory", "timestamp", "value"
    )


@query("""
WITH snaps AS (
    SELECT CAST(ts AS DATE) AS snapshot_date, event_type AS gateway_id, CAST(user_id AS INTEGER) AS object_id,
           arg_max(value, ts) AS multiplier, arg_max(event_id, ts) AS modbus_id
    FROM events GROUP BY ALL
)
SELECT sha256(concat_ws('|', gateway_id, object_id)) AS sk, concat_ws('|', gateway_id, object_id) AS original_id,
       'sensor ' || object_id AS name, CASE WHEN object_id % 2 = 1 THEN 'Export' ELSE 'Import' END AS direction,
       gateway_id, object_id, CAST(modbus_id AS INTEGER) AS modbus_id, snapshot_date,
       'power' AS variable, 'W' AS unit, multiplier, 'Current Sensor' AS asset_type, 'Maker' AS manufacturer
FROM snaps
""")
def sensor_dim(spark, sf_dir):
    """Snapshot envelopes to the sensor dimension, its variables as an array of structs."""
    events = I.table(spark, sf_dir, "events")
    variable = F.struct(*[
        (F.lit("W") if n == "unit" else F.col("value") if n == "multiplier" else F.lit(None).cast(t)).alias(n)
        for n, t in [
            ("category", "string"), ("dataType", "string"), ("unit", "string"), ("multiplier", "double"),
            ("dbWriteInterval", "int"), ("dbStorePolicy", "string"), ("readable", "boolean"),
            ("writable", "boolean"), ("invalidValues", "array<string>"), ("relation", "array<string>"),
        ]
    ])
    sensor_struct = F.struct(
        F.concat(F.lit("sensor "), F.col("user_id").cast("string")).alias("name"),
        F.col("user_id").cast("int").alias("object_id"),
        (F.col("user_id") % 2).cast("int").alias("is_energy_export"),
        F.col("event_id").cast("int").alias("modbus_id"),
        F.lit("s").alias("serial_number"),
        F.create_map(F.lit("power"), variable).alias("variables"),
    )
    env = events.select(
        F.date_format("ts", "yyyyMMdd").alias("snapshot_date"),
        F.struct(F.col("event_type").alias("id"), F.lit("-").alias("ip"), F.lit("g").alias("serialNumber"),
                 F.array(sensor_struct).alias("CurrentSensor")).alias("raw_response"),
        F.lit("f").alias("_source_file"), F.col("ts").alias("_ingested_at"),
        F.lit(None).cast("string").alias("_rescued_data"),
    )
    dim = sensor.dim_sensors(sensor.bronze_snapshots(env), "Current Sensor", "Maker")
    return dim.select(
        "sk", "original_id", "name", "direction", "gateway_id", "object_id", "modbus_id", "snapshot_date",
        F.explode("variables").alias("v"), "asset_type", "manufacturer",
    ).select("*", F.col("v.name").alias("variable"), F.col("v.unit").alias("unit"),
             F.col("v.multiplier").alias("multiplier")).drop("v")


@query("""
WITH snaps AS (
    SELECT CAST(ts AS DATE) AS snapshot_date, CAST(user_id AS INTEGER) AS account_id, max(ts) AS validated
    FROM events GROUP BY ALL
)
SELECT t.tag AS asset_class, sha256(concat_ws('|', account_id, account_id, t.tag)) AS sk,
       account_id, date_trunc('second', validated)::TIMESTAMP AS validated, snapshot_date
FROM snaps, (VALUES ('EConnection'), ('PVInstallation')) t(tag)
""")
def asset_dims(spark, sf_dir):
    """Asset snapshots to the grid and the production dimension."""
    env = I.table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyyMMdd").alias("snapshot_date"),
        F.lit("-").alias("processing_timestamp"),
        F.col("user_id").cast("int").alias("account_id"),
        F.struct(F.array(F.struct(
            F.col("user_id").cast("int").alias("energyasset"), F.col("user_id").cast("int").alias("account"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("validated"),
            F.create_map(F.lit("10"), F.array("value")).alias("bundles"),
        )).alias("energyassets")).alias("raw_response"),
        F.lit("f").alias("_source_file"), F.col("ts").alias("_ingested_at"),
        F.lit(None).cast("string").alias("_rescued_data"),
    )
    bronze = meter.bronze_assets(env)
    return metrics.union_all([
        meter.dim_assets(bronze, tag, "Maker").select(
            F.lit(tag).alias("asset_class"), "sk", "account_id", "validated", "snapshot_date"
        )
        for tag in (meter.GRID, meter.PRODUCTION)
    ])


@query("""
SELECT event_id, user_id, CAST(NULL AS INTEGER) AS event_type,
       CAST(value AS DOUBLE) AS value, props AS rescued_props, event_type AS rescued_type, 2 AS n_rescued
FROM events
""")
def drift_column(spark, sf_dir):
    """JSON text parsed with a schema that lacks a field, has one of the wrong type, and allows another."""
    events = I.table(spark, sf_dir, "events")
    text = events.select(F.to_json(F.struct(
        "event_id", "event_type", "props",
        F.struct("user_id", "value", F.lit("x").alias("note")).alias("body"),
    )).alias("value"))
    parsed = envelopes.with_drift_column(
        text, "event_id bigint, event_type int, body struct<user_id: bigint, value: double>", allowed=["body.note"]
    )
    rescued = F.from_json("_rescued_data", "map<string, string>")
    return parsed.select(
        "event_id", "body.user_id", "event_type", "body.value",
        rescued["props"].alias("rescued_props"), rescued["event_type"].alias("rescued_type"),
        F.size(rescued).alias("n_rescued"),
    )


SAMPLES_SQL = """
    k AS (
        SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_id, event_type, value,
               CAST(props->>'$.k' AS INTEGER) AS level,
               row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) - 1 AS i
        FROM events
    )
"""


def _sampled_envelopes(spark, sf_dir) -> DataFrame:
    """A JSON envelope per user and day: its samples in order, some with a text for a number or with a note, and a map of limits."""
    events = I.table(spark, sf_dir, "events").select("user_id", F.to_date("ts").cast("string").alias("day"), F.struct(
        "ts", "event_id", "event_type", "value", I.level().alias("level")).alias("e"))
    days = events.groupBy("user_id", "day").agg(F.array_sort(F.collect_list("e")).alias("e"))
    first = F.col("e")[0]
    samples = F.transform("e", lambda e: F.concat(
        F.lit('{"id":'), e["event_id"], F.lit(',"value":'), F.when(e["level"] < 10, '"n/a"').otherwise(e["value"].cast("string")),
        F.when(e["level"] >= 90, F.concat(F.lit(',"note":"x'), e["event_id"], F.lit('"'))).otherwise(""), F.lit("}")))
    limit = F.concat(F.lit('"'), first["event_type"], F.lit('":{"unit":"W","hi":'),
                     F.when(first["level"] < 50, '"low"').otherwise(first["level"].cast("string")), F.lit("}"))
    return days.select(F.concat(
        F.lit('{"user_id":'), "user_id", F.lit(',"day":"'), "day", F.lit('","samples":['), F.array_join(samples, ","),
        F.lit('],"limits":{'), limit, F.lit("}}")).alias("value"))


SAMPLED = "user_id bigint, day string, samples array<struct<id: bigint, value: double>>, limits map<string, struct<hi: int>>"


@query(f"""
WITH {SAMPLES_SQL}
SELECT user_id, day, 'samples[' || i || '].value' AS path, 'n/a' AS raw FROM k WHERE level < 10
UNION ALL
SELECT user_id, day, 'samples[]', '[' || string_agg('{{"note":"x' || event_id || '"}}', ',' ORDER BY i) || ']'
FROM k WHERE level >= 90 GROUP BY ALL
UNION ALL
SELECT user_id, day, 'limits.' || event_type || '.hi', 'low' FROM k WHERE i = 0 AND level < 50
UNION ALL
SELECT user_id, day, 'limits.' || event_type || '.unit', 'W' FROM k WHERE i = 0
""")
def drift_nested(spark, sf_dir):
    """What is left over within the samples of an array and the values of a map."""
    parsed = envelopes.with_drift_column(_sampled_envelopes(spark, sf_dir), SAMPLED)
    return parsed.select("user_id", "day", F.explode(F.from_json("_rescued_data", "map<string, string>")).alias("path", "raw"))


@query(f"""
WITH {SAMPLES_SQL}
SELECT user_id, day, event_id AS id, CASE WHEN level >= 10 THEN value END AS value,
       first_value(event_type) OVER w AS kind, CASE WHEN first_value(level) OVER w >= 50 THEN first_value(level) OVER w END AS hi
FROM k WINDOW w AS (PARTITION BY user_id, day ORDER BY i)
""")
def drift_typed(spark, sf_dir):
    """What fits the declared types of the same envelopes."""
    parsed = envelopes.with_drift_column(_sampled_envelopes(spark, sf_dir), SAMPLED)
    limits = F.map_entries("limits")[0]
    return parsed.select("user_id", "day", F.explode("samples").alias("s"), limits["key"].alias("kind"), limits["value"]["hi"].alias("hi")).select(
        "user_id", "day", "s.id", "s.value", "kind", "hi")


LOG_SQL = "SELECT event_type AS entity, CAST(props->>'$.k' AS INTEGER) AS k FROM events"


@query(f"""
SELECT entity, count(*) AS fetches, count_if(k >= 10) AS files,
       CAST(coalesce(sum(k) FILTER (k >= 10), 0) AS BIGINT) AS samples, count_if(k < 10) AS errors,
       grouping(entity) = 1 AS is_total
FROM ({LOG_SQL}) GROUP BY ROLLUP (entity)
""")
def landing_summary(spark, sf_dir):
    log = I.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("entity"), I.level().alias("samples"),
        F.when(I.level() >= 10, "success").otherwise("error").alias("status"),
    )
    return landing.landing_summary(log)


@query(f"SELECT entity, k AS samples, 'error' AS status FROM ({LOG_SQL}) WHERE k < 10")
def landing_errors(spark, sf_dir):
    log = I.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("entity"), I.level().alias("samples"),
        F.when(I.level() >= 10, "success").otherwise("error").alias("status"),
    )
    return landing.landing_errors(log)


@query("""
WITH users AS (
    SELECT user_id, date_trunc('day', min(ts)) AS a, date_trunc('day', max(ts)) AS b FROM events GROUP BY user_id
),
slots AS (
    SELECT user_id, unnest(generate_series(a::TIMESTAMP, b::TIMESTAMP + INTERVAL 16 HOUR, INTERVAL 8 HOUR))
           AS slot_start FROM users
)
SELECT user_id, slot_start, CAST(slot_start AS DATE) AS slot_day,
       CAST(hour(slot_start) // 8 AS INTEGER) AS slot_index,
       slot_start + INTERVAL 8 HOUR - INTERVAL 1 SECOND AS slot_end
FROM slots
""")
def expected_slots(spark, sf_dir):
    return _slots(spark, sf_dir)


def _slots(spark, sf_dir):
    users = I.table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.date_trunc("day", F.min("ts")).alias("a"), F.date_trunc("day", F.max("ts")).alias("b")
    )
    return windows.expected_slots(
        users, F.col("a"), F.col("b") + F.expr("INTERVAL 24 HOURS"), hours=8
    ).drop("a", "b")


@query("""
WITH users AS (
    SELECT user_id, date_trunc('day', min(ts)) AS a, date_trunc('day', max(ts)) AS b FROM events GROUP BY user_id
),
slots AS (
    SELECT user_id, unnest(generate_series(a::TIMESTAMP, b::TIMESTAMP + INTERVAL 16 HOUR, INTERVAL 8 HOUR))
           AS slot_start FROM users
)
SELECT user_id, slot_start FROM slots s
WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = s.user_id
                  AND e.ts >= slot_start AND e.ts < slot_start + INTERVAL 8 HOUR)
""")
def landing_backlog(spark, sf_dir):
    landed = I.table(spark, sf_dir, "events").select(
        "user_id", F.to_date("ts").alias("slot_day"), F.floor(F.hour("ts") / 8).cast("int").alias("slot_index")
    )
    return windows.landing_backlog(
        _slots(spark, sf_dir), landed, ["user_id", "slot_day", "slot_index"]
    ).select("user_id", "slot_start")


# --------------------------------------------------------------------------- order, keys, joins

@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, l_shipdate
FROM lineitem
QUALIFY row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
             l_returnflag, l_linestatus) = 1
""")
def latest_snapshot(spark, sf_dir):
    ties = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
            "l_linestatus"]
    return order.latest_per_snapshot(
        I.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"],
        [("l_shipdate", "desc"), *[(c, "asc") for c in ties]],
    )


@query("""
SELECT * FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
""")
def latest_inventory(spark, sf_dir):
    return order.latest_inventory(
        I.table(spark, sf_dir, "orders"), ["o_custkey"], [("o_orderdate", "desc"), ("o_orderkey", "desc")]
    )


@query("""
SELECT c_custkey, c_name, count(o_orderkey) AS orders, round(coalesce(sum(o_totalprice), 0), 2) AS total
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL
""")
def materialized_view(spark, sf_dir):
    """A fully recomputed table, written and read back."""
    totals = I.table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum("o_totalprice").alias("total")
    )
    view = I.table(spark, sf_dir, "customer").select("c_custkey", "c_name").join(totals, "c_custkey", "left")
    path = work_dir(spark, "view")
    tables.materialize(view.select(
        "c_custkey", "c_name", F.coalesce("orders", F.lit(0)).alias("orders"),
        F.round(F.coalesce("total", F.lit(0.0)), 2).alias("total"),
    ), path)
    return spark.read.schema("c_custkey bigint, c_name string, orders bigint, total double").parquet(path)


@query("""
WITH first AS (SELECT c_custkey, count(o_orderkey) AS orders, round(coalesce(sum(o_totalprice), 0), 2) AS total, 'first' AS note
               FROM customer LEFT JOIN orders ON o_custkey = c_custkey WHERE c_custkey % 3 <> 0 GROUP BY ALL),
second AS (SELECT c.c_custkey, coalesce(f.orders, 0) + CASE WHEN c_custkey % 3 <> 1 THEN 1000 ELSE 0 END AS orders,
                  coalesce(f.total, -1) AS total, coalesce(f.note, 'second') AS note
           FROM customer c LEFT JOIN first f USING (c_custkey))
SELECT 'begun' AS reader, * FROM first
UNION ALL SELECT 'after a write', * FROM second
UNION ALL SELECT 'after a failed write', * FROM second
UNION ALL SELECT 'by number', * FROM first
""")
def published_versions(spark, sf_dir):
    """What readers see of a table while it is merged into, and after a write that fails."""
    customers, orders = I.table(spark, sf_dir, "customer"), I.table(spark, sf_dir, "orders")
    totals = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    counted = customers.filter("c_custkey % 3 <> 0").select("c_custkey").join(totals, "c_custkey", "left")
    root = work_dir(spark, "published")
    versions.publish(counted.select(
        "c_custkey", F.coalesce("orders", F.lit(0)).alias("orders"), F.coalesce("total", F.lit(0.0)).alias("total"), F.lit("first").alias("note")), root)
    begun = versions.read_version(spark, root)
    more = customers.filter("c_custkey % 3 <> 1").select("c_custkey").join(begun.select("c_custkey", "orders"), "c_custkey", "left")
    more = more.select("c_custkey", (F.coalesce("orders", F.lit(0)) + 1000).alias("orders"))
    versions.upsert_into(spark, root, more, ["c_custkey"], ["orders"], insert_defaults={"total": -1.0, "note": "second"})
    after = versions.read_version(spark, root)
    bad = after.withColumn("orders", F.when(F.col("c_custkey") > 5, F.raise_error(F.lit("stop")).cast("bigint")).otherwise(F.col("orders")))
    try:
        versions.publish(bad, root)
    except Exception as stopped:  # the write is meant to fail, but only as told
        if "stop" not in str(stopped):
            raise
    seen = {"begun": begun, "after a write": after, "after a failed write": versions.read_version(spark, root), "by number": versions.read_version(spark, root, 1)}
    return metrics.union_all([df.withColumn("reader", F.lit(name)) for name, df in seen.items()])


@query("""
SELECT event_id, 'k' AS name, CAST(props->>'$.k' AS INTEGER) AS level, value AS multiplier FROM events
""")
def map_to_structs(spark, sf_dir):
    events = I.table(spark, sf_dir, "events")
    variables = F.transform_values(
        F.from_json("props", "map<string, int>"),
        lambda k, v: F.struct(v.alias("level"), F.col("value").alias("multiplier"), F.lit("x").alias("unused")),
    )
    structs = events.select("event_id", "value", variables.alias("m")).select(
        "event_id", F.explode(K.map_to_structs("m", ["level", "multiplier"])).alias("v")
    )
    return structs.select("event_id", "v.name", "v.level", "v.multiplier")


@query("""
SELECT sha256(concat_ws('|', o_custkey)) AS sk, o_orderkey, o_totalprice, c_name, c_mktsegment,
       CASE WHEN c_acctbal < 0 THEN 'Export' ELSE 'Import' END AS direction
FROM orders LEFT JOIN customer ON o_custkey = c_custkey
""")
def fact_dim_join(spark, sf_dir):
    """Facts with their dimension row over the surrogate key."""
    facts = I.table(spark, sf_dir, "orders").select(
        K.surrogate_key("o_custkey").alias("sk"), "o_orderkey", "o_totalprice"
    )
    dim = I.table(spark, sf_dir, "customer").select(
        K.surrogate_key("c_custkey").alias("sk"), "c_name", "c_mktsegment",
        K.flow_direction(F.col("c_acctbal") < 0).alias("direction"),
    )
    return facts.join(dim, "sk", "left")


# --------------------------------------------------------------------------- quality

QUALITY = [
    Rule("has_level", "get_json_object(props, '$.k') IS NOT NULL", "fail"),
    Rule("has_value", "value IS NOT NULL", "drop"),
    Rule("reasonable_value", "value < 100", "drop"),
    Rule("level_above_ten", "CAST(get_json_object(props, '$.k') AS INT) >= 10"),
    Rule("nullable_check", "CASE WHEN event_type = 'view' THEN NULL ELSE value >= 1 END"),
]


@query("""
SELECT rule, action, count_if(ok) AS passed, count_if(NOT ok) AS failed
FROM (
    SELECT r.rule, r.action, coalesce(CASE r.rule
        WHEN 'has_level' THEN props->>'$.k' IS NOT NULL
        WHEN 'has_value' THEN value IS NOT NULL
        WHEN 'reasonable_value' THEN value < 100
        WHEN 'level_above_ten' THEN CAST(props->>'$.k' AS INTEGER) >= 10
        ELSE CASE WHEN event_type = 'view' THEN NULL ELSE value >= 1 END END, FALSE) AS ok
    FROM events, (VALUES ('has_level', 'fail'), ('has_value', 'drop'), ('reasonable_value', 'drop'),
                         ('level_above_ten', 'warn'), ('nullable_check', 'warn')) r(rule, action)
)
GROUP BY rule, action
""")
def quality_report(spark, sf_dir):
    return quality.quality_report(I.table(spark, sf_dir, "events"), QUALITY)


@query("SELECT event_id, ts, user_id, event_type, value FROM events WHERE value < 100 AND props->>'$.k' IS NOT NULL")
def quality_apply(spark, sf_dir):
    """Fail, drop and warn rules applied together."""
    return quality.apply_rules(I.table(spark, sf_dir, "events"), QUALITY).drop("props")


@query("""
SELECT event_id, concat_ws(',',
    CASE WHEN value < 100 THEN NULL ELSE 'reasonable_value' END,
    CASE WHEN CAST(props->>'$.k' AS INTEGER) >= 10 THEN NULL ELSE 'level_above_ten' END,
    CASE WHEN event_type <> 'view' AND value >= 1 THEN NULL ELSE 'nullable_check' END) AS failed_rules
FROM events
WHERE NOT (value < 100 AND CAST(props->>'$.k' AS INTEGER) >= 10 AND event_type <> 'view' AND value >= 1)
""")
def quarantine(spark, sf_dir):
    return quality.quarantine(I.table(spark, sf_dir, "events"), QUALITY).select(
        "event_id", F.array_join("failed_rules", ",").alias("failed_rules")
    )


@query("""
SELECT 'level_above_ten' AS rule, count_if(CAST(props->>'$.k' AS INTEGER) < 10) AS failed FROM events WHERE value < 100
UNION ALL SELECT 'nullable_check', count_if(event_type = 'view' OR value < 1) FROM events WHERE value < 100
""")
def quality_warnings(spark, sf_dir):
    """Broken warn rules, counted by the job that writes the rows."""
    counts = Observation("warnings")
    quality.apply_rules(I.table(spark, sf_dir, "events"), QUALITY, counts).write.parquet(work_dir(spark, "observed"))
    return spark.createDataFrame(list(counts.get.items()), "rule string, failed bigint")


STOPS = [Rule("has_level", "get_json_object(props, '$.k') IS NOT NULL", "fail"), Rule("known_type", "event_type <> 'error'", "fail"),
         Rule("small", "value < 1000000", "fail"), Rule("old", "ts < '2024-01-15'", "fail")]


@query("""
SELECT r.rule, count_if(NOT CASE r.rule WHEN 'has_level' THEN props->>'$.k' IS NOT NULL WHEN 'known_type' THEN event_type <> 'error'
                        WHEN 'small' THEN value < 1000000 ELSE ts < TIMESTAMP '2024-01-15' END) > 0 AS stopped
FROM events, (VALUES ('has_level'), ('known_type'), ('small'), ('old')) r(rule) GROUP BY r.rule
""")
def quality_stops(spark, sf_dir):
    """Which fail rules stop a job, by the message it stops with."""
    events, rows = I.table(spark, sf_dir, "events"), []
    for rule in STOPS:
        try:
            quality.expect_fail(events, [rule]).write.format("noop").mode("overwrite").save()
            rows.append((rule.name, False))
        except Exception as stopped:
            if f"quality rule {rule.name} broken" not in str(stopped):
                raise
            rows.append((rule.name, True))
    return spark.createDataFrame(rows, "rule string, stopped boolean")


@query("""
SELECT 'event_id' AS keys, count(DISTINCT event_id) = count(*) AS is_unique FROM events
UNION ALL SELECT 'event_type,user_id', count(DISTINCT (event_type, user_id)) = count(*) FROM events
UNION ALL SELECT 'user_id,ts', count(DISTINCT (user_id, ts)) = count(*) FROM events
""")
def unique_keys(spark, sf_dir):
    """Declared keys, asserted."""
    events, rows = I.table(spark, sf_dir, "events"), []
    for keys in (["event_id"], ["event_type", "user_id"], ["user_id", "ts"]):
        try:
            quality.assert_unique(events, keys)
            rows.append((",".join(keys), True))
        except ValueError as repeated:
            if str(keys) not in str(repeated):
                raise
            rows.append((",".join(keys), False))
    return spark.createDataFrame(rows, "keys string, is_unique boolean")


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1
""")
def duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(I.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
SELECT CAST(event_id AS INTEGER) AS event_id, ts, CAST(NULL AS VARCHAR) AS note, round(value, 2) AS value
FROM events
""")
def conform_table(spark, sf_dir):
    """Rows aligned to a declared table: cast, added column, required key."""
    rows = I.table(spark, sf_dir, "events").select("event_id", "ts", F.round("value", 2).alias("value"))
    return tables.conform(rows, "event_id int, ts timestamp, note string, value double", required=["event_id"])


# --------------------------------------------------------------------------- configuration

SENSORS_SQL = """
    sensors AS (
        SELECT event_type AS gateway_id, CAST(user_id AS INTEGER) AS object_id,
               sha256(concat_ws('|', event_type, user_id)) AS sk, min(ts) AS first_seen, max(ts) AS last_seen
        FROM events GROUP BY ALL
    )
"""


def _sensor_inventory(spark, sf_dir):
    """Current sensors out of daily snapshots."""
    snapshots = I.table(spark, sf_dir, "events").groupBy(
        F.col("event_type").alias("gateway_id"), F.col("user_id").cast("int").alias("object_id"),
        F.to_date("ts").alias("snapshot_date"),
    ).agg(F.max("ts").alias("last_seen"))
    dim = snapshots.withColumns({
        "sk": K.surrogate_key("gateway_id", "object_id"),
        "name": F.format_string("Sensor %s", F.col("object_id").cast("string")),
    })
    return order.latest_inventory(dim, ["gateway_id", "object_id"])


@query(f"""
WITH {SENSORS_SQL}
SELECT 'sensor_' || gateway_id || '_' || object_id AS connection_id, 'Sensor ' || object_id AS data_name,
       gateway_id AS object_id, 'sensor_api' AS connector, 'views.sensor_15min' AS gold_table_name,
       15 AS expected_interval_minutes, 1 AS delayed_threshold_days, 4 AS offline_threshold_days,
       'timestamp_bucket' AS ts_col, 'sk = ''' || sk || '''' AS filter_clause
FROM sensors
UNION ALL
SELECT 'meter_' || t.short || '_' || user_id || '_' || user_id, 'Maker ' || t.tag || ' ' || user_id,
       CAST(user_id AS VARCHAR), 'meter_api', t.tbl, 60, 1, 4, 'timestamp',
       'sk = ''' || sha256(concat_ws('|', user_id, user_id, t.tag)) || ''''
FROM (SELECT DISTINCT user_id FROM events),
     (VALUES ('econn', 'EConnection', 'views.grid_hourly'), ('pv', 'PVInstallation', 'views.pv_hourly')) t(short, tag, tbl)
""")
def config_build(spark, sf_dir):
    """Configuration of both feeds out of their current inventories."""
    sensors = C.build_connection_config(
        _sensor_inventory(spark, sf_dir),
        sensor.connection_template("sensor", "views.sensor_15min", "Maker", "Client", "sensor job"), I.CREATED,
    )
    assets = I.table(spark, sf_dir, "events").select(F.col("user_id").cast("int").alias("account_id")).distinct()
    assets = assets.withColumn("energyasset_id", F.col("account_id"))
    parts = [sensors]
    for tag, view in ((meter.GRID, "views.grid_hourly"), (meter.PRODUCTION, "views.pv_hourly")):
        dim = assets.withColumn("sk", K.surrogate_key(*meter.KEYS, tag=tag))
        template = meter.connection_template("meter", tag, view, "Maker", "Client", "meter job")
        parts.append(C.build_connection_config(dim, template, I.CREATED))
    return metrics.union_all(parts).select(
        "connection_id", "data_name", "object_id", "connector", "gold_table_name", "expected_interval_minutes",
        "delayed_threshold_days", "offline_threshold_days",
        F.get_json_object("other_metadata", "$.timestamp_col").alias("ts_col"),
        F.get_json_object("other_metadata", "$.filter_clause").alias("filter_clause"),
    )


@query(f"""
WITH {SENSORS_SQL}
SELECT 'sensor_' || gateway_id || '_' || object_id AS connection_id,
       CASE WHEN last_seen >= TIMESTAMP '2024-01-29' THEN 'Sensor ' || object_id ELSE 'old' END AS data_name,
       CASE WHEN first_seen < TIMESTAMP '2024-01-05' THEN TIMESTAMP '2024-01-01'
            ELSE TIMESTAMP '2024-01-20 12:00:00' END AS created_at,
       CASE WHEN last_seen >= TIMESTAMP '2024-01-29' THEN TIMESTAMP '2024-01-20 12:00:00'
            ELSE TIMESTAMP '2024-01-01' END AS updated_at,
       CASE WHEN last_seen >= TIMESTAMP '2024-01-29' THEN 15 ELSE 99 END AS expected_interval_minutes
FROM sensors
WHERE first_seen < TIMESTAMP '2024-01-05' OR last_seen >= TIMESTAMP '2024-01-29'
""")
def config_upsert(spark, sf_dir):
    """Sensors of the last days merged into a configuration of those of the first days."""
    template = sensor.connection_template("sensor", "views.sensor_15min", "Maker", "Client", "sensor job")
    seen = I.table(spark, sf_dir, "events").groupBy(
        F.col("event_type").alias("gateway_id"), F.col("user_id").cast("int").alias("object_id")
    ).agg(F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen")).withColumns({
        "sk": K.surrogate_key("gateway_id", "object_id"),
        "name": F.format_string("Sensor %s", F.col("object_id").cast("string")),
    })
    old = C.build_connection_config(
        seen.filter(F.col("first_seen") < ts_lit("2024-01-05")), template, I.CREATED
    ).withColumns({"data_name": F.lit("old"), "expected_interval_minutes": F.lit(99)})
    new = C.build_connection_config(seen.filter(F.col("last_seen") >= ts_lit("2024-01-29")), template, I.AS_OF)
    payload = [c for c in old.columns if c not in ("connection_id", "created_at")]
    merged = merge.upsert(old, new, ["connection_id"], payload, insert_only_cols=["created_at"])
    return merged.select("connection_id", "data_name", "created_at", "updated_at", "expected_interval_minutes")


@query("""
SELECT 'c_' || event_type || '_' || user_id AS connection_id,
       CASE user_id % 5 WHEN 0 THEN 'ean,key' WHEN 1 THEN 'ean' WHEN 2 THEN 'user_id'
                        WHEN 3 THEN 'clause:value > 100' ELSE '' END AS match_on,
       max(CASE WHEN user_id % 5 = 0 THEN by_sensor.t WHEN user_id % 5 = 1 THEN by_type.t
                WHEN user_id % 5 = 2 THEN by_user.t
                WHEN user_id % 5 = 3 THEN (SELECT max(ts) FROM events WHERE value > 100)
                ELSE (SELECT max(ts) FROM events) END) AS last_sync_timestamp
FROM (SELECT DISTINCT event_type, user_id FROM events) c
JOIN (SELECT event_type, user_id, max(ts) AS t FROM events GROUP BY ALL) by_sensor USING (event_type, user_id)
JOIN (SELECT event_type, max(ts) AS t FROM events GROUP BY ALL) by_type USING (event_type)
JOIN (SELECT user_id, max(ts) AS t FROM events GROUP BY ALL) by_user USING (user_id)
GROUP BY event_type, user_id
""")
def connection_predicate(spark, sf_dir):
    """All ways in which a connection selects its facts, in their order of precedence."""
    events = I.table(spark, sf_dir, "events")
    pairs = events.select("event_type", "user_id").distinct()
    turn = F.col("user_id") % 5
    user = F.col("user_id").cast("string")
    attributes = F.to_json(F.struct(
        F.when(turn <= 1, F.col("event_type")).alias("ean"),
        F.when(turn == 0, user).alias("key"),
        F.when(turn == 2, F.format_string("user_id = '%s'", user))
        .when(turn == 3, F.lit("value > 100"))
        .when(turn <= 1, F.lit("not used")).alias("filter_clause"),
        F.lit("ts").alias("timestamp_col"),
    ))
    config = pairs.select(
        F.format_string("c_%s_%s", F.col("event_type"), user).alias("connection_id"),
        F.lit(I.FACTS).alias("gold_table_name"), F.lit(60).alias("expected_interval_minutes"),
        attributes.alias("other_metadata"),
    )
    matched = C.connection_predicate(config)
    frame = events.select("ts", "user_id", "value", F.col("event_type").alias("ean"), F.col("user_id").alias("key"))
    source = C.FactSource(
        I.FACTS, frame, ts="ts", key_sets=(("ean", "key"), ("ean",), ("user_id",), ()), clauses=("value > 100",)
    )
    latest = metrics.latest_per_connection(source, matched)
    return matched.select("connection_id", "match_on").join(latest, "connection_id")


CLAUSES = {
    0: "user_id = '{u}' AND kind = 'view'",
    1: "kind = 'click' and user_id='{u}'",
    2: "value > {v} AND kind IN ('view', 'purchase')",
    3: "CAST(props AS INT) = {v} OR (user_id % 40 = {v} AND value >= 50)",  # props is no number: the first part is never fulfilled
    4: "no_such_column = 1 AND user_id = 1",
    5: "user_id = 1 AND (",
    6: "max(value) > 1",
    7: "value",
}


@query(f"""
WITH c AS (SELECT DISTINCT user_id AS u FROM events),
seen AS (
    SELECT c.u, max(ts) AS last_ts
    FROM c LEFT JOIN events e ON CASE c.u % 8
        WHEN 0 THEN e.user_id = c.u AND e.event_type = 'view'
        WHEN 1 THEN e.user_id = c.u AND e.event_type = 'click'
        WHEN 2 THEN e.value > c.u % 40 AND e.event_type IN ('view', 'purchase')
        WHEN 3 THEN e.user_id % 40 = c.u % 40 AND e.value >= 50
        ELSE FALSE END
    GROUP BY c.u
)
SELECT 'c_' || u AS connection_id, last_ts AS last_sync_timestamp,
       CASE WHEN u % 8 > 3 OR last_ts IS NULL THEN 'OFFLINE'
            WHEN epoch_us(TIMESTAMP '{I.CHECKED_AT}') - epoch_us(last_ts) > 4 * 86400000000 THEN 'OFFLINE'
            WHEN epoch_us(TIMESTAMP '{I.CHECKED_AT}') - epoch_us(last_ts) > 86400000000 THEN 'DELAYED' ELSE 'ACTIVE' END AS status,
       CASE WHEN u % 8 > 3 THEN 'ERROR' ELSE 'SUCCESS' END AS job_state
FROM seen
""")
def free_clauses(spark, sf_dir):
    """Connections with clauses of their own, good and bad, and nothing declared by hand."""
    events = I.table(spark, sf_dir, "events")
    frame = events.select("ts", "user_id", "value", "props", F.col("event_type").alias("kind"))
    user = F.col("user_id").cast("string")
    turn = (F.col("user_id") % 40).cast("string")
    clause = F.coalesce(*[F.when(F.col("user_id") % 8 == k, F.replace(F.replace(F.lit(text), F.lit("{u}"), user), F.lit("{v}"), turn))
                          for k, text in CLAUSES.items()])
    config = events.select("user_id").distinct().select(
        F.format_string("c_%s", user).alias("connection_id"), F.lit("t").alias("gold_table_name"), F.lit(1440).alias("expected_interval_minutes"),
        F.to_json(F.struct(clause.alias("filter_clause"), F.lit("ts").alias("timestamp_col"))).alias("other_metadata"),
        F.lit(1).alias("delayed_threshold_days"), F.lit(4).alias("offline_threshold_days"), *[F.lit(None).cast("string").alias(c) for c in status.STATIC])
    snapshot = status.status_snapshot(config, C.discover_sources(config, {"t": frame}), I.CHECKED_AT, "run-3")
    return snapshot.select("connection_id", "last_sync_timestamp", "status", "job_state")


@query("""
SELECT o_orderpriority AS job_name, CAST(o_orderdate AS DATE) AS pause_start_date,
       CAST(o_orderdate AS DATE) + 10 AS pause_end_date, o_orderkey AS schedule_id
FROM orders
WHERE o_orderstatus <> 'P' AND DATE '1998-06-01' BETWEEN CAST(o_orderdate AS DATE) AND CAST(o_orderdate AS DATE) + 10
""")
def pause_windows(spark, sf_dir):
    schedules = I.table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("job_name"),
        F.to_date("o_orderdate").alias("pause_start_date"),
        F.date_add(F.to_date("o_orderdate"), 10).alias("pause_end_date"),
        (F.col("o_orderstatus") != "P").alias("is_active"),
        F.col("o_orderkey").alias("schedule_id"),
    )
    return windows.active_windows(schedules, "1998-06-01").drop("is_active")


# --------------------------------------------------------------------------- health

CONFIG_SQL = """
    cfg AS (
        SELECT DISTINCT user_id, 'sensor_' || user_id AS connection_id,
               CASE user_id % 3 WHEN 0 THEN 30 WHEN 1 THEN 60 ELSE 1440 END AS iv
        FROM events
    )
"""

WINDOW_START, WINDOW_END = DAY = "2024-01-18 23:00:00", "2024-01-19 23:00:00"
CHECK_DAY = "2024-01-29 23:00:00", "2024-01-30 23:00:00"


def hours_sql(rows: str, window: tuple[str, str] = DAY) -> str:
    """Hour rows over ``rows`` (user_id, ts, proc) in the day window."""
    start, end = window
    return f"""
    facts AS ({rows}),
    hours AS (
        SELECT c.connection_id, c.iv,
               CASE WHEN c.iv >= 1440 THEN TIMESTAMP '{start}' ELSE date_trunc('hour', f.ts)::TIMESTAMP END AS hour,
               count(*) AS points, count(DISTINCT f.ts) AS uniq,
               CASE WHEN c.iv >= 1440 THEN 1 ELSE 60 // c.iv END AS expected,
               avg((floor(epoch(f.proc)) - floor(epoch(f.ts))) / 60.0) AS avg_delay,
               max((floor(epoch(f.proc)) - floor(epoch(f.ts))) / 60.0) AS max_delay
        FROM facts f JOIN cfg c USING (user_id)
        WHERE f.ts >= TIMESTAMP '{start}' AND f.ts < TIMESTAMP '{end}'
        GROUP BY ALL
    ),
    pct AS (SELECT *, least(100.0, round_even(points / expected * 100, 2)) AS completeness FROM hours)
    """


PROC = "ts + to_seconds(event_id % 600)"
ONCE_SQL = f"SELECT user_id, ts, {PROC} AS proc FROM events"
TWICE_SQL = f"SELECT user_id, ts, {PROC} AS proc FROM events, range(2)"

HOUR_SELECT = """
SELECT connection_id, iv AS expected_interval_minutes, hour, CAST(points AS INTEGER) AS data_points,
       CAST(expected AS INTEGER) AS expected_records,
       CAST(completeness AS DOUBLE) AS completeness_pct, CAST(points - uniq AS INTEGER) AS duplicate_timestamps,
       0 AS null_values, round(avg_delay, 6) AS avg_delay_minutes, round(max_delay, 6) AS max_delay_minutes,
       100.0::DOUBLE AS uptime_pct, CAST(points - uniq AS INTEGER) AS total_validation_errors
FROM pct
"""


def _health_inputs(spark, sf_dir, repeated=False):
    frame = (I.repeated_facts if repeated else I.facts)(spark, sf_dir)
    return I.source(frame), C.connection_predicate(I.connections(spark, sf_dir))


def _rounded_delays(hours: DataFrame) -> DataFrame:
    return K.round_metrics(hours, ["avg_delay_minutes", "max_delay_minutes"], 6)


@query(f"WITH {CONFIG_SQL}, {hours_sql(TWICE_SQL)} {HOUR_SELECT} WHERE iv < 1440")
def hourly_metrics(spark, sf_dir):
    source, config = _health_inputs(spark, sf_dir, repeated=True)
    return _rounded_delays(metrics.hourly_metrics(source, config, I.AS_OF))


@query(f"WITH {CONFIG_SQL}, {hours_sql(TWICE_SQL)} {HOUR_SELECT} WHERE iv >= 1440")
def daily_metrics(spark, sf_dir):
    source, config = _health_inputs(spark, sf_dir, repeated=True)
    return _rounded_delays(metrics.daily_metrics(source, config, I.AS_OF))


@query(f"""
WITH {CONFIG_SQL}, {hours_sql(ONCE_SQL)},
spine AS (
    SELECT connection_id, iv, unnest(generate_series(TIMESTAMP '{WINDOW_START}',
           TIMESTAMP '{WINDOW_END}' - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS hour
    FROM cfg WHERE iv < 1440
)
SELECT s.connection_id, s.hour, CAST(coalesce(points, 0) AS INTEGER) AS data_points,
       CAST(60 // s.iv AS INTEGER) AS expected_records, CAST(coalesce(completeness, 0) AS DOUBLE) AS completeness_pct,
       CASE WHEN points > 0 THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END AS uptime_pct
FROM spine s LEFT JOIN pct p ON p.connection_id = s.connection_id AND p.hour = s.hour
""")
def dense_hourly_metrics(spark, sf_dir):
    """Hourly metrics with the silent hours."""
    source, config = _health_inputs(spark, sf_dir)
    return metrics.hourly_metrics(source, config, I.AS_OF, dense_hours=True).select(
        "connection_id", "hour", "data_points", "expected_records", "completeness_pct", "uptime_pct"
    )


PROC_HOURS_SQL = """
    facts AS (
        SELECT user_id, ts, ts + to_seconds(event_id % 600) AS proc, ts + to_seconds(event_id % 300) AS ing,
               CASE WHEN CAST(props->>'$.k' AS INTEGER) >= 10 THEN value END AS v
        FROM events
    ),
    hours AS (
        SELECT c.connection_id, c.iv, date_trunc('hour', f.proc)::TIMESTAMP AS hour, count(*) AS points,
               count(DISTINCT f.ts) AS uniq, count(*) - count(v) AS nulls, 60 // c.iv AS expected,
               avg((floor(epoch(f.ing)) - floor(epoch(f.ts))) / 60.0) AS avg_delay,
               max((floor(epoch(f.ing)) - floor(epoch(f.ts))) / 60.0) AS max_delay
        FROM facts f JOIN cfg c USING (user_id)
        WHERE f.proc >= {start} AND f.proc < {end}
        GROUP BY ALL
    ),
    pct AS (
        SELECT *, CASE WHEN expected > 0 THEN least(100.0, round_even(points / expected * 100, 2)) ELSE 0 END
               AS completeness
        FROM hours
    )
"""


@query(f"""
WITH {CONFIG_SQL},
{PROC_HOURS_SQL.format(start="TIMESTAMP '2024-01-19 12:00:00'", end="TIMESTAMP '2024-01-20 12:00:00'")}
SELECT connection_id, hour, CAST(points AS INTEGER) AS data_points, CAST(expected AS INTEGER) AS expected_records,
       CAST(completeness AS DOUBLE) AS completeness_pct, CAST(points - uniq AS INTEGER) AS duplicate_timestamps,
       CAST(nulls AS INTEGER) AS null_values, CAST(round_even(CAST(avg_delay AS DECIMAL(18, 9)), 2) AS DOUBLE) AS avg_delay_minutes,
       CAST(round_even(CAST(max_delay AS DECIMAL(18, 9)), 2) AS DOUBLE) AS max_delay_minutes, 100.0::DOUBLE AS uptime_pct,
       CAST(points - uniq + nulls AS INTEGER) AS total_validation_errors
FROM pct
""")
def proc_time_metrics(spark, sf_dir):
    source, config = _health_inputs(spark, sf_dir)
    return metrics.streaming_hourly_metrics(source, config, I.AS_OF, ["value", "not_there"]).drop(
        "expected_interval_minutes"
    )


@query("""
SELECT 'sensor_' || user_id AS connection_id, max(ts) AS last_sync_timestamp FROM events GROUP BY user_id
""")
def latest_record(spark, sf_dir):
    source, config = _health_inputs(spark, sf_dir)
    return metrics.latest_per_connection(source, config)


@query("SELECT user_id, count_if(CAST(props->>'$.k' AS INTEGER) < 10) AS null_values FROM events GROUP BY user_id")
def null_count(spark, sf_dir):
    events = I.table(spark, sf_dir, "events").select("user_id", I.known_value().alias("value"))
    return rollup.null_count(events, ["user_id"], ["value", "not_there"])


def gaps_sql(window: tuple[str, str] = DAY) -> str:
    start, end = window
    return f"""
    anchored AS (
        SELECT user_id, ts FROM events
        WHERE ts >= TIMESTAMP '{start}' AND ts < TIMESTAMP '{end}'
        UNION SELECT user_id, TIMESTAMP '{start}' FROM cfg
        UNION SELECT user_id, TIMESTAMP '{end}' FROM cfg
    ),
    spaced AS (
        SELECT c.connection_id, c.iv, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev
        FROM anchored JOIN cfg c USING (user_id) WHERE c.iv < 1440
    ),
    gaps AS (
        SELECT connection_id, prev AS gap_start, ts AS gap_end,
               CAST(round_even((floor(epoch(ts)) - floor(epoch(prev))) / 60.0, 0) AS INTEGER) AS gap_duration_minutes,
               CAST(greatest(0, round_even((floor(epoch(ts)) - floor(epoch(prev))) / 60.0 / iv, 0) - 1) AS INTEGER)
                   AS missing_records
        FROM spaced WHERE (floor(epoch(ts)) - floor(epoch(prev))) / 60.0 > iv * 1.5
    )
"""


@query(f"WITH {CONFIG_SQL}, {gaps_sql()} SELECT * FROM gaps")
def detect_gaps(spark, sf_dir):
    source, config = _health_inputs(spark, sf_dir)
    return gaps.detect_gaps(source, config, I.AS_OF)


PAUSES_SQL = """
    pauses AS (
        SELECT 'sensor_' || user_id AS connection_id, ts AS s, ts + to_minutes(CAST(floor(value) AS INTEGER) * 5) AS e
        FROM events WHERE event_type IN ('error', 'view')
    ),
    marked AS (
        SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY connection_id ORDER BY s, e
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new
        FROM pauses WHERE s < e
    ),
    islands AS (
        SELECT connection_id, min(s) AS s, max(e) AS e
        FROM (SELECT *, sum(new) OVER (PARTITION BY connection_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM marked)
        GROUP BY connection_id, island
    )
"""


@query(f"""
WITH {CONFIG_SQL}, {gaps_sql()}, {PAUSES_SQL},
met AS (
    SELECT g.connection_id, g.gap_start, g.gap_end, p.s, p.e FROM gaps g JOIN islands p
    ON p.connection_id = g.connection_id AND p.s < g.gap_end AND p.e > g.gap_start
),
pieces AS (
    SELECT connection_id, coalesce(lag(e) OVER (PARTITION BY connection_id, gap_start ORDER BY s), gap_start) AS gap_start, s AS gap_end FROM met
    UNION ALL SELECT connection_id, max(e), gap_end FROM met GROUP BY connection_id, gap_start, gap_end
    UNION ALL SELECT connection_id, gap_start, gap_end FROM gaps g
    WHERE NOT EXISTS (SELECT 1 FROM met m WHERE m.connection_id = g.connection_id AND m.gap_start = g.gap_start)
)
SELECT connection_id, iv AS expected_interval_minutes, gap_start, gap_end,
       CAST(round_even((floor(epoch(gap_end)) - floor(epoch(gap_start))) / 60.0, 0) AS INTEGER) AS gap_duration_minutes,
       CAST(greatest(0, round_even((floor(epoch(gap_end)) - floor(epoch(gap_start))) / 60.0 / iv, 0) - 1) AS INTEGER) AS missing_records
FROM pieces JOIN cfg USING (connection_id) WHERE (floor(epoch(gap_end)) - floor(epoch(gap_start))) / 60.0 > iv * 1.5
""")
def masked_gaps(spark, sf_dir):
    """Gaps less planned downtime that overlaps, touches and nests."""
    source, config = _health_inputs(spark, sf_dir)
    found = gaps.detect_gaps(source, config, I.AS_OF).join(config.select("connection_id", "expected_interval_minutes"), "connection_id")
    pauses = I.table(spark, sf_dir, "events").filter(F.col("event_type").isin("error", "view")).select(
        F.format_string("sensor_%s", F.col("user_id").cast("string")).alias("connection_id"), F.col("ts").alias("pause_start"),
        (F.col("ts") + F.make_dt_interval(mins=(F.floor("value") * 5).cast("int"))).alias("pause_end"))
    return windows.masked_gaps(found, pauses)


@query(f"""
WITH {CONFIG_SQL}, {gaps_sql()}
SELECT connection_id, CAST(count(*) OVER (PARTITION BY connection_id) AS INTEGER) AS data_gap_count,
       CAST(row_number() OVER (PARTITION BY connection_id ORDER BY gap_start) - 1 AS INTEGER) AS pos,
       gap_start, gap_end, gap_duration_minutes, missing_records
FROM gaps
""")
def gap_summary(spark, sf_dir):
    source, config = _health_inputs(spark, sf_dir)
    summary = gaps.gap_summary(gaps.detect_gaps(source, config, I.AS_OF))
    return summary.select("connection_id", "data_gap_count", F.posexplode("data_gaps").alias("pos", "g")).select(
        "connection_id", "data_gap_count", "pos", "g.*"
    )


SUMMARY_SQL = """
    summary AS (
        SELECT connection_id, CAST(sum(points) AS INTEGER) AS data_points_24h,
               CAST(round_even(CAST(avg(completeness) AS DECIMAL(18, 9)), 1) AS DOUBLE) AS completeness_pct,
               100.0::DOUBLE AS uptime_pct_24h, CAST(round_even(CAST(avg(avg_delay) AS DECIMAL(18, 9)), 1) AS DOUBLE) AS avg_delay_minutes,
               CAST(sum(points - uniq) AS INTEGER) AS duplicate_timestamps_24h,
               round(avg(completeness), 9) AS mean_completeness
        FROM pct GROUP BY connection_id
    )
"""


@query(f"""
WITH {CONFIG_SQL}, {hours_sql(TWICE_SQL)}, {SUMMARY_SQL}
SELECT connection_id, data_points_24h, completeness_pct, uptime_pct_24h, avg_delay_minutes,
       duplicate_timestamps_24h AS total_validation_errors, duplicate_timestamps_24h, 0 AS null_values_24h
FROM summary
""")
def summary_24h(spark, sf_dir):
    source, config = _health_inputs(spark, sf_dir, repeated=True)
    return metrics.summary_24h(metrics.period_metrics(source, config, I.AS_OF)).drop("mean_completeness")


STATUS_SQL = f"""
    latest AS (SELECT 'sensor_' || user_id AS connection_id, max(ts) AS last_ts FROM events GROUP BY user_id),
    gap_counts AS (SELECT connection_id, CAST(count(*) AS INTEGER) AS n FROM gaps GROUP BY connection_id),
    status AS (
        SELECT c.connection_id, 'User ' || c.user_id AS data_name,
               CASE WHEN (epoch_us(TIMESTAMP '{I.CHECKED_AT}') - epoch_us(last_ts)) / 60e6 > 5760 THEN 'OFFLINE'
                    WHEN (epoch_us(TIMESTAMP '{I.CHECKED_AT}') - epoch_us(last_ts)) / 60e6 > 1440 THEN 'DELAYED'
                    WHEN mean_completeness < 80 THEN 'DELAYED' ELSE 'ACTIVE' END AS status,
               last_ts AS last_sync_timestamp, 'run-1' AS job_run_id, 'SUCCESS' AS job_state, data_points_24h,
               completeness_pct, uptime_pct_24h, avg_delay_minutes, duplicate_timestamps_24h,
               coalesce(g.n, 0) AS data_gap_count, TIMESTAMP '{I.CHECKED_AT}' AS checked_at
        FROM cfg c LEFT JOIN summary s USING (connection_id) LEFT JOIN latest l USING (connection_id)
        LEFT JOIN gap_counts g USING (connection_id)
    )
"""

STATUS_WITH = (
    f"WITH {CONFIG_SQL}, {hours_sql(ONCE_SQL, CHECK_DAY)}, {SUMMARY_SQL}, {gaps_sql(CHECK_DAY)}, {STATUS_SQL}"
)


def _snapshot(spark, sf_dir) -> DataFrame:
    source = I.source(I.facts(spark, sf_dir))
    return status.status_snapshot(I.connections(spark, sf_dir), source, I.CHECKED_AT, "run-1")


@query(f"{STATUS_WITH} SELECT * FROM status")
def connection_status(spark, sf_dir):
    """The status record of every connection, without its nested parts."""
    return _snapshot(spark, sf_dir).select(
        "connection_id", "data_name", "status", "last_sync_timestamp", "job_run_id", "job_state", "data_points_24h",
        "completeness_pct", "uptime_pct_24h", "avg_delay_minutes", "duplicate_timestamps_24h", "data_gap_count",
        "checked_at",
    )


@query(f"""
{STATUS_WITH}
SELECT connection_id, hour, CAST(points AS INTEGER) AS data_points, CAST(completeness AS DOUBLE) AS completeness_pct,
       round(avg_delay, 6) AS avg_delay_minutes
FROM pct
""")
def status_hours(spark, sf_dir):
    """The hour entries of the status record."""
    return _rounded(_snapshot(spark, sf_dir).select(
        "connection_id", F.explode("hourly_metrics").alias("h")
    ).select("connection_id", "h.hour", "h.data_points", "h.completeness_pct", "h.avg_delay_minutes"))


def _rounded(df: DataFrame) -> DataFrame:
    return K.round_metrics(df, ["avg_delay_minutes"], 6)


@query(f"""
{STATUS_WITH}
SELECT CASE WHEN count_if(status = 'OFFLINE') > 0 THEN 'OFFLINE' WHEN count_if(status = 'DELAYED') > 0
            THEN 'DELAYED' ELSE 'ACTIVE' END AS overall_status,
       count(*) AS connections, count_if(status = 'ACTIVE') AS active, count_if(status = 'DELAYED') AS delayed,
       count_if(status = 'OFFLINE') AS offline, count_if(job_state = 'ERROR') AS errors
FROM status
""")
def overall_status(spark, sf_dir):
    return status.overall_status(_snapshot(spark, sf_dir))


@query(f"""
{STATUS_WITH}
SELECT connection_id, checked_at, data_gap_count FROM status WHERE data_gap_count > 0
ORDER BY checked_at DESC, connection_id LIMIT 20
""")
def recent_gaps(spark, sf_dir):
    """The report of the newest records with gaps."""
    return gaps.recent_gaps(_snapshot(spark, sf_dir)).drop("data_gaps")


@query(f"""
{STATUS_WITH}
SELECT s.connection_id, s.status, s.completeness_pct, 100.0 - s.completeness_pct AS missing_data_pct,
       CAST(n_hours AS INTEGER) AS n_hours, CAST(CASE WHEN data_gap_count > 0 THEN data_gap_count END AS INTEGER) AS n_gaps
FROM status s LEFT JOIN (SELECT connection_id, count(*) AS n_hours FROM pct GROUP BY ALL) USING (connection_id)
""")
def serving_projection(spark, sf_dir):
    """Flat mirror of the status, nested arrays as JSON."""
    return tables.serving_projection(_snapshot(spark, sf_dir)).select(
        "connection_id", "status", "completeness_pct", "missing_data_pct",
        F.json_array_length("hourly_metrics").alias("n_hours"), F.json_array_length("data_gaps").alias("n_gaps"),
    )


HISTORY_SQL = "SELECT DISTINCT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-20' AND ts < TIMESTAMP '2024-01-21'"


def _history(spark, sf_dir) -> DataFrame:
    """A status row for every event, as if each had been a check."""
    return I.table(spark, sf_dir, "events").select(
        F.format_string("sensor_%s", F.col("user_id").cast("string")).alias("connection_id"),
        F.col("ts").alias("checked_at"),
    )


@query(f"""
SELECT DISTINCT 'sensor_' || user_id AS connection_id FROM events WHERE user_id NOT IN ({HISTORY_SQL})
""")
def skip_checked(spark, sf_dir):
    return C.skip_already_checked(I.connections(spark, sf_dir), _history(spark, sf_dir), I.AS_OF).select(
        "connection_id"
    )


def _marked_connections(spark, sf_dir) -> DataFrame:
    """Connections that carry a status mark: active for even users, inactive for others."""
    config = I.connections(spark, sf_dir)
    user = F.get_json_object("other_metadata", "$.user_id").cast("bigint")
    mark = F.when(user % 2 == 0, "active").otherwise("inactive")
    return config.withColumn("other_metadata", F.to_json(F.struct(mark.alias("meterStatus"))))


@query(f"""
SELECT DISTINCT 'sensor_' || user_id AS connection_id, 'User ' || user_id AS data_name, 'DELAYED' AS status,
       'run-2' AS job_run_id, 'FAILED' AS job_state, TIMESTAMP '{I.AS_OF}' AS checked_at
FROM events WHERE user_id % 2 = 0 AND user_id NOT IN ({HISTORY_SQL})
""")
def failure_status(spark, sf_dir):
    return status.failure_status(
        _marked_connections(spark, sf_dir), _history(spark, sf_dir), I.AS_OF, "run-2"
    ).select("connection_id", "data_name", "status", "job_run_id", "job_state", "checked_at")


@query("""
SELECT 'sensor_api' AS connector, count(*) AS connections, count_if(user_id % 2 = 0) AS active,
       count_if(user_id % 2 <> 0) AS inactive
FROM (SELECT DISTINCT user_id FROM events)
""")
def config_counts(spark, sf_dir):
    return C.config_counts(_marked_connections(spark, sf_dir))


@query("SELECT DISTINCT 'sensor_' || user_id AS connection_id FROM events WHERE user_id % 2 = 0")
def active_connections(spark, sf_dir):
    return C.active_only(_marked_connections(spark, sf_dir)).select("connection_id")


@query(f"WITH {CONFIG_SQL} SELECT connection_id, CAST(iv AS INTEGER) AS expected_interval_minutes FROM cfg")
def select_connections(spark, sf_dir):
    """All connections of one connector."""
    config = C.select_connections(I.connections(spark, sf_dir), connector="sensor_api")
    return config.select("connection_id", "expected_interval_minutes")


@query(f"""
{STATUS_WITH}
SELECT s.connection_id, s.status, s.completeness_pct, 100.0 - s.completeness_pct AS missing_data_pct,
       CAST(n_hours AS INTEGER) AS n_hours
FROM status s LEFT JOIN (SELECT connection_id, count(*) AS n_hours FROM pct GROUP BY ALL) USING (connection_id)
""")
def serving_stream(spark, sf_dir):
    """The status appended to its history, and the history mirrored by an incremental stream."""
    out = work_dir(spark, "serving")
    tables.append_history(_snapshot(spark, sf_dir), f"{out}/history")
    history = tables.stream_table(spark, f"{out}/history", CONNECTION_STATUS)
    served = tables.serving_projection(history)
    tables.run_incremental(served, f"{out}/served", f"{out}/checkpoint")
    return spark.read.schema(served.schema).parquet(f"{out}/served").select(
        "connection_id", "status", "completeness_pct", "missing_data_pct",
        F.json_array_length("hourly_metrics").alias("n_hours"),
    )


ZONES = ["Europe/Amsterdam", "Asia/Kolkata", "America/New_York"]


@query("""
SELECT event_id, zone,
       timezone(zone, date_trunc('day', timezone(zone, TIMESTAMPTZ '2024-03-31 22:30:00+00')) - INTERVAL 1 DAY)
           AT TIME ZONE 'UTC' AS window_start,
       timezone(zone, date_trunc('day', timezone(zone, TIMESTAMPTZ '2024-03-31 22:30:00+00')))
           AT TIME ZONE 'UTC' AS window_end
FROM (SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'Europe/Amsterdam' WHEN 1 THEN 'Asia/Kolkata'
                       ELSE 'America/New_York' END AS zone FROM events)
""")
def local_days(spark, sf_dir):
    """The previous local day of rows in different time zones, over a change of clocks."""
    zone = F.element_at(F.array(*map(F.lit, ZONES)), (F.col("event_id") % 3 + 1).cast("int"))
    rows = I.table(spark, sf_dir, "events").select("event_id", zone.alias("zone"))
    return local_day_window(rows, "2024-03-31 22:30:00", "zone")


REFRESH_SQL = f"""
WITH {CONFIG_SQL}, bound AS (SELECT max({PROC}) + INTERVAL 1 SECOND AS now FROM events),
{PROC_HOURS_SQL.format(
    start="(SELECT date_trunc('hour', now - INTERVAL 1 DAY) FROM bound)", end="(SELECT now FROM bound)")},
mean AS (SELECT connection_id, round(avg(completeness), 9) AS m, sum(points) AS points, sum(nulls) AS nulls
         FROM pct GROUP BY connection_id),
latest AS (SELECT 'sensor_' || user_id AS connection_id, max({PROC}) AS last_ts FROM events GROUP BY user_id)
SELECT connection_id, last_ts AS last_sync_timestamp,
       CASE WHEN epoch_us(now) - epoch_us(last_ts) > 4 * 86400000000 THEN 'OFFLINE'
            WHEN epoch_us(now) - epoch_us(last_ts) > 86400000000 THEN 'DELAYED'
            WHEN m < 80 THEN 'DELAYED' ELSE 'ACTIVE' END AS status,
       CAST(points AS INTEGER) AS data_points_24h, CAST(nulls AS INTEGER) AS null_values_24h,
       'RUNNING' AS job_state
FROM cfg LEFT JOIN mean USING (connection_id) LEFT JOIN latest USING (connection_id), bound
"""


@query(REFRESH_SQL)
def stream_health_refresh(spark, sf_dir):
    """A health refresh driven by the stream of facts."""
    out = work_dir(spark, "health")
    trigger = _event_stream(spark, sf_dir).select(
        (F.col("ts") + F.make_dt_interval(secs=F.col("event_id") % 600)).alias("gold_processing_timestamp")
    )
    stream_health(
        trigger, lambda: I.connections(spark, sf_dir), lambda: [I.source(I.facts(spark, sf_dir))],
        f"{out}/status", f"{out}/checkpoint", every=None, as_of=newest("gold_processing_timestamp"),
        critical_cols=["value"],
    ).awaitTermination()
    stored = tables.read_history(spark, f"{out}/status")
    last = stored.agg(F.max("batch").alias("batch"))
    return stored.join(last, "batch").select(
        "connection_id", "last_sync_timestamp", "status", "data_points_24h", "null_values_24h", "job_state"
    )


@query(REFRESH_SQL)
def stream_health_state(spark, sf_dir):
    """The same record after four micro-batches, each of which reads its own facts and the state."""
    out = work_dir(spark, "last-seen")
    facts = I.facts(spark, sf_dir)
    cuts = facts.select(F.percentile_approx(F.unix_micros("ts"), [0.25, 0.5, 0.75]).alias("c")).first()["c"] or []
    micros, part = F.unix_micros("ts"), F.lit(0)
    for cut in cuts:
        part = part + (micros > cut).cast("int")
    for k in range(len(cuts) + 1):
        facts.filter(part == k).write.mode("append").parquet(f"{out}/facts")
        stream_health_from_state(
            tables.stream_table(spark, f"{out}/facts", facts.schema), lambda: I.connections(spark, sf_dir), I.FACTS, f"{out}/status",
            f"{out}/state", f"{out}/checkpoint", ts="ts", every=None, critical_cols=["value"]).awaitTermination()
    stored = tables.read_history(spark, f"{out}/status")
    last = stored.agg(F.max("batch").alias("batch"))
    return stored.join(last, "batch").select(
        "connection_id", "last_sync_timestamp", "status", "data_points_24h", "null_values_24h", "job_state")


@query("""
SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n, NULL::BIGINT AS errors FROM events GROUP BY ALL
UNION ALL
SELECT user_id, CAST(ts AS DATE), count(*), count_if(CAST(props->>'$.k' AS INTEGER) < 10) FROM events GROUP BY ALL
""")
def history_append(spark, sf_dir):
    """Two appends to a history, the second with a new column."""
    daily = I.table(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("day"))
    path = work_dir(spark, "history")
    tables.append_history(daily.agg(F.count(F.lit(1)).alias("n")), path)
    tables.append_history(daily.agg(F.count(F.lit(1)).alias("n"), F.count_if(I.level() < 10).alias("errors")), path)
    return tables.read_history(spark, path)


# --------------------------------------------------------------------------- retention

FILES_SQL = f"""
    files AS (
        SELECT '/land/' || source || '/' || lang || '/' || doc_id || CASE WHEN lang = 'en' THEN '.json' ELSE '.csv' END
               AS path, TIMESTAMP '{I.CREATED}' + to_hours(doc_id) AS modified_at, n_chars AS bytes,
               source AS volume_name, length(source) + 6 AS retention_days,
               CASE WHEN source LIKE 'src1%' THEN 'sensor' ELSE 'meter' END AS connector_name
        FROM documents
    ),
    expired AS (
        SELECT * FROM files WHERE modified_at < TIMESTAMP '{I.AS_OF}' - to_days(CAST(retention_days AS INTEGER))
    ),
    volumes AS (SELECT DISTINCT connector_name, volume_name, retention_days FROM files),
    summary AS (
        SELECT volume_name, count(*) AS files_deleted, CAST(sum(bytes) AS BIGINT) AS bytes_deleted,
               arg_min(path, modified_at) AS oldest_file,
               array_to_string(list_sort(list_distinct(list(string_split(path, '.')[-1]))), ',') AS file_types
        FROM expired GROUP BY volume_name
    ),
    results AS (
        SELECT v.*, coalesce(files_deleted, 0) AS files_deleted, coalesce(bytes_deleted, 0) AS bytes_deleted,
               oldest_file, coalesce(file_types, 'none') AS file_types
        FROM volumes v LEFT JOIN summary USING (volume_name)
    )
"""


def _cleanup(spark, sf_dir) -> DataFrame:
    volumes = I.volumes(spark, sf_dir)
    expired = retention.expired_files(I.landed_files(spark, sf_dir), volumes, I.AS_OF)
    return retention.cleanup_results(volumes, retention.retention_summary(expired, ["volume_name"]), ["volume_name"])


@query(f"WITH {FILES_SQL} SELECT path, modified_at, bytes, volume_name FROM expired")
def retention_expired(spark, sf_dir):
    return retention.expired_files(I.landed_files(spark, sf_dir), I.volumes(spark, sf_dir), I.AS_OF).select(
        "path", "modified_at", "bytes", "volume_name"
    )


@query(f"WITH {FILES_SQL} SELECT * FROM summary")
def retention_summary(spark, sf_dir):
    expired = retention.expired_files(I.landed_files(spark, sf_dir), I.volumes(spark, sf_dir), I.AS_OF)
    return retention.retention_summary(expired, ["volume_name"])


@query(f"""
WITH {FILES_SQL}
SELECT connector_name, count(*) AS volumes, CAST(sum(files_deleted) AS BIGINT) AS files_deleted,
       CAST(sum(bytes_deleted) AS BIGINT) AS bytes_deleted, round(sum(bytes_deleted) / 1073741824.0, 2) AS gb_deleted,
       count(*) AS succeeded, CAST(0 AS BIGINT) AS failed, grouping(connector_name) = 1 AS is_total
FROM results GROUP BY ROLLUP (connector_name)
""")
def cleanup_totals(spark, sf_dir):
    return retention.cleanup_totals(_cleanup(spark, sf_dir))


@query(f"""
WITH {FILES_SQL},
marked AS (
    SELECT CASE WHEN volume_name LIKE '%1%' THEN NULL ELSE connector_name END AS connector_name,
           CASE WHEN volume_name LIKE '%3%' THEN 0 ELSE files_deleted END AS files,
           CASE WHEN volume_name LIKE '%3%' THEN 0 ELSE bytes_deleted END AS bytes,
           volume_name LIKE '%3%' AS bad
    FROM results
)
SELECT connector_name, count(*) AS volumes, CAST(sum(files) AS BIGINT) AS files_deleted, CAST(sum(bytes) AS BIGINT) AS bytes_deleted,
       round(sum(bytes) / 1073741824.0, 2) AS gb_deleted, count_if(NOT bad) AS succeeded, count_if(bad) AS failed,
       grouping(connector_name) = 1 AS is_total
FROM marked GROUP BY ROLLUP (connector_name)
""")
def cleanup_totals_failed(spark, sf_dir):
    """Volumes whose clean-up failed, and volumes without a connector, next to the marked total."""
    volumes = I.volumes(spark, sf_dir)
    volumes = volumes.withColumn("connector_name", F.when(~F.col("volume_name").contains("1"), F.col("connector_name")))
    expired = retention.expired_files(I.landed_files(spark, sf_dir), volumes, I.AS_OF)
    failed = volumes.filter(F.col("volume_name").contains("3"))
    return retention.cleanup_totals(retention.cleanup_results(
        volumes, retention.retention_summary(expired, ["volume_name"]), ["volume_name"], failed))


@query(f"""
WITH {BRONZE_SQL}
SELECT gateway_id, object_id, ts AS "timestamp", v AS "activeEnergyTotal",
       CASE WHEN v >= lag(v) OVER w THEN v - lag(v) OVER w END AS "interval"
FROM bronze WINDOW w AS (PARTITION BY gateway_id, object_id ORDER BY ts)
""")
def counter_delta_narrow(spark, sf_dir):
    """Slices of a second: nearly every predecessor lies in another slice."""
    rows = I.bronze_readings(spark, sf_dir).select(*DELTA_COLUMNS, "_ingested_at", "_source_file")
    return order.counter_delta(
        rows, ["gateway_id", "object_id"], "timestamp", "activeEnergyTotal", tie_break=sensor.REFETCH_ORDER, slice_seconds=1
    ).select(*DELTA_COLUMNS, "interval")


@query(f"""
WITH {FILES_SQL}
SELECT connector_name, volume_name, CAST(retention_days AS INTEGER) AS retention_days,
       CAST(files_deleted AS INTEGER) AS files_deleted_last_run, CAST(bytes_deleted AS BIGINT) AS bytes_deleted_last_run,
       TIMESTAMP '{I.AS_OF}' AS last_cleaned
FROM results
""")
def volume_update(spark, sf_dir):
    """Results of a cleanup written back to the volume table, all volumes in one job."""
    updates = _cleanup(spark, sf_dir).select(
        "volume_name", F.col("files_deleted").alias("files_deleted_last_run"),
        F.col("bytes_deleted").alias("bytes_deleted_last_run"), ts_lit(I.AS_OF).alias("last_cleaned"),
    )
    done = ["files_deleted_last_run", "bytes_deleted_last_run", "last_cleaned"]
    return merge.update_from(I.volumes(spark, sf_dir), updates, ["volume_name"], done).select(
        "connector_name", "volume_name", "retention_days", *done
    )


@query(f"""
WITH {FILES_SQL}
SELECT TIMESTAMP '{I.AS_OF}' AS cleanup_timestamp, '/Volumes/client/land/' || volume_name AS volume_path,
       file_types AS data_type, CAST(files_deleted AS INTEGER) AS files_deleted, bytes_deleted,
       oldest_file AS oldest_file_deleted, connector_name
FROM results WHERE files_deleted > 0
""")
def cleanup_audit(spark, sf_dir):
    """Audit rows of a cleanup appended to the log."""
    empty = spark.createDataFrame([], struct(CLEANUP_AUDIT))
    rows = retention.audit_rows(_cleanup(spark, sf_dir), I.AS_OF)
    return merge.append_audit(empty, rows).select(
        "cleanup_timestamp", "volume_path", "data_type", "files_deleted", "bytes_deleted", "oldest_file_deleted",
        "connector_name",
    )


@query("""
SELECT doc_id, CASE WHEN source LIKE 'src1%' THEN 'sensor' WHEN regexp_matches(source, '^src.*[02468]$') THEN 'even'
                    WHEN source LIKE 'src%' THEN 'rest' END AS assigned
FROM documents
""")
def assign_source(spark, sf_dir):
    """First matching prefix or glob wins."""
    patterns = [("sensor", "prefix", "src1"), ("even", "glob", "src*[02468]"), ("rest", "prefix", "src")]
    docs = I.table(spark, sf_dir, "documents").select("doc_id", "source")
    return retention.assign_source(docs, patterns, "source", "assigned").drop("source")


@query("""
SELECT event_id, ts FROM events
WHERE ts >= TIMESTAMP '2024-01-18 23:00:00' AND ts < TIMESTAMP '2024-01-19 23:00:00'
""")
def day_window(spark, sf_dir):
    """Half-open window on the bare time column."""
    return I.table(spark, sf_dir, "events").select("event_id", "ts").filter(within("ts", WINDOW_START, WINDOW_END))
