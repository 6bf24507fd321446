import json

import pytest
from pyspark.sql import functions as F

from gaugeline import schemas
from gaugeline.functions import keys as K
from gaugeline.operators import flatten, landing, rollup
from gaugeline.operators.pivot import pivot_categories
from gaugeline.plans import meter, sensor
from gaugeline.sources import envelopes, tables

READING = {
    "target_date": "2024-01-01", "window_index": 0, "begin_timestamp": 0, "end_timestamp": 60, "resolution": "30s",
    "processing_timestamp": "20240101_000000",
    "raw_response": {"id": "g1", "ip": "1.2.3.4", "data": [
        {"timestamp": 1704067200, "values": {"7": {"currentTrms": "1.5", "activeEnergyTotal": "10"},
                                             "8": {"currentTrms": "bad"}}},
        {"timestamp": 1704067230, "values": {"7": {"activeEnergyTotal": "12"}}},
    ]},
}


def drop(tmp_path, doc, name="a.json", entity="g1", kind="data", day="20240101"):
    folder = tmp_path / entity / kind / day
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps(doc, indent=2))
    return str(tmp_path)


def test_surrogate_key_value_and_null_parts(spark):
    df = spark.createDataFrame([("a", 1, None)], "x string, y int, z string")
    r = df.select(K.surrogate_key("x", "y").alias("k"), K.surrogate_key("x", "y", "z").alias("n"),
                  K.surrogate_key("x", "z", strict=True).alias("s"), K.surrogate_key("x", tag="T").alias("t"),
                  K.natural_key("x", "y").alias("nk")).first()
    assert r["k"] == "df4504ce92500fe8a20fb37090e36afa9053480c3e8dde4f4ae3fab4f5d8b1d7"
    assert r["n"] == r["k"] and r["s"] is None and r["nk"] == "a|1" and r["t"] != r["k"]


def test_direction_and_event_date(spark, rows):
    df = spark.createDataFrame([(True,), (False,), (None,)], "e boolean")
    assert rows(df.select("e", K.flow_direction("e"))) == [(None, "Import"), (False, "Import"), (True, "Export")]
    d = spark.sql("SELECT TIMESTAMP '2024-02-29 23:59:59 UTC' AS ts").select(K.event_date("ts").cast("string")).first()[0]
    assert d == "2024-02-29"


def test_bucket_start(spark):
    ts = spark.sql("SELECT TIMESTAMP '2024-01-01 03:59:59 UTC' AS ts, 1.0D AS v")
    r = rollup.rollup_interval(ts, [], "ts", 15, mean=["v"]).select(F.col("timestamp_bucket").cast("string"), "v").first()
    assert tuple(r) == ("2024-01-01 03:45:00", 1.0)


def test_rollup_rounds_and_keeps_maxima(spark):
    df = spark.createDataFrame([("s", 0, 1.005, 5.0, 1.0), ("s", 60, 2.0, 7.0, 2.126), ("s", 900, 9.0, 6.0, 1.0)],
                               "k string, s long, g double, c double, d double").withColumn("ts", F.timestamp_seconds("s"))
    out = rollup.rollup_interval(df, ["k"], "ts", 15, mean=["g"], last=["c"], total=["d"]).orderBy("timestamp_bucket")
    assert [tuple(r)[2:] for r in out.collect()] == [(1.5, 7.0, 3.13), (9.0, 6.0, 1.0)]


def test_pivot_takes_first_known_value(spark, rows):
    df = spark.createDataFrame(
        [("h1", 10, None, 1, None), ("h1", 26, 5.0, 2, "d"), ("h1", 26, 6.0, 3, "e"), ("h2", 10, None, 1, None),
         ("h3", 10, 1.0, 1, None), ("h3", 99, 4.0, 1, "x")], "h string, cat int, v double, n int, drift string")
    wide = pivot_categories(df, ["h"], "cat", "v", schemas.BUNDLE_CATEGORIES, ["n"], drift="drift")
    assert rows(wide, "h", "energy_production", "energy_export", "energy_import", "drift") == [
        ("h1", None, 5.0, None, "d"), ("h3", 1.0, None, None, None)]


@pytest.mark.parametrize("streaming", [False, True])
def test_scan_and_flatten_readings(spark, rows, tmp_path, streaming):
    root = drop(tmp_path / "land", READING)
    env = envelopes.with_provenance(
        envelopes.scan_envelopes(spark, root, schemas.READINGS_ENVELOPE, streaming=streaming))
    flat = flatten.flatten_readings(env)
    if streaming:
        tables.run_incremental(flat, str(tmp_path / "out"), str(tmp_path / "cp"))
        tables.run_incremental(flat, str(tmp_path / "out"), str(tmp_path / "cp"))
        flat = spark.read.parquet(str(tmp_path / "out"))
    got = rows(flat, F.unix_timestamp("timestamp"), "object_id", "currentTrms", "activeEnergyTotal", "gateway_id")
    assert got == [(1704067200, 7, 1.5, 10.0, "g1"), (1704067200, 8, None, None, "g1"),
                   (1704067230, 7, None, 12.0, "g1")]
    assert flat.filter("_source_file LIKE '%a.json' AND _file_modification_time IS NOT NULL").count() == 3


def test_drift(spark, tmp_path):
    doc = {**READING, "extra": 1, "window_index": "no number"}
    doc["raw_response"] = {**READING["raw_response"], "serial": "s", "data": [{"timestamp": 1, "values": {}, "q": 2}]}
    root = drop(tmp_path, doc, "b.json")
    drop(tmp_path, READING, "a.json")
    (tmp_path / "g1" / "data" / "20240101" / "c.json").write_text("{broken")
    text = envelopes.scan_text(spark, root)
    got = {r["_source_file"][-6:]: r for r in envelopes.with_drift_column(text, schemas.READINGS_ENVELOPE).collect()}
    assert got["a.json"]["_rescued_data"] is None and got["a.json"]["raw_response"]["id"] == "g1"
    found = json.loads(got["b.json"]["_rescued_data"])
    assert set(found) == {"extra", "window_index", "raw_response.serial", "raw_response.data[]"}
    assert found["extra"] == "1" and json.loads(found["raw_response.data[]"]) == [{"q": "2"}]
    assert got["b.json"]["resolution"] == "30s" and got["b.json"]["window_index"] is None
    assert json.loads(got["c.json"]["_rescued_data"]) == {"_corrupt": "{broken"}
    allowed = envelopes.with_drift_column(text, schemas.READINGS_ENVELOPE,
                                          allowed=["extra", "window_index", "raw_response.serial", "raw_response.data[]"])
    assert [r["_rescued_data"] for r in allowed.filter("_source_file LIKE '%b.json'").collect()] == [None]


DEEP = """a int, s string, d double, b boolean, t timestamp, list array<int>, rows array<struct<x: int, tags: array<string>, m: map<string, int>>>,
    by map<string, struct<v: double, inner: struct<w: int>>>, o struct<p: struct<q: int>>"""

DEEP_CASES = [
    ('{"a": 1, "s": 2, "d": 3, "b": true, "list": [1, null], "rows": [], "by": {}, "o": null}', None),
    ('{"a": "1", "d": "2.5", "b": 1, "t": "no time", "s": {"any": [1]}}', {"a": "1", "d": "2.5", "b": "1", "t": "no time"}),
    ('{"a": 1.5, "list": 7, "rows": {"x": 1}, "by": [1], "o": "text"}',
     {"a": "1.5", "list": "7", "rows": '{"x":1}', "by": "[1]", "o": "text"}),
    ('{"a": 99999999999, "list": [1, "x", 2.5, null]}', {"a": "99999999999", "list[1]": "x", "list[2]": "2.5"}),
    ('{"rows": [{"x": 1}, {"x": "y", "u": 5, "m": {"k": "v", "n": 1}}, 3, {"u": {"deep": 1}}]}',
     {"rows[]": '[{"u":"5"},{"u":"{\\"deep\\":1}"}]', "rows[1].x": "y", "rows[1].m.k": "v", "rows[2]": "3"}),
    ('{"by": {"k": {"v": "bad", "z": 1, "inner": {"w": "w", "y": true}}, "l": 4, "ok": {"v": 1}}}',
     {"by.k.v": "bad", "by.k.z": "1", "by.k.inner.w": "w", "by.k.inner.y": "true", "by.l": "4"}),
    ('{"o": {"p": {"q": {}, "r": [1, {"s": 2}]}, "extra": null}}', {"o.p.q": "{}", "o.p.r": '[1,{"s":2}]', "o.extra": None}),
    ('{"o.p": 1, "o": {"p": 2}}', {"o.p": "1"}),
    ("[1]", {"_corrupt": "[1]"}), ("", {"_corrupt": ""}), ("null", {"_corrupt": "null"}), ('{"a": 1, "a": 2}', {"_corrupt": '{"a": 1, "a": 2}'}),
    (None, None),
]


def test_drift_at_any_depth(spark):
    df = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(DEEP_CASES)], "n int, value string")
    got = {r["n"]: r for r in envelopes.with_drift_column(df, DEEP).collect()}
    for i, (text, left) in enumerate(DEEP_CASES):
        found = got[i]["_rescued_data"]
        assert (found and json.loads(found)) == left, text
    first, rows_, by = got[0], got[4], got[5]
    assert (first["a"], first["s"], first["d"], first["b"], first["list"], first["o"]) == (1, "2", 3.0, True, [1, None], None)
    assert [r and r["x"] for r in rows_["rows"]] == [1, None, None, None] and rows_["rows"][1]["m"] == {"k": None, "n": 1}
    assert by["by"]["k"]["v"] is None and by["by"]["l"] is None and by["by"]["ok"]["v"] == 1.0


def test_drift_allows_paths_of_any_element(spark):
    df = spark.createDataFrame([('{"list": [1, "x", "y"], "rows": [{"u": 1}], "a": "z"}',)], "value string")
    left = envelopes.with_drift_column(df, DEEP, allowed=["list[]", "rows[]"]).first()["_rescued_data"]
    assert json.loads(left) == {"a": "z"}


def test_drift_parses_once(spark):
    df = envelopes.with_drift_column(spark.createDataFrame([("{}",)], "value string"), DEEP)
    assert df._jdf.queryExecution().optimizedPlan().toString().lower().count("parse_json") <= 1


def test_write_never_overwrites_and_list(spark, rows, tmp_path):
    df = spark.createDataFrame([("g1", "20240101", 1), ("g2", "20240102", 2)], "e string, d string, n int")
    root = str(tmp_path / "land")
    for _ in range(2):
        envelopes.write_envelopes(df, root, "e", "data", "d")
    drop(tmp_path / "land", READING, entity="g3")
    listed = envelopes.list_landed(spark, root)
    assert rows(listed.groupBy("entity", "kind", "day").count()) == [
        ("g1", "data", "20240101", 2), ("g2", "data", "20240102", 2), ("g3", "data", "20240101", 1)]
    assert listed.filter("bytes > 0 AND modified_at IS NOT NULL").count() == 5


def sensor_snapshot(day, name, ingested):
    variable = {"category": "c", "unit": "W", "multiplier": 0.1, "readable": True, "relation": ["r"], "address": 3}
    return {"snapshot_date": day, "processing_timestamp": ingested, "raw_response": {
        "id": "g1", "ip": "i", "serialNumber": "gs", "CurrentSensor": [
            {"name": name, "object_id": 7, "is_energy_export": 1, "modbus_id": 2, "serial_number": "s",
             "variables": {"power": variable}},
            {"name": "dropped", "object_id": None, "variables": {}}]}}


def test_sensor_dimension(spark, tmp_path):
    drop(tmp_path, sensor_snapshot("20240101", "old", "1"), "a.json", kind="metadata")
    drop(tmp_path, sensor_snapshot("20240101", "new", "2"), "b.json", kind="metadata")
    text = envelopes.scan_text(spark, str(tmp_path))
    env = envelopes.with_drift_column(text, schemas.SENSOR_SNAPSHOT_ENVELOPE)
    env = env.withColumn("_ingested_at", F.timestamp_seconds(F.col("processing_timestamp").cast("long")))
    dim = sensor.dim_sensors(sensor.bronze_snapshots(env), "Current Sensor", "Maker").collect()
    assert len(dim) == 1
    r = dim[0]
    assert (r["name"], r["direction"], r["object_id"], r["original_id"]) == ("new", "Export", 7, "g1|7")
    assert r["variables"][0].asDict() == {
        "name": "power", "category": "c", "dataType": None, "unit": "W", "multiplier": 0.1, "dbWriteInterval": None,
        "dbStorePolicy": None, "readable": True, "writable": None, "invalidValues": None, "relation": ["r"]}


def test_meter_flow(spark, rows, tmp_path):
    bundle = [{"energyasset": 5, "energyassetcategory": c, "bundle": 1.0, "expectedvalue": 0.0,
               "timestamp": "2024-01-01T01:00:00Z", "value": v} for c, v in ((10, None), (26, 1.23456), (27, 2.0), (11, 9.0))]
    doc = {"account_id": 3, "target_date": "2024-01-01", "processing_timestamp": "p",
           "raw_response": {"energyassetbundles": bundle}}
    drop(tmp_path, doc)
    drop(tmp_path, doc, "again.json")
    env = envelopes.with_drift_column(envelopes.scan_text(spark, str(tmp_path)), schemas.BUNDLES_ENVELOPE)
    silver = meter.silver_meters(meter.bronze_bundles(env))
    facts = meter.fact_meters(silver)
    assert rows(facts[meter.GRID], "account_id", "energyasset_id", "energy_import", "energy_export") == [
        (3, 5, 2.0, 1.2346)]
    assert facts[meter.PRODUCTION].count() == 0


def test_asset_dimension(spark, rows, tmp_path):
    doc = {"snapshot_date": "20240101", "processing_timestamp": "p", "account_id": 3, "raw_response": {"energyassets": [
        {"energyasset": 5, "account": 3, "validated": "2024-01-01T00:00:00", "bundles": {"10": [1.0]}},
        {"energyasset": None}]}}
    drop(tmp_path, doc)
    env = envelopes.with_drift_column(envelopes.scan_text(spark, str(tmp_path)), schemas.ASSET_SNAPSHOT_ENVELOPE)
    dim = meter.dim_assets(meter.bronze_assets(env), meter.GRID, "Maker")
    assert rows(dim, "account_id", "energyasset_id", "asset_type", "original_id") == [(3, 5, "Maker EConnection", "3|5")]


def test_conform(spark):
    df = spark.createDataFrame([("1", None)], "a string, b string")
    schema = schemas.with_comments(schemas.struct("a int, c double"), {"a": "first"})
    out = tables.conform(df.select("a"), schema)
    assert out.dtypes == [("a", "int"), ("c", "double")] and out.schema["a"].metadata == {"comment": "first"}
    with pytest.raises(ValueError):
        tables.conform(df, schema)
    assert tables.conform(df, schema, allow_extra=True).columns == ["a", "c"]
    with pytest.raises(Exception, match="required column b"):
        tables.conform(df, "b string", required=["b"], allow_extra=True).collect()


def test_history_gains_columns(spark, rows, tmp_path):
    path = str(tmp_path / "h")
    tables.append_history(spark.sql("SELECT 1 AS a, struct(1 AS x) AS s"), path)
    tables.append_history(spark.sql("SELECT 2 AS a, struct(1 AS x, 2 AS y) AS s, 'n' AS b"), path)
    assert rows(tables.read_history(spark, path), "a", "b", "s.y") == [(1, None, None), (2, "n", 2)]


def test_landing_summary(spark, rows):
    log = spark.createDataFrame([("a", "success", 3), ("a", "error", None), ("b", "success", 4)],
                                "entity string, status string, samples int")
    assert rows(landing.landing_summary(log, mark_total=False)) == [(None, 3, 2, 7, 1), ("a", 2, 1, 3, 1), ("b", 1, 1, 4, 0)]
    assert landing.landing_errors(log).count() == 1
