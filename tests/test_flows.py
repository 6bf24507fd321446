"""Both feeds from landed files to connection status, as batch and as stream."""

import json

import pytest
from pyspark.sql import functions as F

from gaugeline import schemas
from gaugeline.operators.config import FactSource, build_connection_config
from gaugeline.operators.order import latest_inventory
from gaugeline.operators.quality import assert_unique
from gaugeline.operators.status import overall_status, status_snapshot
from gaugeline.plans import meter, rules, sensor
from gaugeline.sources import envelopes, merge, tables
from gaugeline.streaming.state import read_split, write_with_late

START = 1705532400  # 2024-01-17 23:00 UTC


def land(root, entity, kind, name, doc):
    folder = root / entity / kind / "20240119"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps(doc))


def readings(window, hours=8):
    first = START + window * hours * 3600
    data = [{"timestamp": t, "values": {s: {"currentTrms": "1.0", "activePowerTotal": "2.345",
                                            "activeEnergyTotal": str((t - START) / 3600 * int(s))} for s in ("1", "2")}}
            for t in range(first, first + hours * 3600, 900)]
    return {"target_date": "2024-01-19", "window_index": window, "begin_timestamp": first, "end_timestamp": first,
            "resolution": "30s", "processing_timestamp": "p", "raw_response": {"id": "g1", "ip": "i", "data": data}}


@pytest.mark.parametrize("mode", ["batch", "stream"])
def test_sensor_feed(spark, tmp_path, mode, rows):
    root = tmp_path / "land"
    for w in range(6):
        land(root, "g1", "data", f"w{w}.json", readings(w))
        land(root, "g1", "data", f"w{w}_again.json", readings(w))
    variables = {"power": {"unit": "W"}}
    land(root, "g1", "metadata", "m.json", {"snapshot_date": "20240119", "raw_response": {
        "id": "g1", "ip": "i", "serialNumber": "s",
        "CurrentSensor": [{"name": f"s{i}", "object_id": i, "is_energy_export": 0, "variables": variables} for i in (1, 2, 3)]}})

    data = str(root / "g1" / "data")
    text = envelopes.scan_text(spark, data, streaming=mode == "stream")
    bronze = sensor.bronze_readings(envelopes.with_drift_column(text, schemas.READINGS_ENVELOPE))
    if mode == "batch":
        silver = sensor.silver_readings(bronze)
        fact = sensor.fact_readings(silver)
    else:
        tables.run_incremental(bronze, str(tmp_path / "bronze"), str(tmp_path / "c1"))
        silver = sensor.stream_silver_readings(tables.stream_table(spark, str(tmp_path / "bronze"), bronze.schema))
        write_with_late(silver, str(tmp_path / "silver"), str(tmp_path / "c2"))
        assert read_split(spark, str(tmp_path / "silver"), silver.schema, late=True).count() == 0
        stored = tables.stream_table(spark, str(tmp_path / "silver"), silver.schema).drop("is_late")
        fact = sensor.fact_readings(stored)
        tables.run_incremental(fact, str(tmp_path / "gold"), str(tmp_path / "c3"), partition_by=["event_date"])
        fact = spark.read.parquet(str(tmp_path / "gold"))
    assert assert_unique(fact, rules.FACT_KEY).count() == 2 * 6 * 8 * 4
    by_sensor = fact.groupBy("object_id").agg(F.min("energy_interval"), F.max("energy_interval"), F.count("energy_interval"))
    assert rows(by_sensor) == [(1, 0.25, 0.25, 191), (2, 0.5, 0.5, 191)]

    meta = envelopes.with_drift_column(envelopes.scan_text(spark, str(root / "g1" / "metadata")), schemas.SENSOR_SNAPSHOT_ENVELOPE)
    dim = sensor.dim_sensors(sensor.bronze_snapshots(meta), "Current Sensor", "Maker")
    joined = fact.join(dim, "sk", "left")
    assert joined.filter("name IS NULL").count() == 0

    template = sensor.connection_template("sensor", "views.sensor_15min", "Maker", "Client", "job")
    config = build_connection_config(latest_inventory(dim, sensor.KEYS), template, "2024-01-19")
    empty = config.limit(0)
    payload = [c for c in config.columns if c not in ("connection_id", "created_at")]
    config = merge.upsert(empty, config, ["connection_id"], payload, ["created_at"])
    as_of = "2024-01-19 23:30:00"
    view = sensor.quarter_hour_view(fact, as_of)
    source = FactSource("views.sensor_15min", view, ts="timestamp_bucket", key_sets=(("sk",),))
    snap = status_snapshot(config, source, as_of, "run")
    got = {r["connection_id"]: r for r in snap.collect()}
    # The data ends at 2024-01-19 23:00, and the local day at 23:00 the day before the check.
    assert {k: r["status"] for k, r in got.items()} == {
        "sensor_g1_1": "ACTIVE", "sensor_g1_2": "ACTIVE", "sensor_g1_3": "OFFLINE"}
    assert got["sensor_g1_1"]["data_gap_count"] == 0 and got["sensor_g1_1"]["completeness_pct"] == 100.0
    assert got["sensor_g1_3"]["data_gaps"][0]["missing_records"] == 95
    assert overall_status(snap).first()["overall_status"] == "OFFLINE"
    history = str(tmp_path / "history")
    tables.append_history(snap, history)
    assert tables.read_history(spark, history, schemas.struct(schemas.CONNECTION_STATUS)).count() == 3


@pytest.mark.parametrize("mode", ["batch", "stream"])
def test_meter_feed(spark, tmp_path, mode, rows):
    root = tmp_path / "land"
    bundles = [{"energyasset": 5, "energyassetcategory": c, "timestamp": f"2024-01-19T{h:02}:00:00Z", "value": v}
               for h in range(4) for c, v in ((10, None if h else 1.0), (26, 0.5), (27, 2.0), (3, 9.0))]
    for name in ("a.json", "b.json"):
        land(root, "3", "data", name, {"account_id": 3, "target_date": "d", "raw_response": {"energyassetbundles": bundles}})
    text = envelopes.scan_text(spark, str(root), streaming=mode == "stream")
    bronze = meter.bronze_bundles(envelopes.with_drift_column(text, schemas.BUNDLES_ENVELOPE))
    if mode == "batch":
        facts = meter.fact_meters(meter.silver_meters(bronze))
    else:
        silver = meter.stream_silver_meters(bronze)
        write_with_late(silver, str(tmp_path / "silver"), str(tmp_path / "c1"))
        facts = meter.fact_meters(tables.stream_table(spark, str(tmp_path / "silver"), silver.schema))
        for name, fact in list(facts.items()):
            tables.run_incremental(fact, str(tmp_path / name), str(tmp_path / f"c_{name}"))
            facts[name] = spark.read.parquet(str(tmp_path / name))
    assert rows(facts[meter.GRID], F.hour("timestamp"), "energy_import", "energy_export") == [(h, 2.0, 0.5) for h in range(4)]
    assert rows(facts[meter.PRODUCTION], F.hour("timestamp"), "energy_production") == [(0, 1.0)]
