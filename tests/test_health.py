from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from gaugeline.functions.time import local_day_bounds, local_day_window
from gaugeline.operators import config as C
from gaugeline.operators import gaps, metrics, status
from gaugeline.schemas import CONNECTION_CONFIG, struct
from gaugeline.sources.tables import serving_projection

AS_OF = "2024-01-20 12:00:00"  # the local day is [01-18 23:00, 01-19 23:00) UTC


def make_config(spark, entries):
    """(id, interval, delayed, offline, attributes, table) rows."""
    base = {f.name: None for f in struct(CONNECTION_CONFIG).fields}
    rows = [
        {**base, "connection_id": i, "expected_interval_minutes": iv, "delayed_threshold_days": d,
         "offline_threshold_days": o, "other_metadata": meta, "gold_table_name": t}
        for i, iv, d, o, meta, t in entries
    ]
    return spark.createDataFrame([tuple(r.values()) for r in rows], struct(CONNECTION_CONFIG))


def by_sk(spark, *entries):
    return make_config(spark, [(i, iv, 1, 4, f'{{"filter_clause": "sk = \'{i}\'"}}', "t") for i, iv in entries])


def make_facts(spark, entries):
    """(sk, event time, delay seconds) rows."""
    df = spark.createDataFrame(entries, "sk string, t string, delay int")
    return df.select("sk", F.to_timestamp("t").alias("timestamp")).withColumn(
        "gold_processing_timestamp", F.col("timestamp")) if not entries else df.select(
        "sk", F.to_timestamp("t").alias("timestamp"),
        (F.to_timestamp("t") + F.make_dt_interval(secs=F.col("delay"))).alias("gold_processing_timestamp"))


def source(frame, **kw):
    return C.FactSource("t", frame, **kw)


@pytest.mark.parametrize("as_of, start, end, hours", [
    ("2024-04-01 10:00:00", "2024-03-30 23:00:00", "2024-03-31 22:00:00", 23),
    ("2024-10-28 10:00:00", "2024-10-26 22:00:00", "2024-10-27 23:00:00", 25),
])
def test_local_day_over_a_change_of_clocks(spark, as_of, start, end, hours):
    a, b = local_day_bounds(as_of)
    assert (a, b) == tuple(datetime.fromisoformat(x).replace(tzinfo=timezone.utc) for x in (start, end))
    assert (b - a).total_seconds() == hours * 3600
    row = local_day_window(spark.sql("SELECT 'Europe/Amsterdam' AS z"), as_of, "z").select(
        F.col("window_start").cast("string"), F.col("window_end").cast("string")).first()
    assert tuple(row) == (start, end)


def gap_rows(spark, times, interval, window_minutes=120):
    config = C.connection_predicate(by_sk(spark, ("c", interval)))
    frame = spark.createDataFrame([("c", float(m)) for m in times] or [("other", 0.0)], "sk string, m double")
    frame = frame.select("sk", F.timestamp_seconds(F.col("m") * 60).alias("timestamp"))
    found = gaps.detect_gaps(source(frame), config, AS_OF, window=("1970-01-01 00:00:00", f"1970-01-01 0{window_minutes // 60}:00:00"))
    return [((r[0]) // 60, (r[1]) // 60, r[2], r[3]) for r in found.select(
        F.unix_timestamp("gap_start"), F.unix_timestamp("gap_end"), "gap_duration_minutes", "missing_records",
    ).orderBy("gap_start").collect()]


def test_gaps(spark):
    assert gap_rows(spark, [0, 15, 30, 75], 15) == [(30, 75, 45, 2), (75, 120, 45, 2)]
    assert gap_rows(spark, [0, 22.5, 37.5, 52.5, 67.5, 82.5, 97.5, 112.5], 15) == []
    assert gap_rows(spark, [0, 37.5, 52.5, 67.5, 82.5, 97.5, 112.5], 15) == [(0, 37, 38, 1)]
    assert gap_rows(spark, [], 15) == [(0, 120, 120, 7)]
    for off in (1440, None, 0, -5):
        assert gap_rows(spark, [0], off) == []


def test_gaps_do_not_depend_on_partitioning(spark, rows):
    times = [i * 7 % 1440 + (i % 13) * 30 for i in range(80)]
    frame = spark.createDataFrame([("c", m, i) for i, m in enumerate(times)] * 3, "sk string, m int, i int")
    frame = frame.select("sk", (F.lit(1705618800) + F.col("m") * 60).cast("timestamp").alias("timestamp"))
    config = C.connection_predicate(by_sk(spark, ("c", 5)))
    want = rows(gaps.detect_gaps(source(frame.coalesce(1)), config, AS_OF))
    assert want and rows(gaps.detect_gaps(source(frame.repartition(7)), config, AS_OF)) == want


def test_hourly_metrics(spark, rows):
    at = ["2024-01-19 10:00:00", "2024-01-19 10:15:00", "2024-01-19 10:15:00"]
    facts = make_facts(spark, [("c", t, 120) for t in at] + [("c", f"2024-01-19 11:{m:02}:00", 60) for m in (0, 10, 20, 30, 40)]
                       + [("c", "2024-01-18 22:59:59", 0), ("c", "2024-01-19 23:00:00", 0), ("x", at[0], 0)])
    config = C.connection_predicate(by_sk(spark, ("c", 15), ("slow", 90), ("d", 1440)))
    hours = metrics.hourly_metrics(source(facts), config, AS_OF)
    got = rows(hours, F.hour("hour"), "data_points", "expected_records", "completeness_pct", "duplicate_timestamps",
               "avg_delay_minutes", "max_delay_minutes", "uptime_pct", "total_validation_errors")
    assert got == [(10, 3, 4, 75.0, 1, 2.0, 2.0, 100.0, 1), (11, 5, 4, 100.0, 0, 1.0, 1.0, 100.0, 0)]
    dense = metrics.hourly_metrics(source(facts), config, AS_OF, dense_hours=True)
    assert rows(dense.groupBy("connection_id").agg(F.count("*"), F.sum("data_points"), F.min("uptime_pct"))) == [
        ("c", 24, 8, 0.0), ("slow", 24, 0, 0.0)]


def test_interval_over_an_hour_expects_nothing(spark):
    facts = make_facts(spark, [("c", "2024-01-19 10:00:00", 0)])
    config = C.connection_predicate(by_sk(spark, ("c", 90)))
    r = metrics.hourly_metrics(source(facts), config, AS_OF).first()
    assert (r["expected_records"], r["completeness_pct"]) == (0, 0.0)


def test_daily_metrics_are_one_row(spark, rows):
    facts = make_facts(spark, [("d", "2024-01-18 23:30:00", 60), ("d", "2024-01-19 10:00:00", 60)])
    config = C.connection_predicate(by_sk(spark, ("d", 1440)))
    got = rows(metrics.daily_metrics(source(facts), config, AS_OF), F.col("hour").cast("string"), "data_points",
               "expected_records", "completeness_pct", "duplicate_timestamps")
    assert got == [("2024-01-18 23:00:00", 2, 1, 100.0, 0)]


def test_no_processing_time_gives_no_delay(spark):
    facts = make_facts(spark, [("c", "2024-01-19 10:00:00", 30)]).drop("gold_processing_timestamp")
    config = C.connection_predicate(by_sk(spark, ("c", 15)))
    assert metrics.hourly_metrics(source(facts), config, AS_OF).first()["avg_delay_minutes"] is None


def test_summary_averages_hours(spark):
    hours = spark.createDataFrame(
        [("c", 3, 75.0, 100.0, 2.0, 1, 1, 0), ("c", 4, 100.0, 100.0, None, 0, 0, 0)],
        "connection_id string, data_points int, completeness_pct double, uptime_pct double, avg_delay_minutes double, "
        "total_validation_errors int, duplicate_timestamps int, null_values int")
    r = metrics.summary_24h(hours).first()
    assert (r["completeness_pct"], r["avg_delay_minutes"], r["data_points_24h"], r["uptime_pct_24h"]) == (87.5, 2.0, 7, 100.0)


@pytest.mark.parametrize("age_minutes, completeness, job, want", [
    (1440, 85.0, "SUCCESS", "ACTIVE"), (1441, 85.0, "SUCCESS", "DELAYED"), (5761, 85.0, "SUCCESS", "OFFLINE"),
    (5, 79.99, "SUCCESS", "DELAYED"), (5, None, "SUCCESS", "ACTIVE"), (5, 99.0, "FAILED", "OFFLINE"),
    (None, None, "SUCCESS", "OFFLINE"),
])
def test_status_rules(spark, age_minutes, completeness, job, want):
    df = spark.createDataFrame([(age_minutes, completeness, job, 1, 4)],
                               "age int, mean_completeness double, job_state string, delayed_threshold_days int, offline_threshold_days int")
    df = df.withColumn("last_sync_timestamp", F.to_timestamp(F.lit(AS_OF)) - F.make_dt_interval(mins=F.col("age")))
    assert status.connection_status(df, AS_OF).first()["status"] == want


def test_threshold_defaults(spark):
    df = spark.sql(f"SELECT TIMESTAMP '{AS_OF} UTC' - INTERVAL 3 DAYS AS last_sync_timestamp, CAST(NULL AS DOUBLE) AS "
                   "mean_completeness, 'SUCCESS' AS job_state, NULL AS delayed_threshold_days, NULL AS offline_threshold_days")
    assert status.connection_status(df, AS_OF).first()["status"] == "DELAYED"
    assert status.connection_status(df, AS_OF, delayed_days=5, offline_days=9).first()["status"] == "ACTIVE"


def test_snapshot_holds_every_connection(spark):
    facts = make_facts(spark, [("ok", f"2024-01-19 {h:02}:{m}:00", 60) for h in range(23) for m in ("00", "30")]
                       + [("ok", "2024-01-20 11:00:00", 0), ("bad", "2024-01-19 10:00:00", 0)])
    config = by_sk(spark, ("ok", 30), ("silent", 30), ("bad", None), ("daily", 1440)).unionByName(
        make_config(spark, [("lost", 30, 1, 4, None, "missing")]))
    snap = status.status_snapshot(config, [source(facts), C.FactSource("missing", None)], AS_OF, "r1")
    got = {r["connection_id"]: r for r in snap.collect()}
    assert {k: r["status"] for k, r in got.items()} == {
        "ok": "ACTIVE", "silent": "OFFLINE", "bad": "OFFLINE", "daily": "OFFLINE", "lost": "OFFLINE"}
    assert len(got["ok"]["hourly_metrics"]) == 23 and got["ok"]["data_points_24h"] == 46
    assert got["ok"]["data_gap_count"] == 1 and got["ok"]["data_gaps"][0]["gap_duration_minutes"] == 60
    assert got["silent"]["data_gap_count"] == 1 and got["silent"]["data_gaps"][0]["missing_records"] == 47
    assert got["silent"]["hourly_metrics"] is None and got["silent"]["completeness_pct"] is None
    assert got["daily"]["data_gap_count"] == 0 and got["daily"]["data_gaps"] is None
    assert got["lost"]["data_gap_count"] is None and got["lost"]["job_state"] == "SUCCESS"
    assert got["bad"]["job_state"] == "ERROR" and got["bad"]["last_sync_timestamp"] is None
    assert [h["hour"] for h in got["ok"]["hourly_metrics"]] == sorted(h["hour"] for h in got["ok"]["hourly_metrics"])
    total = status.overall_status(snap).first()
    assert tuple(total) == ("OFFLINE", 5, 1, 0, 4, 1)
    served = serving_projection(snap).filter("connection_id = 'ok'").first()
    assert served["missing_data_pct"] == 0.0 and served["hourly_metrics"].startswith("[{")
    assert gaps.recent_gaps(snap, 1).count() == 1


def test_failed_job_is_offline(spark):
    facts = make_facts(spark, [("ok", "2024-01-20 11:00:00", 0)])
    snap = status.status_snapshot(by_sk(spark, ("ok", 30)), source(facts), AS_OF, "r", job_state="FAILED")
    assert snap.first()["status"] == "OFFLINE"


def test_streaming_status(spark):
    facts = make_facts(spark, [("c", "2024-01-20 11:00:00", 60)]).withColumn("W", F.lit(None).cast("double"))
    facts = facts.withColumn("ingestionTimestamp", F.col("timestamp") + F.expr("INTERVAL 125 SECONDS"))
    config = by_sk(spark, ("c", 60))
    strict = config.withColumn("delayed_threshold_days", F.lit(None).cast("int"))
    r = status.streaming_status(strict, source(facts), AS_OF, "r", ["W", "timestamp", "absent"]).first()
    assert (r["status"], r["null_values_24h"], r["job_state"]) == ("DELAYED", 1, "RUNNING")
    assert r["hourly_metrics"][0]["avg_delay_minutes"] == 2.08
    assert status.streaming_status(config, source(facts), AS_OF, "r").first()["status"] == "ACTIVE"
    assert status.streaming_status(strict, source(facts), AS_OF, "r", delayed_days=0.25).first()["status"] == "ACTIVE"


def test_predicate_precedence(spark, rows):
    def meta(**kw):
        import json

        return json.dumps(kw)

    config = make_config(spark, [
        ("a", 15, 1, 4, meta(ean="e", key="k", building_uuid="b", filter_clause="x = '1'"), "t"),
        ("b", 15, 1, 4, meta(ean="e", building_uuid="b"), "t"), ("c", 15, 1, 4, meta(building_uuid="b", filter_clause="x = '1'"), "t"),
        ("d", 15, 1, 4, meta(filter_clause="x = '1'", timestamp_col="ts2"), "t"), ("e", 15, 1, 4, meta(filter_clause="x > 1"), "t"),
        ("f", 15, 1, 4, meta(ean=""), "t"), ("g", 15, 1, 4, "no json", "t"), ("h", 15, 1, 4, None, "t"), ("i", 15, 1, 4, meta(key="k"), "t"),
    ])
    assert rows(C.connection_predicate(config), "connection_id", "match_on", "match_key", "ts_col") == [
        ("a", "ean,key", "e\u001fk", "timestamp"), ("b", "ean", "e", "timestamp"), ("c", "building_uuid", "b", "timestamp"),
        ("d", "x", "1", "ts2"), ("e", "clause:x > 1", "", "timestamp"), ("f", "", "", "timestamp"),
        ("g", "", "", "timestamp"), ("h", "", "", "timestamp"), ("i", "", "", "timestamp")]


def test_select_and_counts(spark, rows):
    config = by_sk(spark, ("a", 1), ("b", 1)).withColumn("connector", F.lit("x"))
    assert C.select_connections(config, "a", "x").count() == 1
    assert C.select_connections(config, connector="x").count() == 2
    with pytest.raises(ValueError):
        C.select_connections(config)
    with pytest.raises(ValueError):
        C.require_rows(config.limit(0), "x")


def test_failure_status(spark, rows):
    config = make_config(spark, [("act", 15, 1, 4, '{"meterStatus": "active"}', "t"), ("done", 15, 1, 4, '{"meterStatus": "active"}', "t"),
                                 ("off", 15, 1, 4, '{"meterStatus": "inactive"}', "t"), ("none", 15, 1, 4, "{}", "t")])
    earlier = spark.sql(f"""SELECT 'done' AS connection_id, TIMESTAMP '2024-01-20 00:00:00 UTC' AS checked_at
                            UNION ALL SELECT 'act', TIMESTAMP '2024-01-19 23:59:59 UTC'""")
    out = status.failure_status(config, earlier, AS_OF, "r")
    assert rows(out, "connection_id", "status", "job_state") == [("act", "DELAYED", "FAILED")]
    assert [f.name for f in out.schema.fields] == [f.name for f in status.status_snapshot(
        config, source(make_facts(spark, [("x", AS_OF, 0)])), AS_OF, "r").schema.fields]
    assert status.failure_status(config, earlier, AS_OF, "r", missing_is_active=True).count() == 2


def test_newest_record_from_history(spark):
    facts = make_facts(spark, [("a", "2024-01-20 11:00:00", 0), ("b", "2024-01-03 00:00:00", 0)])
    earlier = spark.sql("""SELECT 'b' AS connection_id, TIMESTAMP '2024-01-03 00:00:00 UTC' AS last_sync_timestamp
                           UNION ALL SELECT 'b', NULL UNION ALL SELECT 'a', TIMESTAMP '2024-01-02 00:00:00 UTC'""")
    config = by_sk(spark, ("a", 30), ("b", 30), ("c", 30))
    whole = status.status_snapshot(config, source(facts), AS_OF, "r")
    short = status.status_snapshot(config, source(facts), AS_OF, "r", history=earlier, history_until="2024-01-15")
    assert sorted(whole.collect()) == sorted(short.collect())


def test_partition_folders_are_pruned(spark, tmp_path):
    path = str(tmp_path / "fact")
    facts = make_facts(spark, [("a", "2024-01-19 11:00:00", 0), ("a", "2024-01-03 00:00:00", 0)])
    facts.withColumn("event_date", F.to_date("timestamp")).write.partitionBy("event_date").parquet(path)
    stored = source(spark.read.parquet(path), date_col="event_date")
    config = by_sk(spark, ("a", 30))
    snap = status.status_snapshot(config, stored, AS_OF, "r")
    assert snap.collect() == status.status_snapshot(config, source(facts), AS_OF, "r").collect()
    plan = gaps.detect_gaps(stored, C.connection_predicate(config), AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_a_predicate_that_no_source_knows_is_an_error_and_not_offline(spark):
    facts = make_facts(spark, [("a", "2024-01-20 11:00:00", 0)])
    config = make_config(spark, [
        ("known", 30, 1, 4, '{"filter_clause": "sk = \'a\'"}', "t"),
        ("clause", 30, 1, 4, '{"filter_clause": "sk = \'a\' AND unit = \'y\'"}', "t"),
        ("column", 30, 1, 4, '{"filter_clause": "sk = \'a\'", "timestamp_col": "other"}', "t")])
    got = {r["connection_id"]: (r["status"], r["job_state"]) for r in status.status_snapshot(config, source(facts), AS_OF, "r").collect()}
    assert got == {"known": ("ACTIVE", "SUCCESS"), "clause": ("OFFLINE", "ERROR"), "column": ("OFFLINE", "ERROR")}


def test_a_table_given_twice_is_refused(spark):
    facts = make_facts(spark, [("a", "2024-01-20 11:00:00", 0)])
    with pytest.raises(ValueError, match="more than once"):
        status.status_snapshot(by_sk(spark, ("a", 30)), [source(facts), source(facts, processing_ts="x")], AS_OF, "r")


def test_numbers_are_matched_as_numbers(spark):
    facts = make_facts(spark, [("7", "2024-01-20 11:00:00", 0)]).withColumn("user_id", F.col("sk").cast("int"))
    config = make_config(spark, [("n", 30, 1, 4, '{"filter_clause": "user_id = \'007\'"}', "t")])
    r = status.status_snapshot(config, source(facts, key_sets=(("user_id",),)), AS_OF, "r").first()
    assert r["last_sync_timestamp"] is not None and r["job_state"] == "SUCCESS"


def test_an_empty_batch_is_no_refresh(spark):
    from gaugeline.streaming.health import newest
    assert newest("timestamp")(make_facts(spark, [("a", "2024-01-20 11:00:00", 0)]).limit(0)) is None


def test_totals_are_marked(spark):
    from gaugeline.operators.landing import landing_summary
    log = spark.createDataFrame([(None, "success", 2), ("a", "error", 0)], "entity string, status string, samples int")
    assert sorted((r.is_total, r.entity is None, r.fetches) for r in landing_summary(log).collect()) == [
        (False, False, 1), (False, True, 1), (True, True, 2)]


def scans(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("FileScan parquet")


def test_one_scan_per_table_for_all_ways_to_select(spark, tmp_path):
    facts = make_facts(spark, [("a", "2024-01-20 11:00:00", 0), ("b", "2024-01-19 11:00:00", 60)]).withColumns(
        {"ean": F.lit("e"), "key": F.col("sk"), "unit": F.lit("W"), "other_ts": F.col("timestamp")})
    facts.write.parquet(str(tmp_path / "t"))
    config = make_config(spark, [
        ("sk", 30, 1, 4, '{"filter_clause": "sk = \'a\'"}', "t"), ("two", 30, 1, 4, '{"filter_clause": "unit = \'W\' AND sk = \'b\'"}', "t"),
        ("ean", 30, 1, 4, '{"ean": "e"}', "t"), ("both", 30, 1, 4, '{"ean": "e", "key": "b"}', "t"), ("all", 30, 1, 4, None, "t"),
        ("free", 30, 1, 4, '{"filter_clause": "sk > \'a\'"}', "t"), ("none", 30, 1, 4, '{"filter_clause": "sk > \'z\'"}', "t")])
    sources = C.discover_sources(config, {"t": spark.read.parquet(str(tmp_path / "t"))})
    snap = status.status_snapshot(config, sources, AS_OF, "r")
    assert scans(snap) == 1 and scans(status.streaming_status(config, sources, AS_OF, "r")) == 1
    assert {r["connection_id"]: (r["last_sync_timestamp"].hour, r["data_points_24h"]) for r in snap.collect() if r["last_sync_timestamp"]} == {
        "sk": (11, None), "two": (11, 1), "ean": (11, 1), "both": (11, 1), "all": (11, 1), "free": (11, 1)}


def test_bad_clauses_and_tables_fail_alone(spark, tmp_path):
    facts = make_facts(spark, [("7", "2024-01-20 11:00:00", 0), ("x", "2024-01-20 11:30:00", 0)])
    clauses = {"good": "sk <> 'y'", "cast": "CAST(sk AS INT) = 7", "column": "nothing > 1", "syntax": "sk = (", "aggregate": "max(sk) = '7'",
               "number": "1 + 1", "window": "row_number() OVER (ORDER BY sk) = 1", "twice": "sk = '7' AND sk = 'x'", "escape": "1=1) OR (1=1"}
    import json
    config = make_config(spark, [(k, 60, 1, 4, json.dumps({"filter_clause": c}), "t") for k, c in clauses.items()]
                         + [("lost", 60, 1, 4, None, "missing"), ("broken", 60, 1, 4, None, "broken")])
    sources = C.discover_sources(config, {"t": facts, "broken": lambda: spark.read.parquet(str(tmp_path / "nothing"))})
    got = {r["connection_id"]: (r["job_state"], r["last_sync_timestamp"] and r["last_sync_timestamp"].minute)
           for r in status.status_snapshot(config, sources, AS_OF, "r").collect()}
    bad = ("ERROR", None)
    assert got == {"good": ("SUCCESS", 30), "cast": ("SUCCESS", 0), "twice": ("SUCCESS", None), "lost": ("SUCCESS", None), "broken": bad,
                   **dict.fromkeys(("column", "syntax", "aggregate", "number", "window", "escape"), bad)}


def test_two_processing_columns_of_one_table(spark):
    facts = make_facts(spark, [("c", "2024-01-19 10:00:00", 120)]).withColumn("arrived", F.col("timestamp") + F.expr("INTERVAL 7 MINUTES"))
    config = make_config(spark, [
        ("usual", 60, 1, 4, '{"filter_clause": "sk = \'c\'"}', "t"),
        ("other", 60, 1, 4, '{"filter_clause": "sk = \'c\'", "processing_timestamp_col": "arrived"}', "t"),
        ("absent", 60, 1, 4, '{"filter_clause": "sk = \'c\'", "processing_timestamp_col": "nowhere"}', "t")])
    snap = status.status_snapshot(config, C.discover_sources(config, {"t": facts}), AS_OF, "r")
    assert {r["connection_id"]: r["avg_delay_minutes"] for r in snap.collect()} == {"usual": 2.0, "other": 7.0, "absent": None}


def test_gaps_of_the_status_equal_those_of_the_operator(spark):
    times = [(f"c{k}", 1705618800 + (i * 7919 * (k + 3)) % 86400) for k in range(4) for i in range(3 + 40 * k)]
    facts = spark.createDataFrame(times, "sk string, s long").select("sk", F.timestamp_seconds("s").alias("timestamp"))
    config = by_sk(spark, ("c0", 30), ("c1", 15), ("c2", 5), ("c3", 1), ("silent", 60), ("daily", 1440))
    snap = status.status_snapshot(config, source(facts), AS_OF, "r")
    found = gaps.detect_gaps(source(facts), C.connection_predicate(config), AS_OF)
    assert sorted(map(tuple, snap.select("connection_id", F.explode("data_gaps").alias("g")).select("connection_id", "g.*").collect())) == sorted(
        map(tuple, found.select("connection_id", "gap_start", "gap_end", "gap_duration_minutes", "missing_records").collect()))
