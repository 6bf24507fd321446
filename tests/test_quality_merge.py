import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from gaugeline.operators import quality, retention, windows
from gaugeline.operators.quality import Rule
from gaugeline.plans import rules
from gaugeline.sources import merge


@pytest.fixture
def numbers(spark):
    return spark.createDataFrame([(1, 5.0), (2, -1.0), (3, None)], "id int, v double")


POSITIVE = Rule("positive", "v > 0")


def test_null_counts_as_broken(numbers, rows):
    assert rows(quality.quality_report(numbers, [POSITIVE])) == [("positive", "warn", 1, 2)]
    assert rows(quality.expect_drop(numbers, [POSITIVE]), "id") == [(1,)]
    assert rows(quality.quarantine(numbers, [POSITIVE, Rule("known", "v IS NOT NULL")]), "id", "failed_rules") == [
        (2, ["positive"]), (3, ["positive", "known"])]


def test_warn_counts_in_the_same_job(numbers):
    seen = Observation("seen")
    assert quality.expect_warn(numbers, [POSITIVE], seen).count() == 3
    assert seen.get == {"positive": 2}


def test_fail_stops_the_job(numbers):
    with pytest.raises(Exception, match="positive"):
        quality.expect_fail(numbers, [POSITIVE]).collect()
    assert quality.expect_fail(numbers, [Rule("id", "id > 0")]).count() == 3


def test_unique(numbers):
    quality.assert_unique(numbers, ["id"])
    with pytest.raises(ValueError):
        quality.assert_unique(numbers.withColumn("one", F.lit(1)), ["one"])


def test_all_published_rules_are_there():
    sets = [rules.SENSOR_SILVER, rules.SENSOR_SNAPSHOT_BRONZE, rules.SENSOR_FACT, rules.DIMENSION, rules.METER_SILVER,
            rules.ASSET_SNAPSHOT_BRONZE, rules.GRID_FACT, rules.PRODUCTION_FACT]
    # The dimension rules stand for three tables.
    assert sum(map(len, sets)) + 2 * len(rules.DIMENSION) == 41


def test_upsert_keeps_created_and_is_idempotent(spark, rows):
    target = spark.createDataFrame([(1, "a", "t0"), (9, "z", "t0")], "k int, v string, created string")
    source = spark.createDataFrame([(1, "b", "t1"), (2, "c", "t1")], "k int, v string, created string")
    want = [(1, "b", "t0"), (2, "c", "t1"), (9, "z", "t0")]
    once = merge.upsert(target, source, ["k"], ["v"], ["created"])
    assert rows(once) == want
    assert rows(merge.upsert(once, source, ["k"], ["v"], ["created"])) == want


def test_upsert_defaults_and_ambiguous_source(spark, rows):
    target = spark.createDataFrame([("a", 1, 7)], "k string, days int, files int")
    source = spark.createDataFrame([("a", 2), ("b", 3)], "k string, days int")
    assert rows(merge.upsert(target, source, ["k"], ["days"], insert_defaults={"files": 0})) == [("a", 2, 7), ("b", 3, 0)]
    with pytest.raises(Exception, match="more than one source row"):
        merge.upsert(target, source.union(source), ["k"], ["days"]).collect()


def test_update_from_touches_matches_only(spark, rows):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    updates = spark.createDataFrame([("a", None), ("x", 5)], "k string, n int")
    assert rows(merge.update_from(target, updates, ["k"], ["n"])) == [("a", None), ("b", 2)]


def test_retention(spark, rows):
    listing = spark.createDataFrame(
        [("/v/a/x.json", "2024-01-01", 10, "a"), ("/v/a/y.d/z", "2024-01-02", 5, "a"), ("/v/a/n.csv", "2024-01-20", 1, "a"),
         ("/v/b/k.json", "2024-01-20", 1, "b")], "path string, day string, bytes long, volume_name string",
    ).withColumn("modified_at", F.to_timestamp("day"))
    volumes = spark.createDataFrame([("a", "s", "c", 15), ("b", "m", "c", 15)],
                                    "volume_name string, connector_name string, client_catalog string, retention_days int")
    expired = retention.expired_files(listing, volumes, "2024-01-21")
    results = retention.cleanup_results(volumes, retention.retention_summary(expired, ["volume_name"]), ["volume_name"])
    assert rows(results, "volume_name", "files_deleted", "bytes_deleted", "oldest_file", "file_types") == [
        ("a", 2, 15, "/v/a/x.json", "json,no_extension"), ("b", 0, 0, None, "none")]
    assert rows(retention.cleanup_totals(results), "connector_name", "files_deleted", "bytes_deleted") == [
        (None, 2, 15), ("m", 0, 0), ("s", 2, 15)]
    audit = retention.audit_rows(results, "2024-01-21")
    log = merge.append_audit(audit.drop("status").limit(0), audit)
    assert rows(log, "volume_path", "files_deleted", "data_type") == [("/Volumes/c/land/a", 2, "json,no_extension")]


def test_cutoff_is_strict(spark):
    listing = spark.sql("SELECT '/a' AS path, TIMESTAMP '2024-01-06 00:00:00 UTC' AS modified_at, 1L AS bytes, 'a' AS volume_name")
    volumes = spark.createDataFrame([("a", 15)], "volume_name string, retention_days int")
    assert retention.expired_files(listing, volumes, "2024-01-21").count() == 0
    assert retention.expired_files(listing, volumes, "2024-01-21 00:00:01").count() == 1


def test_first_pattern_wins(spark, rows):
    df = spark.createDataFrame([("alpha_dev",), ("alpha_x",), ("beta",)], "path string")
    out = retention.assign_source(df, [("d", "glob", "*_dev"), ("a", "prefix", "alpha"), ("q", "glob", "?eta")])
    assert rows(out) == [("alpha_dev", "d"), ("alpha_x", "a"), ("beta", "q")]


def test_slots(spark, rows):
    df = spark.createDataFrame([("e",)], "entity string")
    slots = windows.expected_slots(df, "2024-01-01", "2024-01-02")
    assert rows(slots, F.col("slot_start").cast("string"), F.col("slot_end").cast("string"), "slot_index") == [
        ("2024-01-01 00:00:00", "2024-01-01 07:59:59", 0), ("2024-01-01 08:00:00", "2024-01-01 15:59:59", 1),
        ("2024-01-01 16:00:00", "2024-01-01 23:59:59", 2)]
    landed = slots.filter("slot_index = 1").select("entity", "slot_day", "slot_index")
    assert windows.landing_backlog(slots, landed, ["entity", "slot_day", "slot_index"]).count() == 2


def test_pause_windows_are_inclusive(spark):
    df = spark.sql("""SELECT 'j' AS job_name, DATE '2024-01-01' AS pause_start_date, DATE '2024-01-03' AS pause_end_date,
                      TRUE AS is_active UNION ALL SELECT 'j', DATE '2024-01-01', DATE '2024-01-09', FALSE""")
    for day, n in (("2023-12-31", 0), ("2024-01-01", 1), ("2024-01-03 23:00:00", 1), ("2024-01-04", 0)):
        assert windows.active_windows(df, day, "j").count() == n
    assert windows.active_windows(df, "2024-01-02").count() == 1
