"""Interval joins and planned downtime against plain loops."""

import random

from pyspark.sql import functions as F

from gaugeline.operators import windows

MIN = 60


def gap_table(spark, rows):
    return spark.createDataFrame(rows, "connection_id string, a long, b long, expected_interval_minutes int").select(
        "connection_id", F.timestamp_seconds("a").alias("gap_start"), F.timestamp_seconds("b").alias("gap_end"), "expected_interval_minutes", F.lit("x").alias("note"))


def pause_table(spark, rows):
    return spark.createDataFrame(rows, "connection_id string, a long, b long").select(
        "connection_id", F.timestamp_seconds("a").alias("pause_start"), F.timestamp_seconds("b").alias("pause_end"))


def plain(gaps, pauses, factor=1.5):
    out = []
    for key, a, b, iv in gaps:
        cut = sorted((s, e) for k, s, e in pauses if k == key and s is not None and e is not None and s < e and s < b and e > a)
        at = a
        pieces = []
        for s, e in cut:
            pieces.append((at, s))
            at = max(at, e)
        pieces.append((at, b))
        for s, e in pieces:
            if (e - s) / 60 > iv * factor:
                out.append((key, s, e, round((e - s) / 60), max(0, round((e - s) / 60 / iv) - 1)))
    return sorted(out)


def told(df):
    return sorted(tuple(r) for r in df.select("connection_id", F.unix_timestamp("gap_start"), F.unix_timestamp("gap_end"), "gap_duration_minutes", "missing_records").collect())


def test_gaps_are_shortened_split_or_removed(spark):
    gaps = [("c", 0, 600 * MIN, 10), ("d", 0, 600 * MIN, 10), ("e", 0, 60 * MIN, 10), ("f", 0, 100 * MIN, 10), (None, 0, 100 * MIN, 10)]
    pauses = [("c", 100 * MIN, 200 * MIN), ("c", 150 * MIN, 180 * MIN), ("c", 200 * MIN, 250 * MIN), ("c", 300 * MIN, 310 * MIN),  # nested, touching, apart
              ("d", -50, 590 * MIN), ("e", -1, 61 * MIN), ("f", 100 * MIN, 200 * MIN), ("f", -10 * MIN, 0), ("f", 50 * MIN, 50 * MIN), ("f", 70 * MIN, 60 * MIN),
              ("f", None, 90 * MIN), ("c", 250 * MIN, None), (None, 0, 100 * MIN)]
    got = windows.masked_gaps(gap_table(spark, gaps), pause_table(spark, pauses))
    assert told(got.filter("connection_id IS NOT NULL")) == plain([g for g in gaps if g[0]], pauses) == [
        ("c", 0, 6000, 100, 9), ("c", 15000, 18000, 50, 4), ("c", 18600, 36000, 290, 28), ("f", 0, 6000, 100, 9)]
    assert got.columns == ["connection_id", "expected_interval_minutes", "note", "gap_start", "gap_end", "gap_duration_minutes", "missing_records"]
    assert got.filter("connection_id IS NULL").count() == 1  # a gap of no connection keeps its length
    assert windows.masked_gaps(gap_table(spark, []), pause_table(spark, pauses)).count() == 0
    assert told(windows.masked_gaps(gap_table(spark, gaps[:1]), pause_table(spark, []))) == plain(gaps[:1], [])


def test_any_bins_give_the_same(spark):
    r = random.Random(5)
    gaps = [(f"k{r.randint(0, 3)}", s := r.randint(-500, 5000) * 30, s + r.randint(1, 900) * 30, r.choice([1, 7, 15])) for _ in range(60)]
    pauses = [(f"k{r.randint(0, 4)}", s := r.randint(-500, 6000) * 30, s + r.randint(-5, 300) * 30) for _ in range(120)]
    gaps = list(dict.fromkeys(gaps))
    want = plain(gaps, pauses)
    for seconds in (60, 3600, 10**7):
        assert told(windows.masked_gaps(gap_table(spark, gaps), pause_table(spark, pauses), bin_seconds=seconds)) == want


def test_overlaps_meet_once(spark):
    left = spark.createDataFrame([("k", 0, 100), ("k", 100, 101), ("j", 0, 9)], "key string, a long, b long").select("key", F.timestamp_seconds("a").alias("a"), F.timestamp_seconds("b").alias("b"))
    right = spark.createDataFrame([("k", 50, 100), ("k", 99, 200), ("k", 100, 100)], "key string, c long, d long").select("key", F.timestamp_seconds("c").alias("c"), F.timestamp_seconds("d").alias("d"))
    for seconds in (1, 30, 1000):
        pairs = windows.overlaps(left, right, "key", ("a", "b"), ("c", "d"), seconds)
        assert sorted(tuple(r) for r in pairs.select(F.unix_timestamp("a"), F.unix_timestamp("c")).collect()) == [(0, 50), (0, 99), (100, 99)]


def test_pause_days_in_a_time_zone(spark):
    days = spark.sql("""SELECT 'j' AS job_name, DATE '2024-03-31' AS pause_start_date, DATE '2024-03-31' AS pause_end_date, true AS is_active
                        UNION ALL SELECT 'j', DATE '2024-01-01', DATE '2024-01-02', false UNION ALL SELECT 'j', DATE '2024-01-03', DATE '2024-01-02', true""")
    row = windows.pause_intervals(days, zone="Europe/Amsterdam").select(F.col("pause_start").cast("string"), F.col("pause_end").cast("string")).collect()
    assert [tuple(r) for r in row] == [("2024-03-30 23:00:00", "2024-03-31 22:00:00")]


def test_listing_is_pruned_and_spread(spark, tmp_path):
    from gaugeline.sources import envelopes

    for entity in ("a", "entity=b c", "c"):
        for kind in ("data", "metadata"):
            for day in ("20240101", "20240102"):
                folder = tmp_path / entity / (f"kind={kind}" if "=" in entity else kind) / (f"day={day}" if "=" in entity else day)
                folder.mkdir(parents=True)
                (folder / "f.json").write_text('{"n": 1}')
                (folder / "_hidden").write_text("x")
    (tmp_path / "c" / "data" / "20240101" / "f.json").chmod(0o644)
    root = str(tmp_path)
    assert envelopes.list_landed(spark, root).count() == 12
    some = envelopes.list_landed(spark, root, F.col("entity") != "a", F.col("kind") == "data", F.col("day") > "20240101")
    assert sorted(tuple(r) for r in some.select("entity", "kind", "day", "bytes").collect()) == [("b c", "data", "20240102", 8), ("c", "data", "20240102", 8)]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert plan.index("FlatMap" if "FlatMap" in plan else "MapInArrow") < plan.index("20240101")  # the filter lies below the listing
    rows = envelopes.scan_landed(spark, root, "n int", F.col("entity") != "a", F.col("kind") == "data")
    assert sorted(tuple(r) for r in rows.collect()) == [(1, e, "data", d) for e in ("b c", "c") for d in ("20240101", "20240102")]
    assert envelopes.scan_landed(spark, root, "n int", F.col("entity") == "none").count() == 0
    assert envelopes.list_landed(spark, f"{root}/nowhere").count() == 0
