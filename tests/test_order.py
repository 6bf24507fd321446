import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from gaugeline.operators.order import counter_delta, lag_columns, latest_inventory, latest_per_snapshot

READINGS = [(0, 10.0), (30, 12.0), (30, 12.0), (60, 11.0), (90, None), (120, 13.0), (150, 14.0)]


def readings(spark, data=READINGS):
    return spark.createDataFrame([("g", i, s, v) for i, (s, v) in enumerate(data)],
                                 "key string, n int, s long, v double").withColumn("ts", F.timestamp_seconds("s"))


def intervals(df):
    return [r["interval"] for r in df.orderBy("s").collect()]


def test_counter_delta_nulls_break_the_chain(spark):
    df = counter_delta(readings(spark), ["key"], "ts", "v", tie_break=[("n", "asc")])
    assert intervals(df) == [None, 2.0, None, None, None, 1.0]


def test_counter_delta_carries_over_nulls(spark):
    df = counter_delta(readings(spark), ["key"], "ts", "v", tie_break=[("n", "asc")], carry_over_nulls=True)
    assert intervals(df) == [None, 2.0, None, None, 2.0, 1.0]


def test_counter_delta_heals_with_backfill(spark):
    df = counter_delta(readings(spark, [(0, 10.0), (60, 14.0), (30, 12.0), (90, 15.0)]), ["key"], "ts", "v")
    assert intervals(df) == [None, 2.0, 2.0, 1.0]


def test_counter_delta_max_gap(spark):
    df = readings(spark, [(0, 15.0), (20 * 86400, 20.0)])
    assert intervals(counter_delta(df, ["key"], "ts", "v", max_gap_seconds=8 * 86400)) == [None, None]
    assert intervals(counter_delta(df, ["key"], "ts", "v")) == [None, 5.0]


def test_sum_of_intervals_is_last_less_first(spark):
    df = readings(spark, [(i * 700, float(i * i)) for i in range(200)])
    total = counter_delta(df, ["key"], "ts", "v").agg(F.sum("interval")).first()[0]
    assert total == 199.0 ** 2


def test_sliced_lag_equals_plain_lag_with_a_hot_key(spark):
    rnd = random.Random(5)
    data = []
    for key, n in (("hot", 3000), *((f"k{i}", rnd.randint(1, 40)) for i in range(50))):
        seconds = rnd.sample(range(4_000_000), n)
        data += [(key, s, rnd.choice([None, float(rnd.randint(0, 99))])) for s in seconds]
    df = spark.createDataFrame(data, "key string, s long, v double").withColumn("ts", F.timestamp_seconds("s"))
    w = Window.partitionBy("key").orderBy("ts")
    plain = df.withColumns({"pv": F.lag("v").over(w), "pts": F.lag("ts").over(w)})
    for width in (60, 3600, 10_000_000):
        sliced = lag_columns(df, ["key"], "ts", {"v": "pv", "ts": "pts"}, slice_seconds=width)
        assert sliced.select(plain.columns).exceptAll(plain).count() == 0
        assert sliced.count() == df.count()


def test_one_full_shuffle_and_no_broadcast_of_keys(spark):
    data = spark.createDataFrame([("a", 1, 0, 5.0), ("a", 2, 7200, 6.0)], "key string, n int, s long, v double")
    df = counter_delta(data.withColumn("ts", F.timestamp_seconds("s")), ["key"], "ts", "v", tie_break=[("n", "asc")])
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and final.count("REPARTITION_BY_COL") == 2


def test_width_of_slices_changes_nothing(spark):
    df = readings(spark, [(i * 50, None if i % 7 == 0 else float(i % 31)) for i in range(500)])
    for carry in (False, True):
        want = intervals(counter_delta(df, ["key"], "ts", "v", carry_over_nulls=carry, slice_seconds=10**9))
        for width in (1, 60, 600):
            got = counter_delta(df, ["key"], "ts", "v", carry_over_nulls=carry, slice_seconds=width)
            assert intervals(got) == want


def test_reading_without_a_time_changes_no_other(spark):
    df = spark.createDataFrame([("a", None, 5.0), ("a", 0, 10.0), ("a", 7200, 12.0)], "key string, s long, v double")
    df = df.withColumn("ts", F.timestamp_seconds("s"))
    for width in (60, 3600, 10**9):
        got = {r.s: r.interval for r in counter_delta(df, ["key"], "ts", "v", slice_seconds=width).collect()}
        assert got == {None: None, 0: None, 7200: 2.0}


def test_a_dense_hour_of_one_key_spreads(spark):
    """All rows of the hot key lie within a minute; no slice holds much more than its share."""
    from gaugeline.operators.order import _slices

    rows = [("hot", 1_000_000 + i * 3) for i in range(20_000)] + [(f"k{i}", i * 2_000_000_000 + 5) for i in range(200)]
    df = spark.createDataFrame(rows, "key string, us long").select("key", F.timestamp_micros("us").alias("ts"), F.col("us").cast("double").alias("v"))
    for slices in (1, 2, 7, 64, 300):
        sizes = [r["count"] for r in _slices(df, ["key"], "ts", None, slices).groupBy("key", "_slice").count().collect()]
        assert sum(sizes) == len(rows) and max(sizes) <= 1.3 * len(rows) / slices + 5
        w = Window.partitionBy("key").orderBy("ts")
        plain = df.withColumn("pv", F.lag("v").over(w))
        sliced = lag_columns(df, ["key"], "ts", {"v": "pv"}, slices=slices)
        assert sliced.select(plain.columns).exceptAll(plain).count() == 0 and sliced.count() == len(rows)
    empty = df.filter("key = 'none'")
    assert lag_columns(empty, ["key"], "ts", {"v": "pv"}).count() == 0
    assert lag_columns(empty.unionByName(df.limit(1).withColumn("ts", F.lit(None).cast("timestamp"))), ["key"], "ts", {"v": "pv"}).count() == 1


def test_latest_keeps_one_row_before_the_shuffle(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, 1, "old"), ("a", 1, 2, "new"), ("a", 2, 1, "x"), ("b", 1, 1, "y")],
        "k string, day int, ingested int, v string")
    latest = latest_per_snapshot(df, ["k", "day"], [("ingested", "desc")])
    assert rows(latest, "k", "day", "v") == [("a", 1, "new"), ("a", 2, "x"), ("b", 1, "y")]
    assert rows(latest_inventory(latest, ["k"], [("day", "desc")]), "k", "v") == [("a", "x"), ("b", "y")]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan
