import pytest
from pyspark.sql import functions as F

from gaugeline.schemas import BUNDLE_CATEGORIES, struct
from gaugeline.sources import tables
from gaugeline.streaming.delta import stream_counter_delta
from gaugeline.streaming.incremental import incremental_counter_delta, incremental_pivot
from gaugeline.streaming.pivot import stream_pivot
from gaugeline.streaming.state import read_split, write_with_late

BASE = 1_704_067_200  # an event at the epoch itself would count as late from the start
READING = "key string, ts timestamp, v double, n int"
OUT = "key string, ts timestamp, v double, n int, interval double"


class Feed:
    """A table that grows by one file per batch, and the runs over it."""

    def __init__(self, spark, tmp_path, schema):
        self.spark, self.root, self.schema = spark, tmp_path, schema

    def add(self, data, day0=0):
        names = struct(self.schema).names
        plain = ", ".join(f"{f.name} {'double' if f.name == 'ts' else f.dataType.simpleString()}"
                          for f in struct(self.schema).fields)
        df = self.spark.createDataFrame(data, plain).withColumn("ts", F.timestamp_seconds(F.col("ts") + BASE)).select(*names)
        df.coalesce(1).write.mode("append").parquet(str(self.root / "in"))

    def stream(self, **kw):
        return tables.stream_table(self.spark, str(self.root / "in"), self.schema, **kw)

    def path(self, name):
        return str(self.root / name)

    def result(self, schema, late=False):
        return read_split(self.spark, self.path("out"), struct(schema), late)


def run_delta(feed, kind, **kw):
    if kind == "state":
        df = stream_counter_delta(feed.stream(), ["key"], "ts", "v", carry=["n"], **kw)
        write_with_late(df, feed.path("out"), feed.path("cp"))
    else:
        gap = kw.pop("max_gap", "8 days")
        incremental_counter_delta(feed.stream(), ["key"], "ts", "v", feed.path("out"), feed.path("state"), feed.path("cp"),
                                  max_gap_seconds=int(gap.split()[0]) * 86400, **kw)


def seconds(df):
    return [(int(r[0]) - BASE, r[1]) for r in df.select(F.unix_timestamp("ts"), "interval").orderBy("ts").collect()]


@pytest.mark.parametrize("kind", ["state", "set"])
def test_delta_with_a_late_row(spark, tmp_path, kind):
    feed = Feed(spark, tmp_path, READING)
    feed.add([("k", 60.0, 14.0, 1), ("k", 0.0, 10.0, 2)])
    run_delta(feed, kind)
    feed.add([("k", 30.0, 12.0, 3), ("k", 90.0, 15.0, 4)])
    run_delta(feed, kind)
    run_delta(feed, kind)
    assert seconds(feed.result(OUT)) == [(0, None), (60, 4.0), (90, 1.0)]
    assert seconds(feed.result(OUT, late=True)) == [(30, None)]


@pytest.mark.parametrize("kind", ["state", "set"])
def test_delta_repeats_resets_and_nulls(spark, tmp_path, kind):
    feed = Feed(spark, tmp_path, READING)
    feed.add([("k", 0.0, 10.0, 1), ("k", 30.0, 12.0, 2), ("k", 30.0, 12.0, 3), ("k", 60.0, 11.0, 4), ("k", 90.0, None, 5)])
    run_delta(feed, kind)
    feed.add([("k", 120.0, 13.0, 6), ("k", 150.0, 14.0, 7), ("j", 5.0, 1.0, 8)])
    run_delta(feed, kind)
    out = feed.result(OUT)
    assert seconds(out.filter("key = 'k'")) == [(0, None), (30, 2.0), (60, None), (90, None), (120, None), (150, 1.0)]
    assert seconds(out.filter("key = 'j'")) == [(5, None)]


@pytest.mark.parametrize("kind", ["state", "set"])
def test_delta_takes_the_best_of_repeats(spark, tmp_path, kind):
    feed = Feed(spark, tmp_path, READING)
    feed.add([("k", 0.0, 1.0, 1), ("k", 0.0, 5.0, 2), ("k", 30.0, 6.0, 1)])
    run_delta(feed, kind, tie_break=[("n", "desc")])
    assert seconds(feed.result(OUT)) == [(0, None), (30, 1.0)]


@pytest.mark.parametrize("kind", ["state", "set"])
def test_delta_over_a_long_silence(spark, tmp_path, kind):
    feed = Feed(spark, tmp_path, READING)
    day = 86400.0
    feed.add([("k", 0.0, 1.0, 1), ("other", 0.0, 1.0, 1)])
    run_delta(feed, kind)
    feed.add([("k", 20 * day, 5.0, 2), ("other", 5 * day, 3.0, 2)])
    run_delta(feed, kind)
    feed.add([("k", 40 * day, 9.0, 3)])  # moves the watermark past the timer of "other"
    run_delta(feed, kind)
    feed.add([("other", 41 * day, 9.0, 3), ("k", 41 * day, 10.0, 4)])
    run_delta(feed, kind)
    out = feed.result(OUT)
    assert [v for _, v in seconds(out.filter("key = 'k'"))] == [None, None, None, 1.0]
    assert [v for _, v in seconds(out.filter("key = 'other'"))] == [None, 2.0, None]


def test_delta_orders_a_key_that_comes_in_several_chunks(spark, tmp_path):
    feed = Feed(spark, tmp_path, READING)
    feed.add([("k", float(s), float(s), 1) for s in range(50, 0, -1)])
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        run_delta(feed, "state")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert seconds(feed.result(OUT)) == [(1, None), *[(s, 1.0) for s in range(2, 51)]]


@pytest.mark.parametrize("kind", ["state", "set"])
def test_many_small_batches_equal_one(spark, tmp_path, kind, rows):
    """A reset-free series in order: intervals add up to last less first, whatever the batches."""
    feed = Feed(spark, tmp_path, READING)
    for b in range(3):
        feed.add([(f"k{k}", float(100 * b + s), float((100 * b + s) * (k + 1)), 1) for k in range(5) for s in range(0, 100, 9)])
        run_delta(feed, kind)
    total = feed.result(OUT).groupBy("key").agg(F.sum("interval"), F.max("v") - F.min("v"))
    assert all(a == b for _, a, b in total.collect()) and total.count() == 5
    assert feed.result(OUT, late=True).count() == 0


LONG = "asset int, ts timestamp, cat int, v double, n int, drift string"
WIDE = "asset int, ts timestamp, energy_production double, energy_export double, energy_import double, drift string"


def run_pivot(feed, kind):
    if kind == "state":
        wide = stream_pivot(feed.stream(), ["asset"], "ts", "cat", "v", BUNDLE_CATEGORIES, tie_break=[("n", "asc")], drift="drift")
        write_with_late(wide, feed.path("out"), feed.path("cp"))
    else:
        incremental_pivot(feed.stream(), ["asset"], "ts", "cat", "v", BUNDLE_CATEGORIES, ["n"], feed.path("out"),
                          feed.path("state"), feed.path("cp"), drift="drift")


@pytest.mark.parametrize("kind", ["state", "set"])
def test_pivot(spark, tmp_path, kind, rows):
    feed = Feed(spark, tmp_path, LONG)
    feed.add([(1, 0.0, 10, None, 1, None), (1, 0.0, 26, 5.0, 2, None), (1, 0.0, 26, 6.0, 3, "d"), (1, 3600.0, 10, None, 1, "x"),
              (1, 7200.0, 10, 1.0, 1, None), (1, 7200.0, 99, 8.0, 1, "y"), (2, 0.0, 10, None, 1, None)])
    run_pivot(feed, kind)
    feed.add([(1, 7200.0, 27, 4.0, 5, None), (1, 10800.0, 27, 7.0, 6, None), (2, 0.0, 27, 3.0, 7, None)])
    run_pivot(feed, kind)
    cols = ["asset", F.unix_timestamp("ts") - BASE, "energy_production", "energy_export", "energy_import", "drift"]
    assert rows(feed.result(WIDE), *cols) == [
        (1, 0, None, 5.0, None, "d"), (1, 10800, None, None, 7.0, None), (1, 7200, 1.0, None, None, None),
        (2, 0, None, None, 3.0, None)]
    assert rows(feed.result(WIDE, late=True), *cols) == [(1, 7200, None, None, 4.0, None)]


def test_bounded_micro_batches(spark, tmp_path):
    feed = Feed(spark, tmp_path, READING)
    for i in range(3):
        feed.add([("k", float(i), 1.0, 1)])
    df = feed.stream(max_files_per_trigger=1).withColumn("is_late", F.lit(False))
    write_with_late(df, feed.path("out"), feed.path("cp"))
    stored = spark.read.parquet(feed.path("out"))
    assert stored.select("batch").distinct().count() == 3


def test_incremental_recovers_from_an_empty_state(spark, tmp_path):
    feed = Feed(spark, tmp_path, READING)
    feed.add([("k", None, 9.0, 1)])
    run_delta(feed, "set")
    for n, (s, v) in enumerate([(0.0, 10.0), (30.0, 12.0), (60.0, 15.0)]):
        feed.add([("k", s, v, n)])
        run_delta(feed, "set")
    assert seconds(feed.result(OUT)) == [(0, None), (30, 2.0), (60, 3.0)]


def test_incremental_keeps_no_repeats_of_accepted_rows(spark, tmp_path):
    feed = Feed(spark, tmp_path, READING)
    feed.add([("k", 0.0, 10.0, 1), ("k", 60.0, 14.0, 2)])
    run_delta(feed, "set")
    feed.add([("k", 0.0, 10.0, 1), ("k", 30.0, 12.0, 3), ("k", 60.0, 14.0, 2), ("k", 90.0, 15.0, 4)])
    run_delta(feed, "set")
    assert seconds(feed.result(OUT)) == [(0, None), (60, 4.0), (90, 1.0)]
    assert seconds(feed.result(OUT, late=True)) == [(30, None)]
