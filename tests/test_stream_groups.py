"""Streams whose keys are worked on in groups."""

import pytest
from pyspark.sql import functions as F

from gaugeline.streaming.delta import stream_counter_delta
from gaugeline.streaming.state import read_split, write_with_late

BASE = 1_704_067_200
DAY = 86_400.0
READING = "key bigint, part string, ts timestamp, v double, n bigint"
OUT = READING + ", interval double"
KEYS = ["key", "part"]


class Feed:
    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)

    def add(self, data):
        df = self.spark.createDataFrame(data, READING.replace("ts timestamp", "ts double"))
        df.withColumn("ts", F.timestamp_seconds(F.col("ts") + BASE)).coalesce(1).write.mode("append").parquet(f"{self.root}/in")

    def deltas(self, **kw):
        return stream_counter_delta(self.spark.readStream.schema(READING).parquet(f"{self.root}/in"), KEYS, "ts", "v", carry=["n"], **kw)

    def run(self, **kw):
        write_with_late(self.deltas(**kw), f"{self.root}/out", f"{self.root}/cp")

    def rows(self, late=False):
        found = read_split(self.spark, f"{self.root}/out", self.deltas().schema, late).withColumn("ts", F.col("ts").cast("double") - BASE)
        return sorted((tuple(r) for r in found.collect()), key=str)


def test_calls_do_not_grow_with_the_keys(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.add([(k, "a", float(s), float(s * k), s) for k in range(200) for s in (0, 5, 9)])
    query = (feed.deltas(buckets=4).writeStream.format("noop").outputMode("append").option("checkpointLocation", f"{tmp_path}/cp")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]) <= 4


@pytest.mark.parametrize("buckets", [1, 3, 1024])
def test_groups_change_nothing(spark, tmp_path, buckets):
    feed, far = Feed(spark, tmp_path), 2**60 + 1
    keys = [(1, "1"), (11, ""), (None, "x"), (None, None), (2, "-"), (2, None)]
    feed.add([(k, p, t, v, n) for k, p in keys for t, v, n in ((60.0, 14.0, far), (0.0, 10.0, None), (30.0, None, 2))])
    feed.run(buckets=buckets)
    feed.add([(k, p, t, v, n) for k, p in keys[:4] for t, v, n in ((30.0, 12.0, 3), (90.0, 15.0, far))])
    feed.run(buckets=buckets)
    assert feed.rows() == sorted([(k, p, t, v, n, i) for k, p in keys for t, v, n, i in (
        (0.0, 10.0, None, None), (30.0, None, 2, None), (60.0, 14.0, far, None), (90.0, 15.0, far, 1.0)) if t < 90 or (k, p) in keys[:4]], key=str)
    assert feed.rows(late=True) == sorted([(k, p, 30.0, 12.0, 3, None) for k, p in keys[:4]], key=str)


@pytest.mark.parametrize("buckets", [1, 1024])
def test_keys_of_a_group_expire_on_their_own(spark, tmp_path, buckets):
    """Without a largest gap only the expiry of its state gives a key no interval."""
    feed, kw = Feed(spark, tmp_path), {"buckets": buckets, "max_gap": None}
    for batch in ([(1, "a", 0.0, 1.0, 1), (2, "a", 15 * DAY, 1.0, 1)], [(2, "a", 20 * DAY, 2.0, 2)], [(1, "a", 21 * DAY, 5.0, 3), (2, "a", 22 * DAY, 4.0, 3)]):
        feed.add(batch)
        feed.run(**kw)
    assert [r[-1] for r in feed.rows() if r[0] == 1] == [None, None]
    assert sorted(str(r[-1]) for r in feed.rows() if r[0] == 2) == ["1.0", "2.0", "None"]


@pytest.mark.parametrize("direction, kept", [("asc", 1.0), ("desc", 5.0)])
def test_missing_ranks_come_last(spark, tmp_path, direction, kept):
    feed = Feed(spark, tmp_path)
    feed.add([(1, "a", 0.0, 9.0, None), (1, "a", 0.0, 1.0, -3), (1, "a", 0.0, 5.0, 4)])
    feed.run(tie_break=[("n", direction)])
    assert [r[3] for r in feed.rows()] == [kept]
