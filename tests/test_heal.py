"""Late rows healed into a fact, and state that grows with the micro-batch."""

import os
import random

import pytest
from pyspark.sql import functions as F

from gaugeline.operators.order import counter_delta
from gaugeline.sources import tables, versions
from gaugeline.streaming import incremental
from gaugeline.streaming.heal import heal_counter_delta, publish_fact, read_fact
from gaugeline.streaming.incremental import incremental_counter_delta
from gaugeline.streaming.state import read_split

DAY = 86_400
BASE = 1_704_067_200


def readings(spark, rows):
    df = spark.createDataFrame(rows, "key string, s long, v double, note string")
    return df.select("key", F.timestamp_seconds(F.col("s") + BASE).alias("ts"), "v", "note")


def as_rows(df):
    return sorted((r[0], r[1] - BASE, r[2], r[3], r[4]) for r in df.select("key", F.unix_timestamp("ts"), "v", "note", "interval").collect())


def batch(spark, rows, gap):
    return as_rows(counter_delta(readings(spark, rows), ["key"], "ts", "v", tie_break=[("v", "asc"), ("note", "asc")], max_gap_seconds=gap))


@pytest.mark.parametrize("gap", [3600, 2 * DAY, 8 * DAY])
def test_late_rows_heal_to_the_batch_result(spark, tmp_path, gap):
    r, root = random.Random(gap), str(tmp_path / "fact")
    rows = [(f"k{r.randint(0, 4)}", t, float(r.randint(0, 9)), "n") for t in r.sample(range(0, 40 * DAY, 600), 250)]
    first, late = rows[:200], rows[200:] + [(*rows[3][:2], rows[3][2] - 1, "smaller"), (*rows[4][:2], rows[4][2] + 1, "larger"), rows[5], ("new", 5 * DAY, 1.0, "n")]
    fact = counter_delta(readings(spark, first), ["key"], "ts", "v", tie_break=[("v", "asc")], max_gap_seconds=gap)
    publish_fact(fact, root, "ts")
    before = versions.versions(spark, root)[-1]
    extra = spark.createDataFrame([(None, 1.0, "no key"), ("k1", 1.0, "no time")], "key string, v double, note string").withColumn("ts", F.lit(None).cast("timestamp"))
    days = heal_counter_delta(spark, root, readings(spark, late).unionByName(extra), ["key"], "ts", "v", tie_break=[("v", "asc")], max_gap_seconds=gap)
    assert as_rows(read_fact(spark, root)) == batch(spark, first + late, gap)
    assert days and versions.versions(spark, root)[-1] == before + 1
    assert heal_counter_delta(spark, root, readings(spark, late), ["key"], "ts", "v", tie_break=[("v", "asc")], max_gap_seconds=gap) == []
    assert versions.versions(spark, root)[-1] == before + 1


def test_only_days_in_reach_are_written(spark, tmp_path):
    root = str(tmp_path / "fact")
    rows = [("a", d * DAY + h * 3600, float(d * 24 + h), "n") for d in range(30) for h in (1, 9, 17)]
    publish_fact(counter_delta(readings(spark, rows), ["key"], "ts", "v", max_gap_seconds=DAY), root, "ts")
    days = heal_counter_delta(spark, root, readings(spark, [("a", 10 * DAY + 18 * 3600, 10 * 24 + 17.5, "late")]), ["key"], "ts", "v", max_gap_seconds=DAY)
    assert days == ["2024-01-11", "2024-01-12"]
    folders = versions._commit_of(spark, root, 2)["parts"]
    assert sum("data-0000000002" in f for f in folders.values()) == 2 and len(folders) == 30
    assert as_rows(read_fact(spark, root, "2024-01-11", "2024-01-11"))[-1] == ("a", 10 * DAY + 18 * 3600, 257.5, "late", 0.5)
    assert heal_counter_delta(spark, root, readings(spark, []), ["key"], "ts", "v") == []


def size(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet"))


def test_state_is_written_as_far_as_it_changes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "COMPACT_EVERY", 4)
    root = str(tmp_path)

    def run(rows):
        df = spark.createDataFrame(rows, "key string, s long, v double").select("key", F.timestamp_seconds(F.col("s") + BASE).alias("ts"), "v")
        df.write.mode("append").parquet(f"{root}/in")
        incremental_counter_delta(tables.stream_table(spark, f"{root}/in", df.schema), ["key"], "ts", "v", f"{root}/out", f"{root}/state", f"{root}/cp")

    every = [(f"k{k}", 0, float(k)) for k in range(3000)]
    run(every)
    steps = [[("k1", 60 * n, float(n)), ("k2", 60 * n, 5.0 + n)] for n in range(1, 10)]
    for step in steps:
        run(step)
    logs = [size(f"{root}/state/log/batch={n}") for n in range(10)]
    assert all(n * 10 < logs[0] for n in logs[1:])  # two keys against three thousand
    assert versions.about_version(spark, f"{root}/state/base") == {"upto": 7}
    newest = versions._commit_of(spark, f"{root}/state/base", 2)["parts"]
    assert 1 <= sum("data-0000000002" in f for f in newest.values()) <= 2  # the buckets of two keys
    state = incremental.read_state(spark, f"{root}/state", ["key"], 10)
    assert state.count() == 3000 and state.filter("key = 'k1'").first()["_last_value"] == 9.0
    out = read_split(spark, f"{root}/out", spark.createDataFrame([], "key string, ts timestamp, v double, interval double").schema)
    assert out.count() == 3018 and out.filter("interval = 1.0").count() == 16
    run([("k1", 60, 1.0), ("k1", 90, 1.5), ("k2", 60 * 9, None)])  # a repeat, a late reading, an empty repeat
    late = read_split(spark, f"{root}/out", out.schema, late=True)
    assert [(r["key"], r["v"]) for r in late.collect()] == [("k1", 1.5)]
