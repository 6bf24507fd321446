"""Health refreshes from state against the status of the whole table."""

import os
from datetime import timedelta

from pyspark.sql import functions as F

from gaugeline.functions.time import utc
from gaugeline.operators import config as C
from gaugeline.operators import status
from gaugeline.sources import tables
from gaugeline.streaming.last_seen import forget, stream_health_from_state
from tests.test_health import make_config

SCHEMA = "sk string, unit string, timestamp timestamp, gold_processing_timestamp timestamp, ingestionTimestamp timestamp, v double"


def connections(spark, extra=()):
    clauses = {"a": "sk = 'a'", "b": "sk = 'b'", "silent": "sk = 'z'", "watt": "unit = 'W'", "free": "sk < 'b' OR v > 5", **dict(extra)}
    return make_config(spark, [(k, 30, 1, 4, '{"filter_clause": "%s"}' % c, "t") for k, c in clauses.items()]
                       + [("all", 60, 1, 4, None, "t"), ("other", 60, 1, 4, None, "u"), ("bad", 30, 1, 4, '{"filter_clause": "w = 1 OR 1"}', "t")])


def facts(spark, rows):
    """(sk, unit, minute, delay in seconds, v)"""
    at = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("m") * 60)
    return spark.createDataFrame(rows, "sk string, unit string, m double, d int, v double").select(
        "sk", "unit", at.alias("timestamp"), (at + F.make_dt_interval(secs=F.col("d"))).alias("gold_processing_timestamp"),
        (at + F.expr("INTERVAL 30 SECONDS")).alias("ingestionTimestamp"), "v")


BATCHES = [
    [("a", "W", 10.0 * i, 60, float(i)) for i in range(40)],
    [("a", "W", 400.0, 60, None), ("a", "W", 400.0, 90, 1.0), ("a", "W", 390.0, 700, 1.0), ("b", "V", 410.0, 60, 9.0)],  # a time again, one that comes late
    [("b", "V", 1900.0, 60, 2.0), ("a", "V", 300.0, 100_000, 6.0)],
    [("c", "W", 4000.0, 60, 2.0)],
]


def run(spark, root, config, **kw):
    stream_health_from_state(
        tables.stream_table(spark, f"{root}/facts", SCHEMA), config, "t", f"{root}/status", f"{root}/state", f"{root}/checkpoint",
        every=None, critical_cols=["v"], **kw).awaitTermination()


def records(df):
    return sorted(tuple(r) for r in df.drop("job_run_id", "batch").collect())


def test_every_refresh_equals_the_status_of_all_facts(spark, tmp_path):
    root, seen = str(tmp_path), []
    for n, batch in enumerate(BATCHES):
        seen += batch
        facts(spark, batch).write.mode("append").parquet(f"{root}/facts")
        run(spark, root, lambda: connections(spark))
        whole = facts(spark, seen)
        newest = whole.agg(F.unix_micros(F.max("gold_processing_timestamp"))).first()[0]
        now = utc("1970-01-01") + timedelta(microseconds=newest + 1_000_000)
        config = connections(spark)
        want = status.streaming_status(config, C.discover_sources(config, {"t": whole}), now, "r", ["v"])
        got = tables.read_history(spark, f"{root}/status").filter(F.col("batch") == n)
        assert records(got) == records(want.select(*[c for c in got.columns if c != "batch"]))
    os.rename(f"{root}/facts", f"{root}/gone")  # the state alone is enough
    assert forget(spark, f"{root}/state") == [0, 1]


def test_a_repeated_micro_batch_changes_nothing_and_an_empty_one_is_no_refresh(spark, tmp_path):
    root = str(tmp_path)
    facts(spark, BATCHES[0]).write.mode("append").parquet(f"{root}/facts")
    run(spark, root, lambda: connections(spark))
    facts(spark, BATCHES[1]).write.mode("append").parquet(f"{root}/facts")
    run(spark, root, lambda: connections(spark))
    before = records(tables.read_history(spark, f"{root}/status"))
    os.remove(f"{root}/checkpoint/commits/1")  # as after a failure before the commit
    crc = f"{root}/checkpoint/commits/.1.crc"
    os.path.exists(crc) and os.remove(crc)
    run(spark, root, lambda: connections(spark))
    assert records(tables.read_history(spark, f"{root}/status")) == before
    facts(spark, BATCHES[0]).withColumn("gold_processing_timestamp", F.lit(None).cast("timestamp")).write.mode("append").parquet(f"{root}/facts")
    run(spark, root, lambda: connections(spark))
    after = tables.read_history(spark, f"{root}/status")
    assert records(after.filter("batch = 2")) == records(after.filter("batch = 1"))


def test_a_new_way_to_select_finds_its_newest_record_in_the_whole_table(spark, tmp_path):
    root = str(tmp_path)
    facts(spark, BATCHES[0] + BATCHES[1]).write.mode("append").parquet(f"{root}/facts")
    run(spark, root, lambda: connections(spark))
    facts(spark, [("a", "W", 420.0, 60, 1.0)]).write.mode("append").parquet(f"{root}/facts")
    more = {"pair": "sk = 'b' AND unit = 'V'", "big": "v >= 9"}
    run(spark, root, lambda: connections(spark, more), whole=lambda: spark.read.schema(SCHEMA).parquet(f"{root}/facts"))
    got = {r["connection_id"]: r["last_sync_timestamp"] for r in tables.read_history(spark, f"{root}/status").filter("batch = 1").collect()}
    assert got["pair"] == got["b"] and got["big"] == got["b"] and got["a"] > got["b"] and got["silent"] is None
