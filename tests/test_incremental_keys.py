"""Incremental runs: keys whole, or cut into hours when one of them is hot."""

import pytest
from pyspark.sql import functions as F

from gaugeline.operators.order import lag_columns
from gaugeline.schemas import struct
from gaugeline.streaming import incremental
from gaugeline.streaming.state import read_split

BASE = 1_704_067_200
READING = "key string, ts timestamp, v double"


def frame(spark, data):
    return spark.createDataFrame(data, READING.replace("timestamp", "double")).withColumn("ts", F.timestamp_seconds(F.col("ts") + BASE))


def test_whole_keys_are_compared_without_a_join(spark, rows):
    data = [(k, 3600.0 * i if i % 5 else None, float(i)) for k in ("a", "b", None) for i in range(1, 12)]
    df = frame(spark, data)
    for known in (None, F.col("v") % 3 != 0):
        one = lag_columns(df, ["key"], "ts", {"v": "pv"}, slice_seconds=7200, known=known, whole=True)
        assert "Join" not in one._jdf.queryExecution().executedPlan().toString()
        assert rows(one) == rows(lag_columns(df, ["key"], "ts", {"v": "pv"}, slice_seconds=7200, known=known))


@pytest.mark.parametrize("hot", [2, 100_000])
def test_hot_keys_change_nothing(spark, tmp_path, monkeypatch, rows, hot):
    monkeypatch.setattr(incremental, "HOT_ROWS", hot)
    batches = [[("a", 3000.0 * i, float(i), ) for i in range(5)] + [("b", 10.0, 1.0)],
               [("a", 4000.0, 2.0), ("a", 12000.0, 4.0), ("a", 15000.0, 9.0), ("a", 15000.0, 8.0), ("b", 20.0, 4.0), (None, 5.0, 1.0)]]
    for data in batches:
        frame(spark, data).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        incremental.incremental_counter_delta(
            spark.readStream.schema(READING).parquet(f"{tmp_path}/in"), ["key"], "ts", "v", f"{tmp_path}/out", f"{tmp_path}/state", f"{tmp_path}/cp")
    out = [rows(read_split(spark, f"{tmp_path}/out", struct(READING + ", interval double"), late), "key", F.unix_timestamp("ts") - BASE, "interval")
           for late in (False, True)]
    assert out[0] == sorted([(None, 5, None), ("a", 0, None), *[("a", 3000 * i, 1.0) for i in range(1, 5)], ("a", 15000, 4.0), ("b", 10, None), ("b", 20, 3.0)],
                            key=lambda t: tuple((v is not None, str(v)) for v in t))
    assert out[1] == [("a", 4000, None)]
