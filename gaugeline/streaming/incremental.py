"""Set-based incremental runs: a micro-batch joined to the state the last one left behind.

These give the rows of the stateful operators without per-key Python: every step is a
join, an aggregation or a window over the micro-batch, so the number of keys, and how
unevenly rows are spread over them, matter little.

State is a row per key. A micro-batch writes only the keys it has changed, to a log; every `COMPACT_EVERY` micro-batches the
log is merged into the base, of which only the touched hash buckets are written anew. So what a micro-batch writes grows
with the micro-batch, not with the number of keys.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.order import Order, counter_delta
from ..operators.pivot import pivot_categories
from ..sources import versions

Step = Callable[[DataFrame, DataFrame | None, datetime | None], DataFrame]
Changes = Callable[[DataFrame, DataFrame | None], DataFrame]


COMPACT_EVERY = 10
BUCKETS = 64
#: Rows of one key in a micro-batch from which on keys are cut into hours; below, a key is a task's share at most.
HOT_ROWS = 100_000


def read_state(spark: SparkSession, state_path: str, keys: Sequence[str], before: int) -> DataFrame | None:
    """The state that the micro-batches before ``before`` left: the base, and the changes logged since."""
    upto = versions.about_version(spark, f"{state_path}/base").get("upto", -1)
    logs = [f"{state_path}/log/batch={n}" for n in range(upto + 1, before)]
    parts = ([versions.read_parts(spark, f"{state_path}/base")] if upto >= 0 else []) + ([spark.read.parquet(*logs)] if logs else [])
    if not parts:
        return None
    columns = [c for c in parts[-1].columns if c not in ("_bucket", "_batch")]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    newest = F.max_by(F.struct(*[c for c in columns if c not in keys]), F.struct("_last_time", "_batch"))
    return rows.groupBy(*keys).agg(newest.alias("_s")).select(*keys, "_s.*").select(*columns)


def log_state(changed: DataFrame, state_path: str, keys: Sequence[str], batch_id: int) -> None:
    """Keep the keys that a micro-batch has changed."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")
    changed.withColumns({"_bucket": bucket, "_batch": F.lit(batch_id)}).write.mode("overwrite").parquet(f"{state_path}/log/batch={batch_id}")


def compact_state(spark: SparkSession, state_path: str, keys: Sequence[str], before: int, forget_before: datetime | None = None) -> list[int]:
    """Merge the log of the micro-batches before ``before`` into the base and give the buckets that were written.

    Called at the start of a micro-batch, so a repeated one finds the same state. ``forget_before`` drops silent keys of these buckets.
    """
    upto = versions.about_version(spark, f"{state_path}/base").get("upto", -1)
    logs = [f"{state_path}/log/batch={n}" for n in range(upto + 1, before)]
    if not logs:
        return []
    touched = sorted(r[0] for r in spark.read.parquet(*logs).select("_bucket").distinct().collect())
    state = read_state(spark, state_path, keys, before)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")
    merged = state.withColumns({"_bucket": bucket, "_batch": F.lit(before - 1)}).filter(F.col("_bucket").isin(touched))
    if forget_before is not None:
        merged = merged.filter(F.col("_last_time") >= F.lit(forget_before))
    versions.publish_parts(merged.repartition("_bucket"), f"{state_path}/base", "_bucket", about={"upto": before - 1})
    return touched


def _marks(spark: SparkSession, state_path: str, before: int) -> DataFrame:
    """The first and last time of the accepted rows of each earlier micro-batch."""
    return spark.read.schema("low timestamp, high timestamp, batch bigint").parquet(f"{state_path}/reach").filter(F.col("batch") < before)


def _reaching(spark: SparkSession, state_path: str, before: int, low: datetime, high: datetime) -> list[int]:
    """Earlier micro-batches whose accepted rows reach into a range of times."""
    marks = _marks(spark, state_path, before)
    near = marks.filter((F.col("low") <= F.lit(high)) & (F.col("high") >= F.lit(low)))
    return sorted(r["batch"] for r in near.select("batch").collect())


def run_with_state(
    stream: DataFrame, step: Step, changes: Changes, path: str, state_path: str, checkpoint: str,
    keys: Sequence[str], ts: str, values: Sequence[str], horizon: str,
) -> None:
    """Run once over what is new.

    For each micro-batch ``step(batch, state, newest)`` (the newest time in the state) gives the rows to store, marked with
    ``is_late``, and ``changes(accepted, state)`` the state of the keys it has changed. Both are written to
    folders with the number of the micro-batch, so one that is repeated after a failure
    starts from the same state and replaces what it had written. Late rows that say nothing new
    are repeats of a fetch and go: those for which a row accepted before has the same keys and time
    and the same value in each of the ``values`` columns that the late row fills. They are looked for only if there are late
    rows, and only in the micro-batches that reach into their times. Keys silent for two horizons are forgotten.
    """
    identity = [*keys, ts]

    def new_late(rows: DataFrame, batch_id: int) -> DataFrame:
        spark, late = rows.sparkSession, F.when(F.col("is_late"), F.col(ts))
        low, high = rows.agg(F.min(late), F.max(late)).first()
        if low is None:
            return rows
        near = [f"{path}/batch={n}/is_late=false" for n in _reaching(spark, state_path, batch_id, low, high)]
        if not near:
            return rows
        before = spark.read.schema(T.StructType([f for f in rows.schema if f.name != "is_late"])).parquet(*near)
        before = before.filter(F.col(ts).between(F.lit(low), F.lit(high)))
        seen = before.select(*identity, F.lit(True).alias("is_late"), *(F.col(v).alias(f"_seen_{v}") for v in values))
        told = F.lit(True)
        for c in [*identity, "is_late"]:
            told = told & (rows[c] == seen[c])
        for v in values:
            told = told & (rows[v].isNull() | rows[v].eqNullSafe(seen[f"_seen_{v}"]))
        late_rows = rows.filter("is_late").join(seen, told, "left_anti").select(*rows.columns)
        return rows.filter("NOT is_late").unionByName(late_rows)

    def advance(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id and batch_id % COMPACT_EVERY == 0:
            before = read_state(spark, state_path, keys, batch_id)
            edge = before.agg(F.max("_last_time") - F.expr(f"INTERVAL {horizon}") * 2).first()[0]
            compact_state(spark, state_path, keys, batch_id, edge)
        state = read_state(spark, state_path, keys, batch_id)
        target = f"{path}/batch={batch_id}"
        newest = _marks(spark, state_path, batch_id).agg(F.max("high")).first()[0] if state is not None else None
        rows = step(batch, state, newest)
        if batch_id:  # looked at for late rows, then written
            rows = rows.persist()
            new_late(rows, batch_id).write.mode("overwrite").partitionBy("is_late").parquet(target)
            rows.unpersist()
        else:
            rows.write.mode("overwrite").partitionBy("is_late").parquet(target)
        stored = spark.read.schema(rows.schema).parquet(target)
        accepted = stored.filter(~F.col("is_late"))
        log_state(changes(accepted, state), state_path, keys, batch_id)
        accepted.agg(F.min(ts).alias("low"), F.max(ts).alias("high")).write.mode("overwrite").parquet(f"{state_path}/reach/batch={batch_id}")

    (
        stream.writeStream.foreachBatch(advance)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def _with_last(batch: DataFrame, state: DataFrame | None, newest: datetime | None, keys: Sequence[str], ts: str, value_type: str,
               horizon: str) -> DataFrame:
    """Add the last reading of the key and whether a row is behind it or behind the watermark.

    The watermark is the newest time of all keys less ``horizon``, as known before this batch.
    A key with many rows is split by the adaptive skew join.
    """
    if state is None:
        return batch.withColumns({
            "_last_value": F.lit(None).cast(value_type), "_last_time": F.lit(None).cast("timestamp"),
            "is_late": F.lit(False),
        })
    newest = F.lit(newest).cast("timestamp")
    edge, gone = newest - F.expr(f"INTERVAL {horizon}"), newest - F.expr(f"INTERVAL {horizon}") * 2
    state = state.filter(F.col("_last_time") >= gone)  # keys silent for two horizons are forgotten
    behind = (F.col(ts) <= F.col("_last_time")) | (F.col(ts) < edge)
    return batch.join(state, list(keys), "left").withColumn("is_late", F.coalesce(behind, F.lit(False)))


def incremental_counter_delta(
    stream: DataFrame,
    keys: Sequence[str],
    ts: str,
    counter: str,
    path: str,
    state_path: str,
    checkpoint: str,
    out: str = "interval",
    tie_break: Order = (),
    horizon: str = "8 days",
    max_gap_seconds: int | None = 8 * 24 * 3600,
) -> None:
    """Interval values of what is new, continuing from the last reading of each key.

    Rows at or before it, or behind the watermark, are stored as late with no interval, unless
    they repeat a row that was accepted before.
    """
    value_type = stream.schema[counter].dataType.simpleString()
    order = list(tie_break) or [(counter, "asc")]

    def step(batch: DataFrame, state: DataFrame | None, newest: datetime | None) -> DataFrame:
        batch = batch.filter(F.col(ts).isNotNull())
        hot = bool(batch.groupBy(*keys).count().filter(F.col("count") > HOT_ROWS).take(1))
        # Without a hot key, rows are dealt out once, by key: for the join to the state as for their order.
        rows = _with_last(batch if hot else batch.repartition(*keys), state, newest, keys, ts, value_type, horizon)
        # Late rows take part as keys of their own, so that the batch is read only once.
        marked = counter_delta(
            rows, [*keys, "is_late"], ts, counter, out, tie_break=order, max_gap_seconds=max_gap_seconds,
            seed=("_last_value", "_last_time"), slice_seconds=3600, whole=not hot,
        )
        return marked.withColumn(out, F.when(~F.col("is_late"), F.col(out))).drop("_last_value", "_last_time")

    def changes(accepted: DataFrame, state: DataFrame | None) -> DataFrame:
        return accepted.groupBy(*keys).agg(F.max_by(counter, ts).alias("_last_value"), F.max(ts).alias("_last_time"))

    run_with_state(stream, step, changes, path, state_path, checkpoint, keys, ts, [counter], horizon)


def incremental_pivot(
    stream: DataFrame,
    keys: Sequence[str],
    ts: str,
    category: str,
    value: str,
    mapping: dict[object, str],
    order: Sequence[str],
    path: str,
    state_path: str,
    checkpoint: str,
    drift: str | None = None,
    horizon: str = "8 days",
) -> None:
    """Wide rows of what is new; rows for times already given out are stored as late."""

    def step(batch: DataFrame, state: DataFrame | None, newest: datetime | None) -> DataFrame:
        rows = _with_last(batch.filter(F.col(ts).isNotNull()), state, newest, keys, ts, "double", horizon)
        return pivot_categories(rows, [*keys, ts, "is_late"], category, value, mapping, order, drift)

    def changes(accepted: DataFrame, state: DataFrame | None) -> DataFrame:
        newest = accepted.groupBy(*keys).agg(F.max(ts).alias("_last_time"))
        return newest.withColumn("_last_value", F.lit(None).cast("double"))

    run_with_state(stream, step, changes, path, state_path, checkpoint, keys, ts, [*mapping.values(), *([drift] if drift else [])], horizon)
