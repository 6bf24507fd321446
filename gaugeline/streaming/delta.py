"""Interval values of counters on a stream."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import (
    AtomicType, BinaryType, BooleanType, DataType, DoubleType, FloatType, IntegralType, StringType, StructField, StructType, TimestampType)

from ..operators.order import Order
from .state import DEFAULT_HORIZON, keep_earliest, one_frame

#: Groups that the keys are dealt into. A checkpoint belongs to the number it was begun with.
BUCKETS = 1024
_STATE = "keys array<string>, last_values array<double>, last_times array<bigint>, deadlines array<bigint>"


def _plain(key: Column, kind: DataType) -> Column:
    """A key as text: equal for equal keys, in the sense of a grouping, and different for different ones."""
    if isinstance(kind, StringType):
        return key
    if isinstance(kind, BinaryType):
        return F.hex(key)
    if isinstance(kind, TimestampType):
        return F.unix_micros(key).cast("string")
    if isinstance(kind, (DoubleType, FloatType)):
        return (key + F.lit(0).cast(kind)).cast("string")  # no negative zero
    return key.cast("string") if isinstance(kind, AtomicType) else F.to_json(F.struct(key), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})


def _identity(fields: Sequence[StructField]) -> Column:
    """All keys of a row as one text; each part is led by its length, so no two rows of keys share one."""
    parts = [_plain(F.col(f.name), f.dataType) for f in fields]
    return F.concat(F.lit(""), *[F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts])


def stream_counter_delta(
    stream: DataFrame,
    keys: Sequence[str],
    ts: str,
    counter: str,
    carry: Sequence[str] = (),
    out: str = "interval",
    tie_break: Order = (),
    watermark: str = DEFAULT_HORIZON,
    max_gap: str | None = DEFAULT_HORIZON,
    buckets: int = BUCKETS,
) -> DataFrame:
    """The streaming form of ``counter_delta``, with the state (last value, last time) per key.

    Rows at or before the last time of their key are given out with ``is_late`` and no
    interval, and do not touch the state; repeats within a micro-batch are dropped.
    The state of a key expires one watermark after its newest event, and a silence longer than
    ``max_gap`` gives NULL whether or not the state has expired yet.

    Keys are dealt by hash into ``buckets`` groups, and all keys of a group are worked on at once: a call into Python costs
    about as much for one key as for thousands. A group's state is the arrays of its keys, written anew when the group has rows.
    """
    names = [*keys, ts, counter, *[c for c in carry if c != counter]]
    narrow = stream.select(*names, *[c for c, _ in tie_break if c not in names])
    fields = {f.name: f for f in narrow.schema.fields}
    final = [*[fields[n] for n in names], StructField(out, DoubleType()), StructField("is_late", BooleanType())]
    # A whole number that is missing would make all of its column in a group floating point.
    whole = [n for n in narrow.columns if isinstance(fields[n].dataType, IntegralType)]
    result = StructType([*final, *[StructField(f"_no_{n}", BooleanType()) for n in whole if n in names]])
    order = [way for c, d in tie_break for way in ([(f"_no_{c}", True)] if c in whole else []) + [(c, d == "asc")]]
    horizon = pd.Timedelta(watermark) // pd.Timedelta(microseconds=1)
    limit = pd.Timedelta(max_gap) // pd.Timedelta(microseconds=1) if max_gap else None

    def advance(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known = state.get if state.exists else ([], [], [], [])
        mark = state.getCurrentWatermarkMs()
        if state.hasTimedOut:
            left = np.array(known[3], "int64") >= mark
            keep_earliest(state, [list(np.array(k, object)[left]) for k in known])
            return
        rows = one_frame(frames)
        code, texts = pd.factorize(rows["_key"])
        last_value, last_time = np.full(len(texts), np.nan), np.zeros(len(texts), "int64")
        deadline, seen = np.zeros(len(texts), "int64"), np.zeros(len(texts), bool)
        place = pd.Index(texts).get_indexer(pd.Index(known[0], dtype=object))
        met = place >= 0
        last_value[place[met]] = np.array(known[1], "float64")[met]
        last_time[place[met]], seen[place[met]] = np.array(known[2], "int64")[met], True

        # In the order of key, time and tie-break; NULLs come last.
        if tie_break:
            rows = rows.assign(_code=code).sort_values(["_code", ts, *[c for c, _ in order]], ascending=[True, True, *[up for _, up in order]], kind="stable")
            code = rows["_code"].to_numpy()
        else:
            by_time = np.lexsort((rows[ts].to_numpy(), code))
            rows, code = rows.take(by_time), code[by_time]
        at = rows[ts].to_numpy().astype("datetime64[us]").astype("int64")
        values = rows[counter].to_numpy(dtype="float64", na_value=np.nan)
        if counter in whole:
            values = np.where(rows[f"_no_{counter}"].to_numpy(), np.nan, values)
        late = seen[code] & (at <= last_time[code])
        fresh = ~late & np.r_[True, (at[1:] != at[:-1]) | (code[1:] != code[:-1])]
        now, level, of = at[fresh], values[fresh], code[fresh]
        first = np.r_[True, of[1:] != of[:-1]][: len(of)]
        since = np.where(first, last_time[of], np.roll(now, 1))
        before = np.where(first, last_value[of], np.roll(level, 1))
        rises = (level >= before) & (~first | seen[of])
        if limit is not None:
            rises &= now - since <= limit
        intervals = np.full(len(rows), np.nan)
        intervals[fresh] = np.where(rises, level - before, np.nan)
        given = fresh | late
        yield rows.assign(**{out: intervals, "is_late": late})[given][result.names]

        end = np.flatnonzero(np.r_[first[1:], True][: len(of)])  # the newest row of each key that goes on
        last_value[of[end]], last_time[of[end]] = level[end], now[end]
        deadline[:] = np.maximum((last_time + horizon) // 1000, mark + 1)
        still = ~met & (np.array(known[3], "int64") >= mark)  # keys without rows, their time not run out
        silent = [list(np.array(k, object)[still]) for k in known]
        keep_earliest(state, [a + b for a, b in zip(silent, (list(texts), last_value.tolist(), last_time.tolist(), deadline.tolist()))])

    shown = narrow.filter(F.col(ts).isNotNull()).withWatermark(ts, watermark)
    shown = shown.withColumn("_key", _identity([fields[k] for k in keys]))
    shown = shown.withColumns({
        "_bucket": F.pmod(F.xxhash64("_key"), F.lit(buckets)),
        **{f"_no_{n}": F.col(n).isNull() for n in whole}, **{n: F.coalesce(F.col(n), F.lit(0).cast(fields[n].dataType)) for n in whole},
    })
    made = shown.groupBy("_bucket").applyInPandasWithState(advance, result, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return made.select(*[
        F.when(~F.col(f"_no_{f.name}"), F.col(f.name)).alias(f.name) if f"_no_{f.name}" in result.names else F.col(f.name) for f in final])
