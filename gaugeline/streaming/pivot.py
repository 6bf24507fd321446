"""Category pivot on a stream."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import BooleanType, StructField, StructType

from ..operators.order import Order
from .state import DEFAULT_HORIZON, keep_until, ordered_group


def stream_pivot(
    stream: DataFrame,
    keys: Sequence[str],
    ts: str,
    category: str,
    value: str,
    mapping: dict[object, str],
    tie_break: Order = (),
    drift: str | None = None,
    watermark: str = DEFAULT_HORIZON,
) -> DataFrame:
    """The streaming form of ``pivot_categories``, with the last emitted time per key as state.

    A wide row is given out at once from what the micro-batch holds. Rows at or before the
    last emitted time are not added to it any more: they come out pivoted as well, marked
    ``is_late``, so that a batch run can complete the hour. Hours without any metric give
    no row and leave the state as it is.
    """
    columns = list(mapping.values())
    names = [*keys, ts, category, value, *([drift] if drift else [])]
    narrow = (
        stream.select(*names, *[c for c, _ in tie_break if c not in names])
        .filter(F.col(category).isin(*mapping) & F.col(ts).isNotNull())
    )
    fields = {f.name: f for f in narrow.schema.fields}
    result = StructType([
        *[fields[k] for k in keys], fields[ts],
        *[StructField(c, fields[value].dataType) for c in columns],
        *([fields[drift]] if drift else []),
        StructField("is_late", BooleanType()),
    ])
    horizon = pd.Timedelta(watermark)

    def first_at(rows: pd.DataFrame, col: str, mask: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The first value of ``col`` among the masked rows for each of the times ``at``."""
        times, first = np.unique(rows[ts].to_numpy()[mask], return_index=True)
        found = np.isin(times, at)
        values = rows[col].to_numpy()[mask][first[found]]
        filled = np.full(len(at), None if values.dtype == object else np.nan, dtype=values.dtype)
        filled[np.searchsorted(at, times[found])] = values
        return filled

    def widen(rows: pd.DataFrame) -> pd.DataFrame:
        """First non-null value per time and category, and the first drift per time."""
        codes, known = rows[category].to_numpy(), rows[value].notna().to_numpy()
        at = np.unique(rows[ts].to_numpy()[known])
        wide = {ts: at}
        for code, name in mapping.items():
            wide[name] = first_at(rows, value, known & (codes == code), at)
        if drift:
            wide[drift] = first_at(rows, drift, rows[drift].notna().to_numpy(), at)
        return pd.DataFrame(wide)

    def advance(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        (newest,) = state.get if state.exists else (None,)
        rows = ordered_group(frames, ts, tie_break)
        late = rows[ts].to_numpy() <= (np.datetime64("NaT") if newest is None else np.datetime64(newest))
        for flag in (False, True):
            part = rows[late == flag]
            if part.empty:
                continue
            wide = widen(part)
            if wide.empty:
                continue
            if not flag:
                newest = wide[ts].max().to_pydatetime()
                state.update((newest,))
            yield wide.assign(**dict(zip(keys, key)), is_late=flag)[result.names]
        if newest is not None:
            keep_until(state, pd.Timestamp(newest), horizon)

    return (
        narrow.withWatermark(ts, watermark)
        .groupBy(*keys)
        .applyInPandasWithState(advance, result, "last_time timestamp", "append", GroupStateTimeout.EventTimeTimeout)
    )
