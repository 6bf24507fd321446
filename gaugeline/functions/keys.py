"""Key and label expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATOR = "|"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def natural_key(*cols: Column | str) -> Column:
    """The parts of a key as text, joined with ``|``. NULL parts are left out."""
    return F.concat_ws(SEPARATOR, *[_col(c).cast("string") for c in cols])


def surrogate_key(*cols: Column | str, tag: str | None = None, strict: bool = False) -> Column:
    """SHA-256 of the natural key; ``tag`` is appended as a last part (the asset class).

    Joining leaves NULL parts out, so (g, NULL) and (g) share a key. ``strict``
    returns NULL for a row with a NULL part, which a not-null rule then rejects.
    """
    parts = [_col(c) for c in cols]
    hashed = F.sha2(natural_key(*parts, *([F.lit(tag)] if tag else [])), 256)
    if not strict:
        return hashed
    complete = F.lit(True)
    for p in parts:
        complete = complete & p.isNotNull()
    return F.when(complete, hashed)


def event_date(ts: Column | str) -> Column:
    return F.to_date(_col(ts))


def flow_direction(is_export: Column | str) -> Column:
    """'Export' for a true flag, 'Import' for false and for unknown."""
    return F.when(_col(is_export), "Export").otherwise("Import")


def round_metrics(df: DataFrame, cols: list[str], scale: int) -> DataFrame:
    return df.withColumns({c: F.round(c, scale) for c in cols})


def map_to_structs(col: Column | str, fields: list[str], name: str = "name") -> Column:
    """MAP(name -> struct) to ARRAY(struct(name, the chosen fields))."""
    return F.transform(
        F.map_entries(_col(col)),
        lambda e: F.struct(e["key"].alias(name), *[e["value"][f].alias(f) for f in fields]),
    )


def constants(df: DataFrame, values: dict[str, object], stamp: str | None = None, now=None) -> DataFrame:
    """Add fixed attributes and, if named, a processing-time column (``now`` fixes its value)."""
    cols = {k: F.lit(v) for k, v in values.items()}
    if stamp:
        cols[stamp] = F.current_timestamp() if now is None else now
    return df.withColumns(cols)
