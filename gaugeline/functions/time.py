"""Time expressions. Every bound is computed from an explicit ``as_of``."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_ZONE = "Europe/Amsterdam"


def utc(moment: datetime | str) -> datetime:
    """An aware UTC datetime; text and naive values are taken as UTC."""
    if isinstance(moment, str):
        moment = datetime.fromisoformat(moment)
    if moment.tzinfo is None:
        return moment.replace(tzinfo=timezone.utc)
    return moment.astimezone(timezone.utc)


def ts_lit(moment: datetime | str) -> Column:
    """A TIMESTAMP literal, the same instant under every session time zone."""
    return F.expr(f"TIMESTAMP '{utc(moment).strftime('%Y-%m-%d %H:%M:%S.%f')} UTC'")


def date_lit(moment: datetime | str) -> Column:
    return F.expr(f"DATE '{utc(moment):%Y-%m-%d}'")


def local_day_bounds(as_of: datetime | str, zone: str = DEFAULT_ZONE) -> tuple[datetime, datetime]:
    """The previous local calendar day as UTC bounds; 23 or 25 hours when clocks change."""
    tz = ZoneInfo(zone)
    today = utc(as_of).astimezone(tz).date()
    yesterday = today - timedelta(days=1)
    return tuple(
        datetime(d.year, d.month, d.day, tzinfo=tz).astimezone(timezone.utc) for d in (yesterday, today)
    )


def local_day_window(
    df: DataFrame, as_of: datetime | str, tz_col: str, start: str = "window_start", end: str = "window_end"
) -> DataFrame:
    """The same bounds as columns, for rows that carry their own time zone."""
    midnight = F.date_trunc("day", F.from_utc_timestamp(ts_lit(as_of), F.col(tz_col)))
    return df.withColumns({
        start: F.to_utc_timestamp(midnight - F.expr("INTERVAL 1 DAY"), F.col(tz_col)),
        end: F.to_utc_timestamp(midnight, F.col(tz_col)),
    })


def rolling_window(as_of: datetime | str) -> tuple[datetime, datetime]:
    """From one day ago, cut to the hour, until now."""
    now = utc(as_of)
    return (now - timedelta(days=1)).replace(minute=0, second=0, microsecond=0), now


def since(ts: str, start: datetime | str, date_col: str | None = None) -> Column:
    """From ``start`` on; with the event date of a partitioned table also by whole folders."""
    later = F.col(ts) >= ts_lit(start)
    return later & (F.col(date_col) >= date_lit(start)) if date_col else later


def within(ts: str, start: datetime | str, end: datetime | str, date_col: str | None = None) -> Column:
    """Half-open [start, end) on the bare column, so that the scan can use it.

    ``date_col`` names the UTC event date that the table is partitioned by, if it is.
    """
    inside = since(ts, start, date_col) & (F.col(ts) < ts_lit(end))
    return inside & (F.col(date_col) <= date_lit(end)) if date_col else inside


def bucket_start(ts: Column | str, minutes: int) -> Column:
    """Start of the epoch-aligned bucket that holds ``ts``."""
    col = F.col(ts) if isinstance(ts, str) else ts
    width = minutes * 60
    return F.timestamp_seconds(F.floor(F.unix_timestamp(col) / width) * width)


def minutes_between(later: Column, earlier: Column) -> Column:
    """Whole-second distance in minutes, as double."""
    return (F.unix_timestamp(later) - F.unix_timestamp(earlier)) / F.lit(60.0)
