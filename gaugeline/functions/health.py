"""Health formulas as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAILY_MINUTES = 1440
COMPLETENESS_FLOOR = 80

HOUR_FIELDS = [
    ("hour", "timestamp"),
    ("data_points", "int"),
    ("expected_records", "int"),
    ("completeness_pct", "double"),
    ("duplicate_timestamps", "int"),
    ("null_values", "int"),
    ("avg_delay_minutes", "double"),
    ("max_delay_minutes", "double"),
    ("uptime_pct", "double"),
    ("total_validation_errors", "int"),
]


def expected_per_hour(interval: Column) -> Column:
    """Whole records that fit in an hour: 45 minutes gives 1, 7 gives 8, 90 gives 0."""
    return F.floor(F.lit(60) / interval).cast("int")


def completeness_pct(points: Column, expected: Column) -> Column:
    share = F.bround(points / expected * 100, 2)
    return F.when(expected > 0, F.least(F.lit(100.0), share)).otherwise(F.lit(0.0))


def uptime_pct(points: Column) -> Column:
    return F.when(points > 0, F.lit(100.0)).otherwise(F.lit(0.0))


def missing_data_pct(completeness: Column) -> Column:
    return F.lit(100.0) - completeness


def status_expr(
    age_minutes: Column,
    mean_completeness: Column,
    delayed_minutes: Column,
    offline_minutes: Column,
    job_failed: Column,
) -> Column:
    """The first rule that holds decides. ``mean_completeness`` is NULL without hours."""
    return (
        F.when(job_failed, "OFFLINE")
        .when(age_minutes.isNull(), "OFFLINE")
        .when(age_minutes > offline_minutes, "OFFLINE")
        .when(age_minutes > delayed_minutes, "DELAYED")
        .when(mean_completeness < COMPLETENESS_FLOOR, "DELAYED")
        .otherwise("ACTIVE")
    )
