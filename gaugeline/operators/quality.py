"""Quality rules that warn, drop or fail. A rule that gives NULL counts as broken."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``check`` is a boolean SQL expression; ``action`` is warn, drop or fail."""

    name: str
    check: str
    action: str = "warn"

    @property
    def holds(self) -> Column:
        return F.coalesce(F.expr(self.check), F.lit(False))


def _of(rules: Sequence[Rule], action: str) -> list[Rule]:
    return [r for r in rules if r.action == action]


def holds_or_stop(condition: Column, message: str) -> Column:
    """A filter that never drops a row but stops the job where ``condition`` does not hold.

    Naming the partition in the message also makes it non-deterministic, which keeps the
    optimizer from moving it: it sees exactly the rows that come out of the steps before it.
    """
    where = F.concat(F.lit(f"{message} (partition "), F.spark_partition_id().cast("string"), F.lit(")"))
    return F.when(condition, True).otherwise(F.raise_error(where).cast("boolean"))


def expect_warn(df: DataFrame, rules: Sequence[Rule], observation: Observation | None = None) -> DataFrame:
    """Keep every row; count the broken rules while the rows pass by, in the same job."""
    if observation is None or not rules:
        return df
    return df.observe(observation, *[F.count_if(~r.holds).alias(r.name) for r in rules])


def expect_drop(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    for rule in rules:
        df = df.filter(rule.holds)
    return df


def expect_fail(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Stop the job at the first row that breaks a rule."""
    for rule in rules:
        df = df.filter(holds_or_stop(rule.holds, f"quality rule {rule.name} broken: {rule.check}"))
    return df


def apply_rules(df: DataFrame, rules: Sequence[Rule], observation: Observation | None = None) -> DataFrame:
    """All rules of one table: fail first, then drop, then count the warnings."""
    df = expect_fail(df, _of(rules, "fail"))
    df = expect_drop(df, _of(rules, "drop"))
    return expect_warn(df, _of(rules, "warn"), observation)


def quality_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Passed and failed rows per rule, from one pass over the data."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(~r.holds).alias(f"_failed_{i}") for i, r in enumerate(rules)],
    )
    rows = [
        F.struct(
            F.lit(r.name).alias("rule"),
            F.lit(r.action).alias("action"),
            (F.col("_rows") - F.col(f"_failed_{i}")).alias("passed"),
            F.col(f"_failed_{i}").alias("failed"),
        )
        for i, r in enumerate(rules)
    ]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def quarantine(df: DataFrame, rules: Sequence[Rule], out: str = "failed_rules") -> DataFrame:
    """The rows that break any rule, with the names of those rules."""
    broken = F.array_compact(F.array(*[F.when(~r.holds, r.name) for r in rules]))
    return df.withColumn(out, broken).filter(F.size(out) > 0)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Declared keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Return ``df`` or raise when a declared key repeats (runs one job)."""
    if not duplicate_keys(df, keys).isEmpty():
        raise ValueError(f"key {list(keys)} is not unique")
    return df
