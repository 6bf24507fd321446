"""What the plans of the registered queries must not contain, and what they must."""

import re

import pytest

from gaugeline.plans import inputs
from gaugeline.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
STREAMED = {"counter_delta_stream", "counter_delta_incremental", "pivot_wide_stream", "pivot_wide_incremental",
            "sensor_fact_stream", "stream_health_refresh", "envelope_roundtrip", "list_landed", "history_append", "serving_stream",
            "materialized_view", "scan_landed", "late_heal", "moving_event_time", "quality_warnings", "quality_stops", "unique_keys",
            "envelope_provenance", "stream_health_state", "published_versions"}
BATCH = sorted(set(QUERIES) - STREAMED)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_no_cross_join_no_global_window(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert not re.search(r"InPandas|InArrow|EvalPython", plan)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan)
    assert not re.search(r"Window[^\n]*\n[^\n]*Sort[^\n]*\n[^\n]*Exchange SinglePartition", plan)


def test_window_filter_reaches_the_scan(spark):
    plan = plan_of(QUERIES["hourly_metrics"](spark, SF))
    assert "GreaterThanOrEqual(ts,2024-01-18" in plan and "LessThan(ts,2024-01-19" in plan


def test_scans_read_only_what_is_needed(spark):
    plan = plan_of(QUERIES["latest_record"](spark, SF))
    assert not any("props" in s or "value" in s for s in re.findall(r"ReadSchema: (\S+)", plan))


def test_attributes_are_not_parsed_on_fact_rows(spark):
    """Filters on the parsed attributes stay above the generator."""
    plan = plan_of(QUERIES["latest_record"](spark, SF))
    below_scan_filter = re.findall(r"Filter \([^\n]*from_json", plan)
    assert not below_scan_filter


def test_given_tables_have_the_declared_columns(spark):
    for name, ddl in inputs.TABLES.items():
        stored = dict(spark.read.parquet(f"{SF}/{name}.parquet").dtypes)
        declared = [part.split() for part in ddl.split(", ")]
        for col, kind in declared:
            assert stored[col].removesuffix("_ntz") == kind
