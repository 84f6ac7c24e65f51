"""Plan assertions: the physical strategies the design relies on."""

import pytest

from conftest import SF001
from sigflow.plans import queries as Q
from sigflow.plans.inspect import (
    has_partial_aggregate,
    partition_filters,
    plan_text,
    read_schemas,
    uses_broadcast_join,
)
from sigflow.plans.staging import load_telemetry
from sigflow.operators.analysis import daily_datapoints


def test_rename_is_broadcast_left_join(spark):
    df = Q.hourly_long_renamed_q(spark, SF001)
    text = plan_text(df, "simple")
    assert uses_broadcast_join(df)
    assert "LeftOuter" in text and "BuildRight" in text


def test_daily_datapoints_reads_two_columns(spark):
    df = daily_datapoints(load_telemetry(spark, SF001))
    schemas = read_schemas(df)
    assert schemas and all("signals" not in s for s in schemas)
    assert "signal_ts" in schemas[0]


def test_hourly_aggregates_partially_before_shuffle(spark):
    df = Q.hourly_generation_q(spark, SF001)
    assert has_partial_aggregate(df)
    assert "create_ts" not in " ".join(read_schemas(df))


def test_day_scan_uses_partition_filter(spark):
    df = Q.telemetry_day_q(spark, SF001)
    assert any("signal_date" in f for f in partition_filters(df))


def test_preview_is_top_n_not_full_sort(spark):
    df = Q.hourly_preview_q(spark, SF001)
    assert "TakeOrderedAndProject" in plan_text(df, "simple")


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_no_python_evaluation_in_registered_plans(spark, name):
    text = plan_text(Q.QUERIES[name](spark, SF001), "simple")
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
        assert node not in text, (name, node)
