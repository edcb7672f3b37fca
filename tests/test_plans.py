"""The shape of the plans: what is read, what is shuffled, what never happens."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry_points

QUERIES = entry_points.queries()
WRITING = {"csv_round_trip", "metrics_long", "params_long", "ab_report_json", "period_report_incremental", "model_round_trip"}
FITTING = {"train_rf", "train_lr", "train_cv", "train_halving", "model_params", "score_champion_challenger", "ab_report_rf"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING - FITTING))
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "Pandas" not in plan


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("ab_report", {"o_orderkey", "o_orderstatus"}),
        ("auc_by_group", {"o_orderkey", "o_orderstatus"}),
        ("group_counts", {"o_orderkey"}),
        ("class_balance", {"o_orderstatus"}),
        ("ab_report_by_period", {"event_id", "ts", "event_type"}),
    ],
)
def test_one_scan_of_the_needed_columns(spark, sf_dir, name, columns):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert len(schemas) == 1
    assert {c.split(":")[0] for c in schemas[0].split(",")} == columns


@pytest.mark.parametrize("name", ["ab_report", "ab_decision", "slice_metrics"])
def test_rows_are_counted_before_they_are_shuffled(spark, sf_dir, name):
    """Going up from the scan of the facts, a partial aggregate comes before the first exchange."""
    lines = plan_of(QUERIES[name](spark, sf_dir)).splitlines()
    start = next(i for i, line in enumerate(lines) if "FileScan" in line and "orders" in line)
    above = [line for line in reversed(lines[:start]) if re.search(r"Exchange|partial_count", line)]
    above = [line for line in above if "BroadcastExchange" not in line]
    assert "partial_count" in above[0]


def test_filters_reach_the_scan(spark, sf_dir):
    from duelist.plans import fixtures
    from duelist.operators.sampling import assign_group

    df = assign_group(fixtures.transactions(spark, sf_dir), "tx_id", "t").filter("tx_amount > 1000 AND ab_group = 'champion'")
    assert "GreaterThan(o_totalprice,1000.0)" in plan_of(df)


def test_running_sums_never_hold_a_whole_group(spark, sf_dir):
    """Windows over cells are partitioned by group and bucket; only bucket totals go by group."""
    plan = plan_of(QUERIES["ab_report"](spark, sf_dir))
    specs = re.findall(r"windowspecdefinition\(([^)]*?) ASC", plan)
    inner = [s for s in specs if "score" in s]
    assert inner and all("_bucket" in s and "ab_group" in s for s in inner)
