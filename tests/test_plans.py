"""What the optimizer is left to work with: pushed filters, pruned scans, no row-wise code."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from registry.queries import QUERIES

SLOW = [n for n in QUERIES if n != "monthly_run"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", SLOW)
def test_no_cross_join_no_python_no_global_window(spark, name):
    text = plan(entry.queries()[name](spark, "/root/testdata/sf0.001"))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Window"):
        assert operator not in text


@pytest.mark.parametrize(
    "name", ["last_12_months", "q5_months_active", "q3_segment_changes_history"]
)
def test_the_cutoff_reaches_the_scan(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir))
    assert "GreaterThanOrEqual(o_orderdate,2000-07-15T00:00)" in text


def test_freshness_is_a_pushed_range(spark, sf_dir):
    text = plan(entry.queries()["freshness"](spark, sf_dir))
    assert "GreaterThanOrEqual(o_orderdate,2001-07-01T00:00)" in text
    assert "LessThan(ts,2024-03-01T00:00)" in text


@pytest.mark.parametrize(
    "name, columns",
    [
        ("q1_industry_exposure", {"o_custkey", "o_totalprice"}),
        ("revenue_by_period", {"o_custkey", "o_orderdate", "o_totalprice"}),
        ("q4_top_customers", {"o_custkey", "o_totalprice"}),
    ],
)
def test_scans_are_pruned(spark, sf_dir, name, columns):
    text = plan(entry.queries()[name](spark, sf_dir))
    assert "lineitem.parquet" not in text
    scans = re.findall(r"orders\.parquet.*?ReadSchema: struct<([^>]*)>", text)
    assert scans
    for schema in scans:
        read = {c.split(":")[0] for c in re.sub(r"\([^)]*\)", "", schema).split(",")}
        assert read == columns


def test_one_shuffle_for_period_metrics(spark, sf_dir):
    text = plan(entry.queries()["revenue_by_period"](spark, sf_dir))
    assert text.count("Exchange hashpartitioning") == 1


def test_metrics_aggregate_by_hash(spark, sf_dir):
    for name in ("revenue_by_period", "upsert_traffic_batch", "q5_whole_periods"):
        assert "SortAggregate" not in plan(entry.queries()[name](spark, sf_dir))


@pytest.mark.parametrize("name", ["q5_whole_periods", "q5_always_active_top"])
def test_facts_are_reduced_before_they_meet_the_industry(spark, sf_dir, name):
    """Below the join on the customer stands an aggregate over the orders."""
    from revmill.plans import questions
    from revmill.sources import star

    mode = "exact" if "always" in name else "whole_periods"
    customers = star.customers(spark, sf_dir).select("customer_id", "industry")
    measured = questions.dimension_activity(
        customers, star.traffic(spark, sf_dir), "2001-07-15", entity="industry", mode=mode
    )
    text = measured._jdf.queryExecution().optimizedPlan().toString()
    steps = [line for line in text.splitlines() if "Aggregate" in line or "Join" in line]
    joined = next(i for i, line in enumerate(steps) if "Join" in line)
    assert "Aggregate" in steps[joined - 1] and "Aggregate" in steps[joined + 1]


@pytest.mark.parametrize("name", ["upsert_channels_batch", "upsert_customers_batch"])
def test_dimension_upserts_aggregate_by_hash(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir))
    assert "SortAggregate" not in text and "HashAggregate" in text
