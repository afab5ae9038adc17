"""The ways taken beyond every size bound, on whole tables against the same SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import same
from revmill.operators import joins, quantiles, ranking

QUERIES = [
    "column_statistics",
    "customers_with_traffic",
    "load_star",
    "q3_segment_changes",
    "q5_active_users",
    "q5_always_active_top",
    "q5_whole_periods",
    "quartiles",
    "resolve_traffic_keys",
    "top_fraction",
    "traffic_of_changed",
    "traffic_rejects",
]


def smaller(monkeypatch, function, **bounds):
    """Replaces defaults of a function."""
    code = function.__code__
    named = code.co_varnames[: code.co_argcount][-len(function.__defaults__) :]
    defaults = dict(zip(named, function.__defaults__)) | bounds
    monkeypatch.setattr(function, "__defaults__", tuple(defaults[n] for n in named))


@pytest.mark.parametrize("name", QUERIES)
def test_nothing_broadcast_and_keys_spread(spark, sf_dir, monkeypatch, name):
    monkeypatch.setattr(joins, "fits", lambda *a, **k: False)
    smaller(monkeypatch, joins.lookup, task_rows=500)
    smaller(monkeypatch, joins.resolve_keys, task_rows=500)
    smaller(monkeypatch, ranking.top_fraction, take_rows=0)
    smaller(monkeypatch, quantiles.exact_percentiles, sortable=100)
    smaller(monkeypatch, quantiles.nth_value, sortable=100)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = entry.queries()[name](spark, sf_dir)
        assert same(got, entry.oracle_sql()[name], sf_dir) is None
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
