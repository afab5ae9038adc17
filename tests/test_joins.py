"""Joins of skewed facts: the broadcast and the spread form give the same rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers import rows
from revmill.operators import joins


def skewed(spark):
    """A third of the rows on one key, another part without a key."""
    return spark.range(6000).selectExpr(
        "id AS seq",
        "CASE WHEN id % 3 = 0 THEN 1 WHEN id % 10 = 1 THEN NULL ELSE id % 200 END AS account_id",
        "CAST(id % 7 AS INT) AS channel_id",
        "id * 2 AS customer_id",
    )


def dimension(spark):
    return spark.range(150).selectExpr("id AS account_id", "concat('name ', id) AS name")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("spread_by", [None, ["seq"]])
def test_lookup(spark, how, spread_by):
    facts, dim = skewed(spark), dimension(spark)
    plain = facts.join(dim, "account_id", how)
    if how in ("left_semi", "left_anti"):
        plain = plain.select(facts.columns)
    want = rows(plain)
    assert rows(joins.lookup(facts, dim, "account_id", how)) == want
    for task_rows in (None, joins.TASK_ROWS, 100):
        got = joins.lookup(facts, dim, "account_id", how, spread_by, 0, task_rows)
        assert got.columns == plain.columns
        assert rows(got) == want


def test_hot_keys_are_spread_by_their_size(spark):
    facts = skewed(spark)
    assert joins.hot_keys(facts, "account_id") is None
    assert joins.hot_keys(facts.where("false"), "account_id", 1) is None
    # 2,000 of the 6,000 rows and the few of key 1 elsewhere.
    ((key, salts),) = rows(joins.hot_keys(facts, "account_id", 100))
    assert key == 1 and 20 <= salts <= 21


def test_a_hot_key_is_spread_over_tasks(spark):
    facts, dim = skewed(spark), dimension(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = joins.lookup(facts, dim, "account_id", max_broadcast=0, task_rows=100)
        got = got.where("account_id = 1")
        plain = facts.join(dim, "account_id").where("account_id = 1")
        used = "spark_partition_id() AS task"
        assert got.selectExpr(used).distinct().count() > 1
        assert plain.selectExpr(used).distinct().count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("bound", [joins.BROADCAST_BYTES, 0])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_dimension_with_facts(spark, how, bound):
    facts, dim = skewed(spark).select("account_id", "seq"), dimension(spark)
    more = dim.unionByName(
        spark.createDataFrame([(5000, "no facts")], "account_id bigint, name string")
    )
    want = rows(more.join(facts, "account_id", how))
    assert rows(joins.with_facts(more, facts, "account_id", how, max_broadcast=bound)) == want


@pytest.mark.parametrize("bound", [joins.BROADCAST_BYTES, 0])
def test_where_in_with_repeated_keys(spark, bound):
    facts = skewed(spark)
    keys = spark.createDataFrame([(1,), (1,), (2,), (None,)], "account_id bigint")
    got = joins.where_in(facts, keys, "account_id", max_broadcast=bound)
    assert rows(got) == rows(facts.where("account_id IN (1, 2)"))


@pytest.mark.parametrize("bound", [joins.BROADCAST_BYTES, 0])
def test_resolved_and_rejected_rows_are_all_rows(spark, bound):
    facts = skewed(spark)
    who = spark.range(150).selectExpr("id AS account_id", "id + 1000 AS customer_id")
    channels = spark.createDataFrame([(i,) for i in range(5)], "channel_id int")
    kept = joins.resolve_keys(facts, who, channels, ["seq"], bound)
    left = joins.rejects(facts, who, channels, ["seq"], bound)
    assert kept.where("customer_id <> account_id + 1000").count() == 0
    kept_ids = [r.seq for r in kept.collect()]
    left_ids = [r.seq for r in left.collect()]
    assert sorted(kept_ids + left_ids) == list(range(6000))
    assert left.columns == [*facts.columns, "reason"]


def test_measured_bytes_grow_with_rows_and_text(spark):
    small = dimension(spark)
    large = small.selectExpr("account_id", "repeat(name, 9) AS name")
    assert 150 * 40 < joins.measured_bytes(small) < joins.measured_bytes(large)
    assert joins.measured_bytes(small.where("false")) == 0
    assert joins.fits(small) and not joins.fits(small, 100)


@pytest.mark.parametrize("how", ["left", "left_anti", "inner", "left_semi"])
def test_rows_without_a_key_are_spread(spark, how):
    facts = spark.range(20_000).selectExpr("CASE WHEN id % 10 = 0 THEN id END AS k", "id AS v")
    dim = spark.range(0, 20_000, 20).selectExpr("id AS k", "id AS name")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = joins.lookup(facts, dim, "k", how, spread_by=["v"], max_broadcast=0)
        assert rows(got) == rows(facts.join(dim, "k", how))
        if how.startswith("left_a") or how == "left":
            sizes = [r[1] for r in got.groupBy(F.spark_partition_id()).count().collect()]
            assert max(sizes) < 2 * sum(sizes) / len(sizes) and len(sizes) == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
