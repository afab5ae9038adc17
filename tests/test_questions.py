from __future__ import annotations

from decimal import Decimal

import pytest

from helpers import customers, d, rows, traffic
from revmill.operators import aggregates, ranking
from revmill.plans import questions


def test_an_industry_without_traffic_has_zero_or_null_revenue(spark):
    who = customers(spark, [(1, "A", "Energy"), (2, "A", "Media"), (3, "A", "Media")])
    sent = traffic(spark, [("2024-01-01", 1, 5), ("2024-01-02", 1, 6)])
    got = [tuple(r) for r in questions.industry_exposure(who, sent).collect()]
    assert got == [("Energy", Decimal("11.00"), 1), ("Media", Decimal("0.00"), 2)]
    nulls = [tuple(r) for r in questions.industry_exposure(who, sent, keep_nulls=True).collect()]
    assert nulls == [("Media", None, 2), ("Energy", Decimal("11.00"), 1)]


def test_shares_are_rounded_and_add_up(spark):
    who = customers(spark, [(i, "ABC"[i % 3], "x") for i in range(7)])
    got = {r.segment: r for r in questions.segment_share(who).collect()}
    assert [got[s].client_count for s in "ABC"] == [3, 2, 2]
    assert [got[s].percentage_share for s in "ABC"] == [
        Decimal("42.86"),
        Decimal("28.57"),
        Decimal("28.57"),
    ]


def test_share_of_total_counts_distinct_ids(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k string, id int")
    assert {tuple(r)[:2] for r in aggregates.share_of_total(df, "k", "id").collect()} == {
        ("a", 1),
        ("b", 1),
    }


def test_one_segment_per_key_means_no_changes(spark):
    who = customers(spark, [(1, "A", "x"), (2, "B", "x")])
    sent = traffic(spark, [("2024-01-01", 1, 5), ("2024-01-02", 2, 6)])
    assert questions.segment_changes(who, sent, "2024-02-01").count() == 0


def test_changes_show_when_the_dimension_repeats_a_key_and_traffic_is_recent(spark):
    who = customers(spark, [(1, "A", "x"), (1, "B", "x"), (2, "A", "x"), (2, "B", "x")])
    sent = traffic(spark, [("2024-01-01", 1, 5), ("2024-01-03", 1, 5), ("2020-01-02", 2, 6)])
    assert rows(questions.segment_changes(who, sent, "2024-02-01")) == [(1,)]


def test_changes_in_a_log(spark):
    log = spark.createDataFrame(
        [
            (1, "A", d("2023-02-01")),
            (1, "B", d("2024-01-01")),
            (2, "A", d("2022-01-01")),
            (2, "B", d("2024-01-01")),
            (3, "A", d("2024-01-01")),
            (3, "A", d("2024-01-02")),
        ],
        "customer_id bigint, segment string, changed_on date",
    )
    assert rows(questions.segment_changes_history(log, "2024-02-01")) == [(1,)]


def test_ties_at_the_limit_go_to_the_smaller_id(spark):
    who = customers(spark, [(i, "A", "x") for i in (1, 2, 3)])
    sent = traffic(spark, [("2024-01-01", 3, 5), ("2024-01-01", 2, 5), ("2024-01-01", 1, 9)])
    got = [r.customer_id for r in questions.top_customers(who, sent, 2).collect()]
    assert got == [1, 2]


def test_unknown_customers_are_not_ranked(spark):
    who = customers(spark, [(1, "A", "x")])
    sent = traffic(spark, [("2024-01-01", 1, 5), ("2024-01-01", 9, 500)])
    assert [r.customer_id for r in questions.top_customers(who, sent).collect()] == [1]


def monthly(spark, customer, first, months):
    year, month = map(int, first.split("-"))
    at = [(year + (month - 1 + i) // 12, (month - 1 + i) % 12 + 1) for i in range(months)]
    return [(f"{y}-{m:02d}-20", customer, 10) for y, m in at]


def test_thirteen_months_fail_the_exact_count_and_pass_whole_periods(spark):
    # 2023-01-20 .. 2024-01-20, as of 2024-01-31: the window from 2023-01-31 holds 12 months;
    # as of 2024-01-15 it holds 13.
    sent = traffic(spark, monthly(spark, 1, "2023-01", 13))
    who = customers(spark, [(1, "A", "x")])

    def ids(as_of, mode):
        got = questions.always_active_top(who, sent, as_of, fraction=1, mode=mode)
        return [r.customer_id for r in got.collect()]

    assert ids("2024-01-15", "exact") == []
    assert ids("2024-01-31", "exact") == [1]
    assert ids("2024-01-15", "whole_periods") == [1]
    assert ids("2024-02-15", "whole_periods") == [1]
    assert ids("2024-03-15", "whole_periods") == []


def test_a_missing_month_fails(spark):
    sent = traffic(spark, [r for r in monthly(spark, 1, "2023-01", 12) if "-05-" not in r[0]])
    who = customers(spark, [(1, "A", "x")])
    got = questions.always_active_top(who, sent, "2024-01-01", fraction=1)
    assert got.count() == 0


@pytest.mark.parametrize("n, grain", [(7, "day"), (70, "day"), (3, "week"), (2, "quarter")])
def test_whole_periods_of_other_grains(spark, n, grain):
    days = spark.sql("SELECT explode(sequence(date'2023-01-01', date'2024-03-30')) AS send_date")
    sent = days.selectExpr("1L AS customer_id", "send_date", "1.0bd AS revenue_eur").unionByName(
        days.where("send_date <> date'2024-03-14' and quarter(send_date) <> 4").selectExpr(
            "2L AS customer_id", "send_date", "1.0bd AS revenue_eur"
        )
    )
    who = sent.select("customer_id").distinct()
    got = questions.always_active_top(who, sent, "2024-03-20", 1, n, grain)
    # Customer 2 misses one day, and all days of the last quarter of 2023.
    assert {r.customer_id for r in got.collect()} == ({1, 2} if n == 3 else {1})


def test_the_top_fraction_counts_customers_without_traffic(spark):
    who = customers(spark, [(i, "A", "x") for i in range(1, 22)])
    sent = traffic(spark, [(f"2024-01-{i:02d}", i, i) for i in range(1, 6)])
    totals = aggregates.total_by(sent, "customer_id", "revenue_eur")
    got = ranking.top_fraction(totals, "total_revenue", 0.1, "customer_id", who)
    assert {r.customer_id for r in got.collect()} == {5, 4, 3}


def test_fraction_is_exact_in_decimal(spark):
    # 0.1 * 30 is more than 3 in binary floating point.
    df = spark.range(30)
    assert ranking.fraction_count(df, "id", 0.1) == 3
    assert ranking.fraction_count(spark.range(31), "id", 0.1) == 4


@pytest.mark.parametrize("fraction", [0.01, 0.3, 0.5, 0.9, 1.0])
def test_large_top_fraction_equals_the_sorted_one(spark, fraction):
    # A third of the rows share one measure, and some have none.
    df = spark.range(3000).selectExpr(
        "id",
        "CASE WHEN id % 3 = 0 THEN 500 WHEN id % 50 = 1 THEN NULL "
        "ELSE pmod(hash(id), 1000) END AS m",
    )
    want = rows(ranking.top_fraction(df, "m", fraction, "id"))
    assert rows(ranking.top_fraction(df, "m", fraction, "id", take_rows=0)) == want


def test_large_top_fraction_with_text_keys(spark):
    df = spark.range(300).selectExpr("concat('k', id) AS k", "id % 3 AS m")
    want = rows(ranking.top_fraction(df, "m", 0.5, "k"))
    assert rows(ranking.top_fraction(df, "m", 0.5, "k", take_rows=0)) == want


def test_order_desc_places_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 5)], "id int, m int")
    assert [r.id for r in ranking.order_desc(df, "m", "id").collect()] == [1, 2, 3]
    assert [r.id for r in ranking.order_desc(df, "m", "id", nulls="last").collect()] == [2, 3, 1]


def test_sums_are_exact_and_overflow_raises(spark):
    row = ("1 AS k", "CAST(99999999999999.99 AS DECIMAL(16,2)) AS m")
    df = spark.range(3).selectExpr(*row)
    assert aggregates.total_by(df, "k", "m").first()[1] == Decimal("299999999999999.97")
    wide = df.selectExpr("k", "CAST(m AS DECIMAL(30,4)) AS m")
    assert aggregates.total_by(wide, "k", "m").first()[1] == Decimal("299999999999999.9700")
    many = spark.range(1_000_000).selectExpr(*row)
    with pytest.raises(Exception, match="OVERFLOW"):
        aggregates.total_by(many, "k", "m").collect()


@pytest.mark.parametrize("take_rows", [0, 50_000])
def test_rows_without_a_key_are_in_no_top_fraction(spark, take_rows):
    data = [(1, 10.0), (2, 10.0), (3, 5.0), (4, None), (None, 99.0), (None, 10.0)]
    df = spark.createDataFrame(data, "k int, m double")
    want = {0.25: [(1, 10.0)], 0.5: [(1, 10.0), (2, 10.0)], 0.75: [(1, 10.0), (2, 10.0), (3, 5.0)]}
    for fraction, expected in want.items():
        assert rows(ranking.top_fraction(df, "m", fraction, "k", take_rows=take_rows)) == expected
    everything = ranking.top_fraction(df, "m", 1.0, "k", take_rows=take_rows)
    assert everything.count() == 4


def test_top_one(spark):
    df = spark.createDataFrame([(1, 3.0), (2, 3.0), (3, None)], "k int, m double")
    assert rows(ranking.top_n(df, "m", 1, "k")) == [(1, 3.0)]


@pytest.mark.parametrize("mode, n", [("whole_periods", 3), ("whole_periods", 70), ("exact", 3)])
def test_activity_by_an_attribute_equals_the_joined_one(spark, mode, n):
    traffic = spark.range(4000).selectExpr(
        "id % 37 AS customer_id",
        "add_months(date'2024-07-15', -CAST(id % 90 AS INT)) AS send_date",
        "CAST(id AS DECIMAL(12,2)) AS revenue_eur",
    )
    customers = spark.range(30).selectExpr("id AS customer_id", "concat('i', id % 4) AS industry")
    got = questions.dimension_activity(customers, traffic, "2024-07-20", "industry", n, mode=mode)
    joined = traffic.join(customers, "customer_id")
    want = questions.entity_activity(joined, "2024-07-20", n, mode=mode, entity="industry")
    assert rows(got) == rows(want)
