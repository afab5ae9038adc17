from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import d, traffic
from revmill import model
from revmill.functions import dates
from revmill.plans import metrics


def bounds(spark, as_of, boundary="date"):
    row = spark.range(1).select(
        *[c.alias(n) for n, c in dates.period_bounds(as_of, boundary).items()]
    )
    return row.first().asDict()


def test_january_wraps_to_the_year_before(spark):
    at = bounds(spark, "2024-01-10")
    assert at["last_month_start"] == date(2023, 12, 1)
    assert at["last_quarter_start"] == at["prev_quarter_start"] == date(2023, 10, 1)
    assert at["mtd_start"] == at["ytd_start"] == at["current_quarter_start"] == date(2024, 1, 1)


@pytest.mark.parametrize(
    "as_of, quarter, before",
    [
        ("2024-03-31", date(2024, 1, 1), date(2023, 10, 1)),
        ("2024-04-01", date(2024, 4, 1), date(2024, 1, 1)),
        ("2024-12-31", date(2024, 10, 1), date(2024, 7, 1)),
    ],
)
def test_quarters(spark, as_of, quarter, before):
    at = bounds(spark, as_of)
    assert at["current_quarter_start"] == quarter
    assert at["last_quarter_start"] == before


def test_clock_boundaries_keep_the_time_of_day(spark):
    at = bounds(spark, datetime(2024, 3, 15, 9, 30), "timestamp")
    assert at["mtd_start"] == datetime(2024, 3, 1, 9, 30)
    assert at["last_month_start"] == datetime(2024, 2, 1, 9, 30)
    assert at["ytd_start"] == datetime(2024, 1, 1, 9, 30)


def one_customer(spark, days, as_of, **options):
    sent = traffic(spark, [(day, 1, money) for day, money in days])
    return metrics.revenue_by_period(sent, as_of, **options).first().asDict()


EDGES = [("2024-02-01", 1), ("2024-02-29", 10), ("2024-03-01", 100), ("2024-01-01", 1000)]


def test_first_of_month_belongs_to_its_month_at_midnight(spark):
    got = one_customer(spark, EDGES, "2024-03-01")
    assert got["revenue_mtd"] == 100
    assert got["revenue_last_month"] == 11
    assert got["revenue_ytd"] == 1111


def test_first_of_month_belongs_to_the_month_before_at_nine(spark):
    got = one_customer(spark, EDGES, datetime(2024, 3, 1, 9), boundary="timestamp")
    assert got["revenue_mtd"] == 0
    assert got["revenue_last_month"] == 110
    assert got["revenue_ytd"] == 111


def test_later_rows_count_unless_bounded(spark):
    days = [("2024-03-10", 5), ("2025-06-01", 7)]
    assert one_customer(spark, days, "2024-03-15")["revenue_mtd"] == 12
    assert one_customer(spark, days, "2024-03-15", until="2024-03-16")["revenue_mtd"] == 5


def test_growth_compares_the_running_with_the_whole_previous_quarter(spark):
    days = [("2024-01-02", 100), ("2024-03-31", 100), ("2024-04-01", 250)]
    got = one_customer(spark, days, "2024-04-02")
    assert got["revenue_increase_pct_qoq"] == Decimal("25.00")
    assert got["revenue_last_quarter"] == 200


def test_growth_without_a_base_is_zero(spark):
    got = one_customer(spark, [("2024-04-01", 250)], "2024-04-02")
    assert got["revenue_increase_pct_qoq"] == 0


def test_growth_rounds_half_up(spark):
    # 0.125 % and -0.125 %
    up = one_customer(spark, [("2024-01-02", 800), ("2024-04-01", 801)], "2024-04-02")
    down = one_customer(spark, [("2024-01-02", 800), ("2024-04-01", 799)], "2024-04-02")
    assert up["revenue_increase_pct_qoq"] == Decimal("0.13")
    assert down["revenue_increase_pct_qoq"] == Decimal("-0.13")


def test_growth_beyond_1000_percent_is_kept(spark):
    got = one_customer(spark, [("2024-01-02", 1), ("2024-04-01", 100)], "2024-04-02")
    assert got["revenue_increase_pct_qoq"] == 9900


def test_growth_from_one_cent_to_the_largest_amount(spark):
    days = [("2024-01-02", "0.01"), ("2024-04-01", "9999999999.99")]
    got = one_customer(spark, days, "2024-04-02")
    assert got["revenue_increase_pct_qoq"] == Decimal("99999999999800.00")


def test_old_rows_only_give_zeros_and_no_key_no_row(spark):
    sent = traffic(spark, [("2020-01-01", 1, 5), ("2024-03-01", None, 9)])
    got = [r.asDict() for r in metrics.revenue_by_period(sent, "2024-03-15").collect()]
    assert [r["customer_id"] for r in got] == [1]
    assert got[0]["revenue_ytd"] == 0 and got[0]["revenue_last_month"] == 0


def test_last_quarter_is_the_sum_of_its_months(spark):
    days = [("2024-01-31", 1), ("2024-02-29", 2), ("2024-03-31", 4), ("2023-12-31", 8)]
    assert one_customer(spark, days, "2024-05-05")["revenue_last_quarter"] == 7


def test_flags_of_a_row_without_a_date_are_false(spark):
    df = spark.createDataFrame([(None,)], "send_date date")
    assert not any(dates.period_flags(df, "send_date", "2024-01-01").first()[1:])


def test_months_before_clamps_at_month_ends(spark):
    got = spark.range(1).select(dates.months_before("2023-03-31", 1)).first()[0]
    assert got == date(2023, 2, 28)


def test_cutoff_is_inclusive_and_open_at_the_top(spark):
    sent = traffic(spark, [("2023-03-14", 1, 1), ("2023-03-15", 2, 1), ("2030-01-01", 3, 1)])
    kept = dates.since(sent, "send_date", "2024-03-15")
    assert {r.customer_id for r in kept.collect()} == {2, 3}
    kept = dates.since(sent, "send_date", "2024-03-15", until="2024-03-15")
    assert {r.customer_id for r in kept.collect()} == {2}


@pytest.mark.parametrize(
    "grain, start, day, n",
    [
        ("day", "2024-01-24", "2024-01-30", 6),
        ("week", "2024-01-01", "2024-01-14", 1),
        ("month", "2023-11-01", "2024-02-29", 3),
        ("quarter", "2023-10-01", "2024-06-30", 2),
        ("year", "2020-01-01", "2024-12-31", 4),
    ],
)
def test_periods_between(spark, grain, start, day, n):
    first, at = F.lit(d(start)), F.lit(d(day))
    assert spark.range(1).select(dates.periods_between(first, at, grain)).first()[0] == n
    back = spark.range(1).select(dates.back(dates.truncate(at, grain), grain, n)).first()[0]
    assert back == d(start)


def test_freshness(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 3, 1),), (datetime(2024, 2, 29, 23, 59, 59),)], "at timestamp_ntz"
    )
    got = metrics.freshness(df, "at", "2024-03-31").first()
    assert got["updated_rows"] == 1 and got["success"]
    assert got["message"] == "Table updated this month with 1 records"
    stale = metrics.freshness(df, "at", "2024-05-01").first()
    assert not stale["success"] and stale["message"] == "No records updated this month"
    with pytest.raises(metrics.StaleError):
        metrics.freshness(df, "at", "2024-05-01", require=True)


def test_narrow_growth_column_overflows_as_in_the_row_store(spark):
    sent = traffic(spark, [("2024-01-02", 1, 1), ("2024-04-01", 1, 100)])
    periods = metrics.revenue_by_period(sent, "2024-04-02")
    narrow = model.FIT_LIMITS["revenue_by_period"]["revenue_increase_pct_qoq"]
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        periods.select(F.col("revenue_increase_pct_qoq").cast(narrow)).collect()
