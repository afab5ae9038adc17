"""The five business questions. Facts are summed per entity before they meet the
dimension, so joins see one row per entity however many facts it has."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..operators import aggregates, joins, ranking

# A period mask is a 64-bit number with one bit per period.
MASK_BITS = 62


def industry_exposure(
    customers: DataFrame, traffic: DataFrame, keep_nulls: bool = False
) -> DataFrame:
    """Revenue and number of customers per industry, highest revenue first. An industry
    without traffic has revenue 0, or NULL and the first place with ``keep_nulls``.
    customer_id is the key of customers, so counting rows counts customers."""
    totals = aggregates.total_by(traffic, "customer_id", "revenue_eur", "revenue")
    revenue = F.sum("revenue")
    if not keep_nulls:
        revenue = F.coalesce(revenue, F.lit(0).cast("decimal(12,2)"))
    exposure = (
        customers.select("customer_id", "industry")
        .join(totals, "customer_id", "left")
        .groupBy("industry")
        .agg(revenue.alias("total_revenue"), F.count("customer_id").alias("customer_count"))
    )
    return ranking.order_desc(exposure, "total_revenue", "industry")


def segment_share(customers: DataFrame) -> DataFrame:
    """Customers per segment and their share of all, in percent. customer_id is the key
    of customers."""
    shares = aggregates.share_of_total(
        customers, "segment", "customer_id", 2, "client_count", "percentage_share", unique=True
    )
    return ranking.order_desc(shares, "client_count", "segment")


def segment_changes(
    customers: DataFrame,
    traffic: DataFrame,
    as_of: dates.When,
    months: int = 12,
    month_partition: str | None = None,
    entity: str = "customer_id",
) -> DataFrame:
    """Customers (or another ``entity``) with two or more segments in the dimension and traffic since the cutoff.

    The dimension is asked first: its key allows one segment each, so normally nothing
    is left to look for, and the traffic is not read."""
    changed = (
        customers.groupBy(entity)
        .agg(F.count_distinct("segment").alias("segments"))
        .where("segments >= 2")
        .select(entity)
    )
    late = dates.since(traffic, "send_date", as_of, months, month_partition=month_partition)
    recent = late.select(entity).distinct()
    return joins.lookup(recent, changed, entity, "left_semi", task_rows=None)


def segment_changes_history(
    history: DataFrame,
    as_of: dates.When,
    months: int = 12,
    entity: str = "customer_id",
    value: str = "segment",
    date_col: str = "changed_on",
    at_least: int = 2,
) -> DataFrame:
    """Entities with ``at_least`` different values in the change log since the cutoff."""
    recent = dates.since(history, date_col, as_of, months)
    counted = aggregates.distinct_by(recent, entity, value, "value_count")
    return counted.where(F.col("value_count") >= at_least).select(entity)


def top_customers(
    customers: DataFrame, traffic: DataFrame, n: int = 20, entity: str = "customer_id"
) -> DataFrame:
    """The ``n`` known entities with the highest revenue."""
    totals = aggregates.total_by(traffic, entity, "revenue_eur")
    known = totals.join(customers.select(entity), entity, "left_semi")
    return ranking.top_n(known, "total_revenue", n, entity)


def always_active_top(
    customers: DataFrame,
    traffic: DataFrame,
    as_of: dates.When,
    fraction: float = 0.1,
    n: int = 12,
    grain: str = "month",
    mode: str = "whole_periods",
    entity: str = "customer_id",
) -> DataFrame:
    """The top ``fraction`` of entities by total revenue that had traffic in all ``n`` periods.

    ``whole_periods`` asks for every one of the ``n`` full periods before ``as_of``.
    ``exact`` counts distinct periods from ``n`` months before ``as_of`` on, without an
    upper bound, and wants exactly ``n``; its window can span more than ``n`` periods.
    The top fraction is taken of all entities, those without traffic included.
    """
    measured = entity_activity(traffic, as_of, n, grain, mode, entity)
    return top_active(customers, measured, fraction, entity)


def entity_activity(
    traffic: DataFrame,
    as_of: dates.When,
    n: int = 12,
    grain: str = "month",
    mode: str = "whole_periods",
    entity: str = "customer_id",
) -> DataFrame:
    """Total revenue per entity and whether it was active in all periods, in a single
    pass over the traffic."""
    date_col = F.col("send_date")
    if mode == "exact":
        if grain != "month":
            raise ValueError("the exact mode counts months")
        recent = F.when(date_col >= dates.months_before(as_of, n), F.trunc(date_col, "MM"))
        active = F.count_distinct(recent) == n
    elif mode == "whole_periods":
        active = _active_in_all(as_of, n, grain)
    else:
        raise ValueError("mode is 'whole_periods' or 'exact'")
    return traffic.groupBy(entity).agg(
        aggregates.money_sum(traffic, "revenue_eur").alias("total_revenue"),
        active.alias("active"),
    )


def dimension_activity(
    customers: DataFrame,
    traffic: DataFrame,
    as_of: dates.When,
    entity: str,
    n: int = 12,
    grain: str = "month",
    mode: str = "whole_periods",
    key: str = "customer_id",
) -> DataFrame:
    """The same for an attribute of the customers. Traffic is reduced to one row per customer
    before it meets the dimension: its total and a bit per period; where bits can't hold the
    periods, to one row per customer and period."""
    date_col, owners = F.col("send_date"), customers.select(key, entity)
    total = aggregates.money_sum(traffic, "revenue_eur").alias("revenue")
    if mode == "whole_periods" and n <= MASK_BITS:
        bits = F.bit_or(_period_bit(as_of, n, grain)).alias("periods")
        reduced = traffic.groupBy(key).agg(total, bits)
        active = F.coalesce(F.bit_count(F.bit_or("periods")) == n, F.lit(False))
    else:
        if mode == "exact":
            if grain != "month":
                raise ValueError("the exact mode counts months")
            period = F.when(date_col >= dates.months_before(as_of, n), F.trunc(date_col, "MM"))
        elif mode == "whole_periods":
            start, end = _whole_periods(as_of, n, grain)
            inside = (date_col >= start) & (date_col < end)
            period = F.when(inside, dates.truncate(date_col, grain))
        else:
            raise ValueError("mode is 'whole_periods' or 'exact'")
        reduced = traffic.groupBy(key, period.alias("period")).agg(total)
        active = F.count_distinct("period") == n
    # At most one row per customer and period, so no customer is heavy.
    known = joins.lookup(reduced, owners, key, task_rows=None)
    return known.groupBy(entity).agg(F.sum("revenue").alias("total_revenue"), active.alias("active"))


def top_active(
    customers: DataFrame, measured: DataFrame, fraction: float = 0.1, entity: str = "customer_id"
) -> DataFrame:
    """Of the top ``fraction`` of all known entities those that are active."""
    known = measured.join(customers.select(entity), entity, "left_semi")
    top = ranking.top_fraction(known, "total_revenue", fraction, entity, customers)
    kept = top.where("active").select(entity, "total_revenue")
    return ranking.order_desc(kept, "total_revenue", entity)


def _active_in_all(as_of: dates.When, n: int, grain: str):
    """Aggregate: a row in each of the ``n`` whole periods before ``as_of``. One bit per
    period combines before the shuffle; longer windows count distinct periods."""
    date_col = F.col("send_date")
    if n > MASK_BITS:
        start, end = _whole_periods(as_of, n, grain)
        inside = (date_col >= start) & (date_col < end)
        return F.count_distinct(F.when(inside, dates.truncate(date_col, grain))) == n
    return F.coalesce(F.bit_count(F.bit_or(_period_bit(as_of, n, grain))) == n, F.lit(False))


def _whole_periods(as_of: dates.When, n: int, grain: str):
    """First day of the ``n`` whole periods before ``as_of``, and the day after them."""
    end = dates.truncate(dates.day(as_of), grain)
    return dates.back(end, grain, n), end


def _period_bit(as_of: dates.When, n: int, grain: str):
    """A row's period among the ``n`` whole ones before ``as_of``, as one bit."""
    date_col = F.col("send_date")
    start, end = _whole_periods(as_of, n, grain)
    nth = dates.periods_between(start, date_col, grain)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), nth)
    return F.when((date_col >= start) & (date_col < end), bit)
