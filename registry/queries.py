"""One runnable query per operator, over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, IntegerType

from revmill import model, plans
from revmill.functions import dates
from revmill.operators import (
    aggregates,
    contracts,
    joins,
    keys,
    profile,
    quantiles,
    ranking,
    series,
)
from revmill.plans import load, metrics, monthly, prices, questions, statistics
from revmill.session import scratch, size_shuffles
from revmill.sources import dims, files, sinks, star, synthetic

# The reference dates of the test tables.
AS_OF = "2001-07-15"
AS_OF_CLOCK = datetime(2001, 7, 1, 9, 0)
AS_OF_EXACT = "2001-08-01"
AS_OF_EVENTS = "2024-01-31"
AS_OF_EARLIER = "2001-04-15"
RUN_TIME = datetime(2001, 7, 15, 9, 0)
EARLIER_TIME = datetime(2001, 4, 15, 9, 0)
SEED = 42

# What is summed of each table of the monthly run: ids or counts, and amounts.
MONTHLY_SUMS = {
    "customers": ("customer_id", "length(customer_name) + length(segment) + length(industry)"),
    "channels": ("channel_id", "unit_price_eur"),
    "traffic": ("traffic_id", "revenue_eur"),
    "traffic_rejects": ("seq", "revenue_eur"),
    "customers_revenue_by_period": (
        "customer_id",
        "revenue_ytd + revenue_last_quarter + revenue_last_month",
    ),
    "business_analytics/industry_exposure": ("customer_count", "total_revenue"),
    "business_analytics/segment_analysis": ("client_count", "percentage_share"),
    "business_analytics/recent_customers": ("customer_id", "customer_id"),
    "business_analytics/top_customers": ("customer_id", "total_revenue"),
    "business_analytics/monthly_active_customers": ("customer_id", "total_revenue"),
    "descriptive_statistics/column_statistics": ("count_total", "max_value + min_value"),
    "descriptive_statistics/industry_exposure_extended": ("customer_count", "total_revenue"),
}

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Output types that compare across engines: counts and ids as bigint, decimals as
    double, dates as ISO text."""
    target = {DecimalType: "double", DateType: "string", IntegerType: "bigint"}
    return df.select(
        *[
            F.col(f"`{f.name}`").cast(target.get(type(f.dataType), f.dataType)).alias(f.name)
            for f in df.schema
        ]
    )


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        size_shuffles(spark, sf_dir)
        return plain(build(spark, sf_dir))

    run.__name__, run.__doc__ = build.__name__, build.__doc__
    QUERIES[build.__name__] = run
    return build


# Sources


@query
def csv_scan(spark, sf_dir):
    """Columns in another order, and one more than asked for."""
    path = scratch(spark, "csv")
    traffic = star.traffic(spark, sf_dir).withColumn("note", F.lit("none"))
    sinks.write_csv(traffic.select(*sorted(traffic.columns)), path)
    return files.read_csv(spark, path, model.TRAFFIC)


@query
def typed_cast(spark, sf_dir):
    orders = star.table(spark, sf_dir, "orders")
    text = orders.select(
        F.col("o_orderkey").cast("string").alias("traffic_id"),
        F.col("o_orderdate").cast("date").cast("string").alias("send_date"),
        F.col("o_totalprice").cast("decimal(12,2)").cast("string").alias("revenue_eur"),
        # "5-LOW" is not a number.
        F.col("o_orderpriority").alias("channel_id"),
    )
    return files.typed(text, model.TRAFFIC).select(
        "traffic_id", "send_date", "revenue_eur", F.col("channel_id").isNull().alias("bad_channel")
    )


@query
def table_scan(spark, sf_dir):
    return files.read_table(spark, f"{sf_dir.rstrip('/')}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"
    )


@query
def daily_series_flatten(spark, sf_dir):
    return prices.daily_prices(star.event_prices(spark, sf_dir))


@query
def daily_series_from(spark, sf_dir):
    return prices.daily_prices(star.event_prices(spark, sf_dir), "2024-01-15")


@query
def channel_dim(spark, sf_dir):
    sent = (
        star.traffic(spark, sf_dir)
        .groupBy("channel_id")
        .agg(F.count("*").alias("sends"), F.sum("interactions_count").alias("interactions"))
    )
    interactions = F.coalesce("interactions", F.lit(0))
    return (
        dims.channels(spark)
        .join(sent, "channel_id", "left")
        .select(
            "channel_id",
            "channel_name",
            "channel_type",
            "unit_price_eur",
            F.coalesce("sends", F.lit(0)).alias("sends"),
            (interactions * F.col("unit_price_eur")).alias("list_value"),
        )
    )


@query
def synth_customers(spark, sf_dir):
    ids = star.table(spark, sf_dir, "customer").select("c_custkey")
    return synthetic.synth_customers(ids, "c_custkey", AS_OF, SEED)


@query
def synth_traffic(spark, sf_dir):
    days = star.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date")).distinct()
    n = star.table(spark, sf_dir, "customer").count()
    return synthetic.synth_traffic(days, "o_orderdate", n, SEED)


@query
def date_spine(spark, sf_dir):
    sent = star.traffic(spark, sf_dir).select("send_date", "revenue_eur")
    extent = sent.agg(F.min("send_date").alias("first"), F.max("send_date").alias("last"))
    spine = dims.date_spine(extent, "first", "last", "send_date")
    daily = aggregates.total_by(sent, "send_date", "revenue_eur", "revenue")
    return spine.join(daily, "send_date", "left").select(
        "send_date", F.coalesce("revenue", F.lit(0).cast("decimal(12,2)")).alias("revenue")
    )


def _sql(spark, name, views, params=None):
    return files.run_sql_file(spark, Path(plans.__file__).parent / "sql" / name, views, params)


def _star_views(spark, sf_dir):
    return {"customers": star.customers(spark, sf_dir), "traffic": star.traffic(spark, sf_dir)}


@query
def sql_file_question(spark, sf_dir):
    return _sql(spark, "industry_exposure.sql", _star_views(spark, sf_dir), {"min_customers": 1})


@query
def sql_segment_share(spark, sf_dir):
    return _sql(spark, "segment_share.sql", {"customers": star.customers(spark, sf_dir)})


@query
def sql_segment_changes(spark, sf_dir):
    """By account, as customers of different segments share one."""
    raw = {"customers": star.raw_customers(spark, sf_dir), "traffic": star.raw_traffic(spark, sf_dir)}
    views = {
        name: df.drop("customer_id").withColumnRenamed("account_id", "customer_id")
        for name, df in raw.items()
    }
    changed = _sql(spark, "segment_changes.sql", views, {"as_of": AS_OF, "months": 12})
    return changed.withColumnRenamed("customer_id", "account_id")


@query
def sql_top_customers(spark, sf_dir):
    return _sql(spark, "top_customers.sql", _star_views(spark, sf_dir), {"top": 20})


@query
def sql_always_active_top(spark, sf_dir):
    """Industries in place of customers, as these are densely active."""
    owners = star.customers(spark, sf_dir).select("customer_id", "industry")
    sent = joins.lookup(star.traffic(spark, sf_dir), owners, "customer_id")
    views = {
        "customers": owners.select(F.col("industry").alias("customer_id")).distinct(),
        "traffic": sent.drop("customer_id").withColumnRenamed("industry", "customer_id"),
    }
    params = {"fraction": "0.1", "as_of": AS_OF, "months": 12}
    top = _sql(spark, "always_active_top.sql", views, params)
    return top.withColumnRenamed("customer_id", "industry")


@query
def sql_star_tables(spark, sf_dir):
    """Catalog tables from SQL text, made once though asked for twice; rows without
    interactions leave that column to its default."""
    path = scratch(spark, "catalog")
    schema = path.rpartition("/")[2].replace("-", "_")
    for _ in range(2):
        _sql(spark, "star.sql", {}, {"schema": schema, "path": path})
    table = f"{schema}.traffic"
    traffic = star.traffic(spark, sf_dir)
    sinks.append_rows(traffic.where("interactions_count > 0"), table)
    sinks.append_rows(traffic.where("interactions_count = 0").drop("interactions_count"), table)
    return files.read_table(spark, table)


# Sinks and tables


@query
def json_roundtrip(spark, sf_dir):
    path = scratch(spark, "json")
    sinks.write_json(star.traffic(spark, sf_dir), path)
    return spark.read.schema(model.TRAFFIC).json(path)


@query
def partitioned_sink(spark, sf_dir):
    panel = prices.daily_prices(star.order_prices(spark, sf_dir))
    path = scratch(spark, "prices")
    sinks.write_partitioned(panel, path, "company", "date")
    return spark.read.schema(panel.schema).option("header", True).csv(path)


@query
def replace_table(spark, sf_dir):
    path = scratch(spark, "replace")
    totals = aggregates.total_by(star.traffic(spark, sf_dir), "customer_id", "revenue_eur")
    sinks.replace_table(totals, path, RUN_TIME)
    written = sinks.replace_table(totals, path, RUN_TIME)
    return spark.read.parquet(path).select(
        "customer_id",
        "total_revenue",
        F.col("last_updated").cast("string").alias("last_updated"),
        F.lit(written).alias("rows_written"),
    )


@query
def upsert_traffic_batch(spark, sf_dir):
    raw = star.raw_traffic(spark, sf_dir).drop("traffic_id", "customer_id")
    return keys.last_wins(raw, ["send_date", "account_id", "channel_id"])


@query
def upsert_customers_batch(spark, sf_dir):
    return load.load_customers(star.raw_customers(spark, sf_dir))


@query
def upsert_channels_batch(spark, sf_dir):
    return load.load_channels(star.channel_feed(spark, sf_dir))


@query
def upsert_period_metrics(spark, sf_dir):
    """Metrics of all customers at an earlier date, then those of recent traffic over them."""
    traffic = star.traffic(spark, sf_dir)
    path = scratch(spark, "periods")
    earlier = metrics.revenue_by_period(traffic, AS_OF_EARLIER)
    sinks.upsert(path, earlier, ["customer_id"], EARLIER_TIME)
    recent = dates.since(traffic, "send_date", AS_OF, 6)
    sinks.upsert(path, metrics.revenue_by_period(recent, AS_OF), ["customer_id"], RUN_TIME)
    updated = F.col("last_updated").cast("string")
    return spark.read.parquet(path).withColumn("last_updated", updated)


@query
def surrogate_keys(spark, sf_dir):
    return keys.first_seen_key(
        star.raw_customers(spark, sf_dir), ["account_id"], name="customer_id"
    )


@query
def ensure_table(spark, sf_dir):
    """Made once, filled, and left alone when asked for again."""
    path = scratch(spark, "ensure")
    sinks.ensure_table(spark, path, model.TRAFFIC)
    star.traffic(spark, sf_dir).write.mode("append").parquet(path)
    return sinks.ensure_table(spark, path, model.TRAFFIC)


@query
def describe_table(spark, sf_dir):
    return sinks.describe_table(star.table(spark, sf_dir, "lineitem"))


# Filters and periods


@query
def last_12_months(spark, sf_dir):
    traffic = star.traffic(spark, sf_dir)
    return dates.since(traffic, "send_date", AS_OF).select(
        "traffic_id", "customer_id", "send_date", "revenue_eur"
    )


@query
def period_flags(spark, sf_dir):
    traffic = star.traffic(spark, sf_dir).select("traffic_id", "send_date")
    return dates.period_flags(traffic, "send_date", AS_OF)


@query
def period_bounds(spark, sf_dir):
    """Bounds around every date with traffic."""
    days = star.traffic(spark, sf_dir).select("send_date").distinct()
    return days.withColumns(dates.period_bounds(F.col("send_date")))


@query
def numeric_columns(spark, sf_dir):
    """Numeric columns that are no ids."""
    events = star.table(spark, sf_dir, "events")
    names = profile.numeric_columns(events.schema)
    return sinks.describe_table(events.select(*names)).select(
        "column_name", "data_type", "null_count"
    )


@query
def series_head(spark, sf_dir):
    return ranking.head(prices.daily_prices(star.event_prices(spark, sf_dir)), ["company", "date"])


# Joins


@query
def customers_with_traffic(spark, sf_dir):
    customers = star.customers(spark, sf_dir).select("customer_id", "industry")
    traffic = star.traffic(spark, sf_dir).select("customer_id", "send_date", "revenue_eur")
    recent = dates.since(traffic, "send_date", AS_OF)
    return joins.with_facts(customers, recent, "customer_id", "left")


@query
def traffic_of_changed(spark, sf_dir):
    """All traffic of the customers that were reached by several channels lately."""
    traffic = star.traffic(spark, sf_dir).select(
        "traffic_id", "customer_id", "send_date", "channel_id", "revenue_eur"
    )
    changed = questions.segment_changes_history(
        traffic, AS_OF, value="channel_id", date_col="send_date"
    )
    return joins.where_in(traffic, changed, "customer_id")


@query
def resolve_traffic_keys(spark, sf_dir):
    return joins.resolve_keys(
        star.raw_traffic(spark, sf_dir),
        load.load_customers(star.raw_customers(spark, sf_dir)),
        star.raw_channels(spark, sf_dir),
        ["seq"],
    ).select("seq", "account_id", "customer_id", "channel_id", "revenue_eur")


@query
def traffic_rejects(spark, sf_dir):
    return joins.rejects(
        star.raw_traffic(spark, sf_dir),
        load.load_customers(star.raw_customers(spark, sf_dir)),
        star.raw_channels(spark, sf_dir),
        ["seq"],
    ).select("seq", "account_id", "channel_id", "revenue_eur", "reason")


# Aggregates and ranking


@query
def quartiles(spark, sf_dir):
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return quantiles.quartiles(star.table(spark, sf_dir, "lineitem"), columns, exact=True)


@query
def value_counts(spark, sf_dir):
    panel = series.union_series(
        prices.daily_prices(star.event_prices(spark, sf_dir)),
        prices.daily_prices(star.order_prices(spark, sf_dir)),
    )
    return aggregates.value_counts(panel, "company", "row_count")


@query
def series_extent(spark, sf_dir):
    panel = prices.daily_prices(star.order_prices(spark, sf_dir))
    return aggregates.series_extent(panel, "company", "date")


@query
def row_counts(spark, sf_dir):
    names = ["customer", "orders", "lineitem", "events"]
    return aggregates.row_counts({n: star.table(spark, sf_dir, n) for n in names})


@query
def top_fraction(spark, sf_dir):
    totals = aggregates.total_by(star.traffic(spark, sf_dir), "customer_id", "revenue_eur")
    customers = star.customers(spark, sf_dir)
    return ranking.top_fraction(totals, "total_revenue", 0.1, "customer_id", customers)


@query
def date_and_math_functions(spark, sf_dir):
    date = F.col("o_orderdate").cast("date")
    price = F.col("o_totalprice").cast("decimal(12,2)")
    return star.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.trunc(date, "MM").alias("month_start"),
        F.trunc(date, "QUARTER").alias("quarter_start"),
        F.trunc(date, "YEAR").alias("year_start"),
        F.quarter(date).alias("quarter_number"),
        F.add_months(date, -12).alias("year_before"),
        F.date_sub(date, 30).alias("days_before"),
        F.date_format(date, "yyyy-MM").alias("month_text"),
        F.ceil(price * F.lit("0.1").cast("decimal(2,1)")).cast("bigint").alias("tenth_up"),
        F.round(price * F.lit("0.125").cast("decimal(4,3)"), 2).alias("eighth"),
        F.when(F.col("o_orderpriority").try_cast("int").isNull(), "text")
        .otherwise("number")
        .alias("priority_kind"),
    )


# Series


@query
def series_union(spark, sf_dir):
    return series.union_series(
        prices.daily_prices(star.event_prices(spark, sf_dir)),
        prices.daily_prices(star.order_prices(spark, sf_dir)),
    )


@query
def price_panel(spark, sf_dir):
    return prices.price_panel(
        star.event_prices(spark, sf_dir), star.order_prices(spark, sf_dir), start="1998-01-01"
    )


# Contracts


@query
def contract_unique(spark, sf_dir):
    return contracts.check_unique(
        star.traffic(spark, sf_dir), ["send_date", "account_id", "customer_id", "channel_id"]
    )


@query
def contract_fk(spark, sf_dir):
    accounts = star.raw_customers(spark, sf_dir)
    return contracts.check_fk(star.raw_traffic(spark, sf_dir), accounts, "account_id")


@query
def contract_range(spark, sf_dir):
    traffic = star.traffic(spark, sf_dir)
    facts = contracts.check_rules(
        traffic, contracts.not_negative("interactions_count", "revenue_eur")
    )
    balances = star.table(spark, sf_dir, "customer")
    return facts.unionByName(
        contracts.check_rules(balances, contracts.not_negative("c_acctbal"))
    )


@query
def contract_not_null(spark, sf_dir):
    traffic = star.traffic(spark, sf_dir)
    recent = dates.since(traffic.select("customer_id", "send_date"), "send_date", AS_OF)
    last = recent.groupBy("customer_id").agg(F.max("send_date").alias("last_date"))
    seen = star.customers(spark, sf_dir).join(last, "customer_id", "left")
    rules = model.no_nulls(model.CUSTOMERS) | {
        "last_date is not null": F.col("last_date").isNotNull()
    }
    return contracts.check_rules(seen, rules)


@query
def contract_fit(spark, sf_dir):
    periods = metrics.revenue_by_period(star.traffic(spark, sf_dir), AS_OF)
    fits = contracts.check_fit(periods, model.FIT_LIMITS["revenue_by_period"])
    names = contracts.check_fit(
        star.customers(spark, sf_dir), model.FIT_LIMITS["customers"] | {"segment": 8}
    )
    return fits.unionByName(names)


@query
def apply_defaults(spark, sf_dir):
    lines = (
        star.table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.count("*").alias("interactions_count"))
    )
    orders = star.table(spark, sf_dir, "orders").select("o_orderkey")
    filled = orders.join(lines, "o_orderkey", "left")
    return contracts.apply_defaults(filled, model.TRAFFIC_DEFAULTS)


# Questions


@query
def q1_industry_exposure(spark, sf_dir):
    return questions.industry_exposure(star.customers(spark, sf_dir), star.traffic(spark, sf_dir))


@query
def q2_segment_share(spark, sf_dir):
    return questions.segment_share(star.customers(spark, sf_dir))


@query
def q3_segment_changes(spark, sf_dir):
    """By account, as customers of different segments share one."""
    return questions.segment_changes(
        star.raw_customers(spark, sf_dir),
        star.raw_traffic(spark, sf_dir),
        AS_OF,
        entity="account_id",
    )


@query
def q3_segment_changes_history(spark, sf_dir):
    """The channel a customer is reached by, as the value that changes over time."""
    return questions.segment_changes_history(
        star.traffic(spark, sf_dir), AS_OF, value="channel_id", date_col="send_date"
    )


@query
def q4_top_customers(spark, sf_dir):
    return questions.top_customers(star.customers(spark, sf_dir), star.traffic(spark, sf_dir))


@query
def q5_months_active(spark, sf_dir):
    traffic = star.traffic(spark, sf_dir)
    return aggregates.periods_active(
        traffic, "customer_id", "send_date", AS_OF, name="months_with_activity"
    )


@query
def q5_always_active_top(spark, sf_dir):
    return _industries_always_active(spark, sf_dir, AS_OF_EXACT, "exact")


@query
def q5_whole_periods(spark, sf_dir):
    return _industries_always_active(spark, sf_dir, AS_OF, "whole_periods")


def _industries_always_active(spark, sf_dir, as_of, mode):
    """Industries, a few and densely active, by the traffic of their customers."""
    customers = star.customers(spark, sf_dir).select("customer_id", "industry")
    measured = questions.dimension_activity(
        customers, star.traffic(spark, sf_dir), as_of, entity="industry", mode=mode
    )
    return questions.top_active(customers.select("industry").distinct(), measured, 0.1, "industry")


@query
def q5_active_users(spark, sf_dir):
    """The same by day: users with events on each of the seven days before."""
    activity = star.user_activity(spark, sf_dir)
    users = activity.select("customer_id").distinct()
    return questions.always_active_top(users, activity, AS_OF_EVENTS, n=7, grain="day")


# Metrics, statistics, load and the whole run


@query
def revenue_by_period(spark, sf_dir):
    return metrics.revenue_by_period(star.traffic(spark, sf_dir), AS_OF)


@query
def revenue_by_period_clock(spark, sf_dir):
    """On the first of a month at nine: rows of that day still belong to the month before."""
    return metrics.revenue_by_period(
        star.traffic(spark, sf_dir), AS_OF_CLOCK, boundary="timestamp"
    )


@query
def freshness(spark, sf_dir):
    orders = metrics.freshness(star.table(spark, sf_dir, "orders"), "o_orderdate", AS_OF)
    events = metrics.freshness(star.table(spark, sf_dir, "events"), "ts", "2024-02-10")
    return orders.withColumn("table_name", F.lit("orders")).unionByName(
        events.withColumn("table_name", F.lit("events"))
    )


@query
def column_statistics(spark, sf_dir):
    lineitem = star.table(spark, sf_dir, "lineitem")
    return statistics.column_statistics(lineitem, "lineitem", exact=True)


@query
def column_statistics_exposure(spark, sf_dir):
    """Double and int columns only, so the decimal revenue is left out."""
    exposure = questions.industry_exposure(
        star.customers(spark, sf_dir), star.traffic(spark, sf_dir)
    ).withColumn("customer_count", F.col("customer_count").cast("int"))
    return statistics.column_statistics(exposure, "industry_exposure", "double_int")


@query
def industry_categories(spark, sf_dir):
    exposure = questions.industry_exposure(
        star.customers(spark, sf_dir), star.traffic(spark, sf_dir)
    )
    return statistics.industry_categories(exposure)


@query
def load_star(spark, sf_dir):
    return load.load_star(
        star.raw_customers(spark, sf_dir),
        star.raw_channels(spark, sf_dir),
        star.raw_traffic(spark, sf_dir),
    ).traffic


@query
def monthly_run(spark, sf_dir):
    """Raw files from the tables, then every step; of each table written the rows, the sum of
    its ids or counts, and the sum of its amounts."""
    in_dir, out_dir = scratch(spark, "raw"), scratch(spark, "run")
    raw = {
        "customers": (star.raw_customers(spark, sf_dir), model.CUSTOMERS),
        "channels": (star.raw_channels(spark, sf_dir), model.CHANNELS),
        "traffic": (star.raw_traffic(spark, sf_dir), model.TRAFFIC),
    }
    for name, (df, schema) in raw.items():
        sinks.write_csv(df.select(*schema.names), f"{in_dir}/{name}.csv")
    counts = monthly.monthly_run(spark, in_dir, out_dir, RUN_TIME, fill_defaults=True)
    sums = [
        monthly.read(spark, out_dir, name).agg(
            F.lit(name).alias("table_name"),
            F.coalesce(F.sum(F.expr(ids)), F.lit(0)).cast("bigint").alias("ids"),
            F.round(F.coalesce(F.sum(F.expr(amount)), F.lit(0)).cast("double"), 2).alias("amount"),
        )
        for name, (ids, amount) in MONTHLY_SUMS.items()
    ]
    return counts.join(reduce(DataFrame.unionAll, sums), "table_name")
