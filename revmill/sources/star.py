"""The star schema seen through order-processing tables: customers with their nation
and region, orders as traffic, order priorities as channels, events as price series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.series import SERIES_KEY
from ..session import file_system

# Fixed values of the raw loader input: customers that share an account, one in how many
# customers sends under an account that is unknown, and the channels known to the loader.
RAW_SHARED = 2
RAW_UNKNOWN = 8
RAW_CHANNELS = 4


_schemas: dict[tuple[str, int], StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stored table; its schema is looked up in the files once for each state of them."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    fs, location = file_system(spark, path)
    state = path, fs.getFileStatus(location).getModificationTime()
    if state not in _schemas:
        _schemas[state] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[state]).parquet(path)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation and region are small by their stored size, which Spark checks before it
    broadcasts them. The first order is joined on a grouped, unique key; a query that
    does not read created_date does not scan orders."""
    first_order = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.min("o_orderdate").cast("date").alias("created_date"))
    )
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    region = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return (
        table(spark, sf_dir, "customer")
        .join(nation.join(region, "n_regionkey"), "c_nationkey")
        .join(first_order, "c_custkey", "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_custkey").alias("account_id"),
            F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("segment"),
            F.col("n_name").alias("industry"),
            F.col("r_name").alias("country"),
            "created_date",
        )
    )


def _channel_id(priority: str = "o_orderpriority"):
    return F.substring(priority, 1, 1).cast("int")


def traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders, with their line counts as interactions; a query that does not read
    interactions_count does not scan lineitem."""
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.count("*").alias("lines"))
    )
    return (
        table(spark, sf_dir, "orders")
        .join(lines, "o_orderkey", "left")
        .select(
            F.col("o_orderkey").alias("traffic_id"),
            F.col("o_orderdate").cast("date").alias("send_date"),
            F.col("o_custkey").alias("account_id"),
            F.col("o_custkey").alias("customer_id"),
            _channel_id().alias("channel_id"),
            F.coalesce("lines", F.lit(0)).cast("int").alias("interactions_count"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("revenue_eur"),
        )
    )


def channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.substring("o_orderpriority", 3, 100)
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderpriority")
        .distinct()
        .select(
            _channel_id().alias("channel_id"),
            name.alias("channel_name"),
            name.alias("channel_type"),
            (_channel_id() * F.lit("0.01").cast("decimal(3,2)"))
            .cast("decimal(10,4)")
            .alias("unit_price_eur"),
        )
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers(spark, sf_dir).select(
        F.col("customer_id").alias("seq"),
        "customer_id",
        _raw_account().alias("account_id"),
        "customer_name",
        "segment",
        "industry",
        "country",
        "created_date",
    )


def _raw_account():
    return F.floor(F.col("customer_id") / RAW_SHARED).cast("bigint")


def raw_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic(spark, sf_dir).select(
        F.col("traffic_id").alias("seq"),
        "traffic_id",
        "send_date",
        F.when(F.col("customer_id") % RAW_UNKNOWN == 0, -F.col("customer_id"))
        .otherwise(_raw_account())
        .alias("account_id"),
        "customer_id",
        "channel_id",
        "interactions_count",
        "revenue_eur",
    )


def raw_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = channels(spark, sf_dir).where(F.col("channel_id") <= RAW_CHANNELS)
    return known.withColumn("seq", F.col("channel_id").cast("long"))


def channel_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A channel record with every order: many rows for few names, the price changing."""
    price = (F.col("o_orderkey") % 1000).cast("decimal(10,4)") / 10_000
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("seq"),
        F.substring("o_orderpriority", 3, 100).alias("channel_name"),
        F.col("o_orderstatus").alias("channel_type"),
        price.cast("decimal(10,4)").alias("unit_price_eur"),
    )


def user_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("customer_id"),
        F.col("ts").cast("date").alias("send_date"),
        F.col("value").cast("decimal(12,2)").alias("revenue_eur"),
    )


def _price_responses(values: DataFrame) -> DataFrame:
    """(company, date, at, nth, value) to one response text per company. Rows are first
    reduced to one per company and day; a text holds one entry per calendar day."""
    order = F.struct("at", "nth")
    text = [
        F.min_by("value", order).cast("string").alias("1. open"),
        F.max("value").cast("string").alias("2. high"),
        F.min("value").cast("string").alias("3. low"),
        F.max_by("value", order).cast("string").alias("4. close"),
        F.count("*").cast("string").alias("5. volume"),
    ]
    daily = values.groupBy("company", "date").agg(*text)
    fields = F.struct(*[f"`{c}`" for c in daily.columns if c not in ("company", "date")])
    entries = F.collect_list(F.struct(F.col("date").cast("string"), fields))
    series = daily.groupBy("company").agg(F.map_from_entries(entries).alias(SERIES_KEY))
    return series.select("company", F.to_json(F.struct(f"`{SERIES_KEY}`")).alias("response"))


def event_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A response text per event type, the event values as prices."""
    return _price_responses(
        table(spark, sf_dir, "events").select(
            F.col("event_type").alias("company"),
            F.col("ts").cast("date").alias("date"),
            F.col("ts").alias("at"),
            F.col("event_id").alias("nth"),
            "value",
        )
    )


def order_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A response text per order priority, the order values as prices."""
    return _price_responses(
        table(spark, sf_dir, "orders").select(
            F.col("o_orderpriority").alias("company"),
            F.col("o_orderdate").cast("date").alias("date"),
            F.col("o_orderdate").alias("at"),
            F.col("o_orderkey").alias("nth"),
            F.col("o_totalprice").alias("value"),
        )
    )
