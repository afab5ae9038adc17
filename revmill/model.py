"""Table schemas of the star, the result tables and the raw files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _table(*fields: tuple) -> StructType:
    """Fields as (name, type) for NOT NULL and (name, type, True) for nullable."""
    return StructType([StructField(n, t, bool(rest)) for n, t, *rest in fields])


MONEY = DecimalType(12, 2)
# Sums and statistics are wider than a row store's columns, as their size follows the data;
# FIT_LIMITS has the row store's ranges, for a report of what exceeds them.
TOTAL = DecimalType(22, 2)
STATISTIC = DecimalType(38, 4)

CUSTOMERS = _table(
    ("customer_id", LongType()),
    ("account_id", LongType()),
    ("customer_name", StringType()),
    ("segment", StringType()),
    ("industry", StringType()),
    ("country", StringType()),
    ("created_date", DateType()),
)
CHANNELS = _table(
    ("channel_id", IntegerType()),
    ("channel_name", StringType()),
    ("channel_type", StringType()),
    ("unit_price_eur", DecimalType(10, 4)),
)
TRAFFIC = _table(
    ("traffic_id", LongType()),
    ("send_date", DateType()),
    ("account_id", LongType()),
    ("customer_id", LongType()),
    ("channel_id", IntegerType()),
    ("interactions_count", IntegerType()),
    ("revenue_eur", MONEY),
)
REVENUE_BY_PERIOD = _table(
    ("customer_id", LongType()),
    ("revenue_last_month", TOTAL),
    ("revenue_last_quarter", TOTAL),
    ("revenue_mtd", TOTAL),
    ("revenue_ytd", TOTAL),
    # Wider than the 5 digits of the row store: growth of 1000 % and more occurs, and a
    # base of one cent must not end the run.
    ("revenue_increase_pct_qoq", DecimalType(18, 2), True),
    ("last_updated", TimestampType(), True),
)
INDUSTRY_EXPOSURE = _table(
    ("industry", StringType()),
    ("total_revenue", TOTAL),
    ("customer_count", LongType()),
    ("last_updated", TimestampType(), True),
)
SEGMENT_ANALYSIS = _table(
    ("segment", StringType()),
    ("client_count", LongType()),
    ("percentage_share", DecimalType(5, 2)),
    ("last_updated", TimestampType(), True),
)
RECENT_CUSTOMERS = _table(
    ("customer_id", LongType()),
    ("last_updated", TimestampType(), True),
)
CUSTOMER_TOTALS = _table(
    ("customer_id", LongType()),
    ("total_revenue", TOTAL),
    ("last_updated", TimestampType(), True),
)
COLUMN_STATISTICS = _table(
    ("table_name", StringType()),
    ("column_name", StringType()),
    ("min_value", STATISTIC, True),
    ("max_value", STATISTIC, True),
    ("mean_value", STATISTIC, True),
    ("median_value", STATISTIC, True),
    ("std_deviation", STATISTIC, True),
    ("count_non_null", LongType(), True),
    ("count_total", LongType(), True),
    ("last_updated", TimestampType(), True),
)
INDUSTRY_EXPOSURE_EXTENDED = _table(
    ("industry", StringType()),
    ("total_revenue", TOTAL),
    ("customer_count", LongType()),
    ("total_revenue_category", StringType()),
    ("customer_count_category", StringType()),
    ("last_updated", TimestampType(), True),
)

# Text limits and decimal ranges of the tables above.
FIT_LIMITS = {
    "customers": {"customer_name": 255, "segment": 100, "industry": 100, "country": 100},
    "channels": {"channel_name": 100, "channel_type": 50, "unit_price_eur": DecimalType(10, 4)},
    "traffic": {"revenue_eur": DecimalType(12, 2)},
    "revenue_by_period": {
        "revenue_last_month": DecimalType(12, 2),
        "revenue_last_quarter": DecimalType(12, 2),
        "revenue_mtd": DecimalType(12, 2),
        "revenue_ytd": DecimalType(12, 2),
        "revenue_increase_pct_qoq": DecimalType(5, 2),
    },
    "industry_exposure": {"total_revenue": DecimalType(15, 2)},
    "customer_totals": {"total_revenue": DecimalType(15, 2)},
}
# Column defaults (created_date defaults to the run date).
TRAFFIC_DEFAULTS = {"interactions_count": 0, "revenue_eur": 0}


def text_schema(schema: StructType) -> StructType:
    """The same columns as strings, as a file with a header but no types holds them."""
    return StructType([StructField(f.name, StringType(), True) for f in schema])


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``schema`` in order and type; an overflow raises, as in a typed table."""
    present = [f for f in schema if f.name in df.columns]
    return df.select(*[_as(df[f.name], f) for f in present])


def _as(column: Column, field: StructField) -> Column:
    return column.cast(field.dataType).alias(field.name)


def no_nulls(schema: StructType) -> dict[str, Column]:
    """One NOT NULL rule per required column."""
    return {f"{f.name} is not null": F.col(f.name).isNotNull() for f in schema if not f.nullable}
