"""Synthetic customers and traffic of any size, the same on every run of a seed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, draws
from .dims import CHANNEL_ROWS

# What a customer can be, and the ranges values are drawn from.
SEGMENTS = ("Enterprise", "SMB", "Startup", "Mid-Market")
INDUSTRIES = (
    "Technology",
    "Finance",
    "Healthcare",
    "Retail",
    "Manufacturing",
    "Education",
    "Government",
    "Media",
    "Telecommunications",
    "Energy",
)
COUNTRIES = (
    "United States",
    "United Kingdom",
    "Germany",
    "France",
    "Italy",
    "Spain",
    "Netherlands",
    "Sweden",
    "Norway",
    "Denmark",
)
ACCOUNTS = 50
RECORDS_PER_DAY = (10, 50)
INTERACTIONS = (1, 10_000)
CUSTOMER_AGE_DAYS = 730
PRICE_FACTOR = (8_000, 12_000)  # ten-thousandths: 0.8 to 1.2


def synth_customers(ids: DataFrame, id_col: str, as_of: dates.When, seed: int) -> DataFrame:
    """One customer per id; accounts are drawn from 1 to 50, so they repeat."""
    key = F.col(id_col).cast("long")
    a, b, c, d = draws.draws(seed, key)
    return ids.select(
        key.alias("customer_id"),
        draws.between(a, 1, ACCOUNTS).cast("long").alias("account_id"),
        F.format_string("Company %d", key).alias("customer_name"),
        draws.choice(b, SEGMENTS).alias("segment"),
        draws.choice(c, INDUSTRIES).alias("industry"),
        # The first draw gives two values: its remainder and its quotient by ACCOUNTS.
        draws.choice((a / ACCOUNTS).cast("long"), COUNTRIES).alias("country"),
        F.date_sub(dates.day(as_of), draws.between(d, 0, CUSTOMER_AGE_DAYS)).alias("created_date"),
    )


def synth_traffic(days: DataFrame, date_col: str, customers: int, seed: int) -> DataFrame:
    """10 to 50 records for each day, on customers 1 to ``customers``. Ids are unique and
    rise with the date; each day owns a range of them, so they need no global count."""
    lowest, highest = RECORDS_PER_DAY
    date = F.col(date_col).cast("date")
    per_day = draws.between(draws.draws(seed, date)[0], lowest, highest)
    records = days.select(
        date.alias("send_date"), F.explode(F.sequence(F.lit(1), per_day)).alias("nth")
    )
    number = F.unix_date("send_date").cast("long") * highest + F.col("nth")
    a, b, c, d = draws.draws(seed, F.col("traffic_id"))
    prices = F.array(*[F.lit(price).cast("decimal(10,4)") for *_, price in CHANNEL_ROWS])
    factor = (draws.between(d, *PRICE_FACTOR) / F.lit(10_000)).cast("decimal(5,4)")
    drawn = records.withColumn("traffic_id", number).select(
        "traffic_id",
        "send_date",
        # The last draw gives two values: the price factor, and an account by its quotient.
        draws.between((d / 4_001).cast("long"), 1, ACCOUNTS).cast("long").alias("account_id"),
        draws.between(a, 1, customers).cast("long").alias("customer_id"),
        draws.between(b, 1, len(CHANNEL_ROWS)).alias("channel_id"),
        draws.between(c, *INTERACTIONS).alias("interactions_count"),
        factor.alias("factor"),
    )
    revenue = F.col("interactions_count") * F.element_at(prices, F.col("channel_id"))
    return drawn.withColumn(
        "revenue_eur", F.round(revenue * F.col("factor"), 2).cast("decimal(12,2)")
    ).drop("factor")
