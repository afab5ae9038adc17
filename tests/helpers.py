"""Small literal tables."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

TRAFFIC = (
    "seq bigint, send_date date, account_id bigint, customer_id bigint, channel_id int, "
    "interactions_count int, revenue_eur decimal(12,2)"
)
CUSTOMERS = (
    "seq bigint, account_id bigint, customer_name string, segment string, industry string, "
    "country string, created_date date"
)
CHANNELS = (
    "seq bigint, channel_name string, channel_type string, unit_price_eur decimal(10,4)"
)


def d(text: str) -> date:
    return date.fromisoformat(text)


def traffic(spark, rows):
    """Rows of (date, customer, revenue) with running seq, account = customer, channel 1."""
    full = [
        (i, d(day), customer, customer, 1, 1, None if money is None else Decimal(str(money)))
        for i, (day, customer, money) in enumerate(rows, 1)
    ]
    return spark.createDataFrame(full, TRAFFIC)


def customers(spark, rows):
    """Rows of (customer, segment, industry)."""
    return spark.createDataFrame(rows, "customer_id bigint, segment string, industry string")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
