"""Small dimensions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates
from ..model import CHANNELS

# Id, name, type and price in EUR of the message channels.
CHANNEL_ROWS = [
    (1, "SMS", "SMS", "0.05"),
    (2, "Email", "Email", "0.01"),
    (3, "Push Notification", "Push", "0.02"),
    (4, "Voice Call", "Voice", "0.15"),
    (5, "WhatsApp", "WhatsApp", "0.08"),
    (6, "Viber", "Viber", "0.06"),
    (7, "Telegram", "Telegram", "0.04"),
    (8, "Facebook Messenger", "Messenger", "0.07"),
]


def channels(spark: SparkSession) -> DataFrame:
    rows = [(i, name, kind, Decimal(price)) for i, name, kind, price in CHANNEL_ROWS]
    return spark.createDataFrame(rows, CHANNELS)


def date_spine(bounds: DataFrame, first: str, last: str, name: str = "date") -> DataFrame:
    """Every day from ``first`` to ``last``, both included, of each row of ``bounds``."""
    return bounds.select(F.explode(F.sequence(first, last)).alias(name))


def calendar(spark: SparkSession, start: dates.When, end: dates.When) -> DataFrame:
    ends = spark.range(1).select(dates.day(start).alias("first"), dates.day(end).alias("last"))
    return date_spine(ends, "first", "last")
