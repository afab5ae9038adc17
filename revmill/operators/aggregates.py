"""Grouped totals, distinct counts, shares and counts. All are partial before the
shuffle, so the size of a group does not matter."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..functions import dates


def money_sum(df: DataFrame, measure: str, inside: Column | None = None) -> Column:
    """The exact sum of a measure, optionally of the rows ``inside``. Amounts of at most 16
    digits are added as whole cents: a 64-bit sum needs no decimal arithmetic per row, and
    holds totals up to 9.2e16. Beyond that it raises, so it is done in ANSI mode only; wider
    amounts, and sessions without ANSI mode, are added as decimals, up to 38 digits."""
    kind, amount = df.schema[measure].dataType, F.col(measure)
    cents = (
        isinstance(kind, DecimalType)
        and (kind.scale, kind.precision <= 16) == (2, True)
        and df.sparkSession.conf.get("spark.sql.ansi.enabled") == "true"
    )
    if cents:
        amount = (amount * 100).cast("bigint")
    total = F.sum(amount if inside is None else F.when(inside, amount))
    return (total * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(22,2)") if cents else total


def total_by(df: DataFrame, key: str, measure: str, name: str = "total_revenue") -> DataFrame:
    return df.groupBy(key).agg(money_sum(df, measure).alias(name))


def distinct_by(df: DataFrame, key: str, column: str | Column, name: str = "n") -> DataFrame:
    return df.groupBy(key).agg(F.count_distinct(column).alias(name))


def value_counts(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias(name))
    return counts.orderBy(F.desc(name), column)


def series_extent(df: DataFrame, by: str, date_col: str) -> DataFrame:
    return df.groupBy(by).agg(
        F.min(date_col).alias("first_date"),
        F.max(date_col).alias("last_date"),
        F.count("*").alias("row_count"),
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table; a parquet count reads file footers only."""
    counted = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def share_of_total(
    df: DataFrame,
    key: str,
    id_col: str,
    digits: int = 2,
    count_name: str = "n",
    share_name: str = "share",
    unique: bool = False,
) -> DataFrame:
    """Distinct ids per key and their percentage of the sum over all keys. The sum is a
    scalar subquery over the grouped counts, so the groups never meet in one window.
    Ids known to be ``unique`` are counted as rows, which shuffles counts only."""
    ids = F.count(id_col) if unique else F.count_distinct(id_col)
    counts = df.groupBy(key).agg(ids.alias(count_name))
    whole = counts.agg(F.sum(count_name).cast("decimal(20,0)")).scalar()
    share = F.col(count_name).cast("decimal(20,0)") * 100 / whole
    return counts.withColumn(share_name, F.round(share, digits))


def period_sums(
    df: DataFrame, key: str, measure: str, conditions: dict[str, Column]
) -> DataFrame:
    """One conditional sum per period in a single pass; rows without a key are left out
    and a key without rows in a period gets zero."""
    nothing = F.lit(0).cast("decimal(12,2)")
    sums = [
        F.coalesce(money_sum(df, measure, inside), nothing).alias(f"revenue_{name}")
        for name, inside in conditions.items()
    ]
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*sums)


def periods_active(
    df: DataFrame,
    entity: str,
    date_col: str,
    as_of: dates.When,
    months: int = 12,
    grain: str = "month",
    name: str = "periods_with_activity",
) -> DataFrame:
    """Distinct periods with a row, per entity, from ``months`` before ``as_of`` on."""
    recent = dates.since(df.select(entity, date_col), date_col, as_of, months)
    return distinct_by(recent, entity, dates.truncate(F.col(date_col), grain), name)
