"""Ordered output and top-k selection, with a tie-break so that results repeat."""

from __future__ import annotations

from decimal import ROUND_CEILING, Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .quantiles import nth_value

# Rows up to which each task keeps its own top rows and one task merges them. Both ways give
# the same rows; this one is for the small results that a report asks for.
TAKE_ROWS = 1_000


def descending(measure: str, tiebreak: str, nulls: str = "last") -> list[Column]:
    order = F.desc_nulls_first(measure) if nulls == "first" else F.desc_nulls_last(measure)
    return [order, F.asc(tiebreak)]


def order_desc(df: DataFrame, measure: str, tiebreak: str, nulls: str = "first") -> DataFrame:
    """Sorted by measure descending. The tie-break also lets the range partitions of the
    sort split a measure shared by many rows."""
    return df.orderBy(*descending(measure, tiebreak, nulls))


def top_n(
    df: DataFrame, measure: str, n: int, tiebreak: str, nulls: str = "last"
) -> DataFrame:
    return df.orderBy(*descending(measure, tiebreak, nulls)).limit(n)


def head(df: DataFrame, keys: list[str], n: int = 5) -> DataFrame:
    return df.orderBy(*keys).limit(n)


def fraction_count(df: DataFrame, key: str, fraction: float) -> int:
    """The fraction of the distinct keys, rounded up in decimal arithmetic."""
    distinct = df.agg(F.count_distinct(key)).first()[0]
    share = Decimal(str(fraction)) * distinct
    return int(share.to_integral_value(rounding=ROUND_CEILING))


def top_fraction(
    df: DataFrame,
    measure: str,
    fraction: float,
    tiebreak: str,
    population: DataFrame | None = None,
    take_rows: int = TAKE_ROWS,
) -> DataFrame:
    """The top ``fraction`` of the population by measure, exactly, unordered.

    ``tiebreak`` is unique in ``df`` and names the key counted in ``population`` (by default
    ``df`` itself). Rows without a measure rank last; rows without a key are in no
    population and are left out, however large the result.
    """
    df = df.where(F.col(tiebreak).isNotNull())
    n = fraction_count(df if population is None else population, tiebreak, fraction)
    if n <= take_rows:
        return top_n(df, measure, n, tiebreak)
    return _above_cut(df, measure, n, tiebreak)


def _above_cut(df: DataFrame, measure: str, n: int, tiebreak: str) -> DataFrame:
    """Top ``n`` by filter: the n-th largest measure is found exactly, rows above it stay,
    and of the rows equal to it those with the smallest keys fill up. Nothing is sorted
    in one task."""
    df = cut_lineage(df)
    ranked = df.agg(F.count("*"), F.count(measure)).first()
    rows, valued = ranked
    if n >= rows:
        return df
    value = F.col(measure)
    if n > valued:
        kept, ties, missing = value.isNotNull(), value.isNull(), n - valued
    else:
        cut = nth_value(df, measure, valued - n + 1)
        above = df.agg(F.count_if(value > F.lit(cut))).first()[0]
        kept, ties, missing = value > F.lit(cut), value == F.lit(cut), n - above
    last_key = nth_value(df.where(ties), tiebreak, missing)
    return df.where(kept | (ties & (F.col(tiebreak) <= F.lit(last_key))))
