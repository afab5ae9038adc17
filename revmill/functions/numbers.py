"""Column expressions on amounts and on categories."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three category labels.
LABELS = ("Low", "Mid", "High")


def pct_change(current: Column, previous: Column, digits: int = 2, otherwise: float = 0) -> Column:
    """Growth in percent, ``otherwise`` where the base is not positive. Decimals round half up."""
    growth = (current - previous) / F.when(previous > 0, previous) * 100
    return F.when(previous > 0, F.round(growth, digits)).otherwise(F.lit(otherwise))


def band(
    column: Column,
    low: Column | float,
    high: Column | float,
    labels: tuple[str, str, str] = LABELS,
    null_category: str | None = "High",
) -> Column:
    """Three categories with both cut points inclusive below; NULL gets ``null_category``."""
    first, second, third = labels
    return (
        F.when(column.isNull(), F.lit(null_category))
        .when(column <= low, F.lit(first))
        .when(column <= high, F.lit(second))
        .otherwise(F.lit(third))
    )
