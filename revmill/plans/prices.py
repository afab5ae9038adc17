"""Price responses to one panel of daily prices."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions import dates
from ..operators import series


def daily_prices(
    raw: DataFrame,
    start: dates.When | None = None,
    json_col: str = "response",
    symbol_col: str = "company",
) -> DataFrame:
    """Rows of all companies from ``start`` on, with plain column names."""
    rows = series.flatten_daily_series(raw, json_col, symbol_col)
    if start is not None:
        rows = dates.from_date(rows, "date", start)
    return series.rename(rows)


def price_panel(*raw: DataFrame, start: dates.When) -> DataFrame:
    """The combined series of several sources, by company and date."""
    panel = series.union_series(*[daily_prices(r, start) for r in raw])
    return panel.orderBy("company", "date")
