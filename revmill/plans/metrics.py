"""Revenue by period per customer, and the freshness of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, numbers
from ..operators import aggregates


# The texts of the report.
UPDATED = "Table updated this month with %d records"
NOT_UPDATED = "No records updated this month"


class StaleError(RuntimeError):
    """A table was not updated in the month it is needed for."""


def revenue_by_period(
    traffic: DataFrame,
    as_of: dates.When,
    key: str = "customer_id",
    boundary: str = "date",
    until: dates.When | None = None,
) -> DataFrame:
    """Per customer the revenue of the last month and quarter, of the month and year to
    date, and the growth of the running quarter over the whole previous one in percent
    (0 without a positive previous quarter). Customers with older rows only appear with
    zeros. The last quarter and the previous quarter are the same sum, made once."""
    inside = dates.period_conditions(F.col("send_date"), as_of, boundary, until)
    del inside["prev_quarter"]
    sums = aggregates.period_sums(traffic, key, "revenue_eur", inside)
    rounded = {c: F.round(F.col(c), 2).cast("decimal(22,2)") for c in sums.columns if c != key}
    growth = numbers.pct_change(F.col("revenue_current_quarter"), F.col("revenue_last_quarter"))
    return (
        sums.withColumns(rounded)
        .withColumn("revenue_increase_pct_qoq", growth.cast("decimal(18,2)"))
        .drop("revenue_current_quarter")
    )


def freshness(
    df: DataFrame, ts_col: str, as_of: dates.When, require: bool = False
) -> DataFrame:
    """How many rows were updated in the month of ``as_of``, with a message and whether
    there are any. ``require`` raises when there are none."""
    counted = df.where(dates.same_month(F.col(ts_col), as_of)).agg(
        F.count("*").alias("updated_rows")
    )
    fresh = F.col("updated_rows") > 0
    report = counted.select(
        "updated_rows",
        F.when(fresh, F.format_string(UPDATED, "updated_rows"))
        .otherwise(F.lit(NOT_UPDATED))
        .alias("message"),
        fresh.alias("success"),
    )
    if require and not report.first()["success"]:
        raise StaleError(f"no row of {ts_col} lies in the month of {as_of}")
    return report
