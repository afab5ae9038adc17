"""Column statistics of a table, and its rows in quartile categories."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import model
from ..functions import numbers
from ..operators import profile, quantiles

log = logging.getLogger(__name__)


def column_statistics(
    df: DataFrame, table_name: str, numeric_types: str = "all", exact: bool = False
) -> DataFrame:
    """One row per numeric column that is not a key; none without such columns. A column
    whose statistics have no decimal form (NaN, infinite, too large) is left out and logged."""
    columns = profile.numeric_columns(df.schema, numeric_types)
    rows = profile.profile(df.select(*[quantiles.quoted(c) for c in columns]), columns, exact)
    names = [f.name for f in rows.schema if f.name.endswith(("value", "deviation"))]
    lost = [F.col(n).isNotNull() & F.col(n).try_cast(model.STATISTIC).isNull() for n in names]
    # One row for each column of the table.
    found = rows.withColumn("_lost", F.greatest(*lost)).collect()
    for row in found:
        if row["_lost"]:
            log.warning("%s.%s cannot be described", table_name, row["column_name"])
    kept = [tuple(r)[:-1] for r in found if not r["_lost"]]
    described = df.sparkSession.createDataFrame(kept, profile.ROW)
    return model.conform(
        described.withColumn("table_name", F.lit(table_name)), model.COLUMN_STATISTICS
    )


def quartile_categories(
    df: DataFrame,
    columns: list[str],
    exact: bool = False,
    null_category: str | None = "High",
) -> DataFrame:
    """Adds <column>_category: up to the first quartile, up to the third, above. The cut
    points of all columns are one row of one pass."""
    if exact:
        found, _ = quantiles.exact_percentiles(df, {c: [0.25, 0.75] for c in columns})
    else:
        sketched = [F.percentile_approx(F.col(quantiles.quoted(c)), [0.25, 0.75]).alias(c) for c in columns]
        found = df.agg(*sketched).first().asDict()
    # Without values there are no cut points, and every row is in the last category.
    cuts = {c: [F.lit(v) for v in found[c] or (None, None)] for c in columns}
    return df.withColumns(
        {
            f"{c}_category": numbers.band(F.col(quantiles.quoted(c)), *cuts[c], null_category=null_category)
            for c in columns
        }
    )


def industry_categories(exposure: DataFrame, exact: bool = False) -> DataFrame:
    """Industry exposure with a category for its revenue and for its customers."""
    return quartile_categories(exposure, ["total_revenue", "customer_count"], exact)
