"""Descriptive statistics of numeric columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, NumericType, StructType

from .quantiles import exact_percentiles, quoted


def is_id(name: str) -> bool:
    """Key columns carry no statistics."""
    lowered = name.lower()
    return lowered == "id" or lowered.endswith("_id")


def numeric_columns(
    schema: StructType,
    numeric_types: str = "all",
    skip: Callable[[str], bool] = is_id,
) -> list[str]:
    """Names of the columns to profile: every numeric type, or double and int only."""
    wanted = NumericType if numeric_types == "all" else (DoubleType, IntegerType)
    return [f.name for f in schema if isinstance(f.dataType, wanted) and not skip(f.name)]


# Names and types of a profile row.
ROW = """column_name string, min_value double, max_value double, mean_value double,
    median_value double, std_deviation double, count_non_null bigint, count_total bigint"""


def _statistics(name: str) -> dict[str, Column]:
    column = F.col(quoted(name))
    return {
        "min_value": F.min(column).cast("double"),
        "max_value": F.max(column).cast("double"),
        "mean_value": F.avg(column).cast("double"),
        "std_deviation": F.stddev(column).cast("double"),
        "count_non_null": F.count(column),
        "count_total": F.count("*"),
    }


def profile(df: DataFrame, columns: list[str], exact: bool = False) -> DataFrame:
    """One row per column: min, max, mean, median, sample deviation and counts, all
    columns in one pass over the data. The median is the sketch's. With ``exact`` it is
    the discrete one; the same pass then starts the search. Without columns there are no
    rows. NaN is a value above all numbers, so it can be the maximum and makes mean and
    deviation NaN."""
    if not columns:
        return df.sparkSession.createDataFrame([], ROW)
    stats = {c: _statistics(c) for c in columns}
    if exact:
        return _exact_profile(df, stats)
    for c in columns:
        stats[c]["median_value"] = F.percentile_approx(F.col(quoted(c)), 0.5).cast("double")
    wide = df.agg(*[F.struct(*_named(stats[c])).alias(f"c{i}") for i, c in enumerate(columns)])
    rows = [
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"c{i}.{n}").alias(n) for n in _NAMES])
        for i, c in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*rows)))


_NAMES = [field.split()[0] for field in ROW.split(",")][1:]


def _named(stats: dict[str, Column]) -> list[Column]:
    return [value.alias(name) for name, value in stats.items()]


def _exact_profile(df: DataFrame, stats: dict[str, dict[str, Column]]) -> DataFrame:
    """The statistics are made in the second of the two passes that the medians take."""
    also = [
        value.alias(f"x{i}_{name}")
        for i, columns in enumerate(stats.values())
        for name, value in columns.items()
    ]
    medians, found = exact_percentiles(df, {c: [0.5] for c in stats}, also=also)
    rows = []
    for i, (c, columns) in enumerate(stats.items()):
        row = {name: found[f"x{i}_{name}"] for name in columns}
        median = medians[c][0]
        row |= {"column_name": c, "median_value": None if median is None else float(median)}
        rows.append(tuple(row[name] for name in ["column_name", *_NAMES]))
    return df.sparkSession.createDataFrame(rows, ROW)
