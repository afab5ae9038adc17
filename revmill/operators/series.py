"""Daily price series: nested JSON to rows, union and column names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructField, StructType

# The response's outer key and its field names, with the column each becomes.
SERIES_KEY = "Time Series (Daily)"
FIELD_NAMES = {
    "1. open": "open",
    "2. high": "high",
    "3. low": "low",
    "4. close": "close",
    "5. volume": "volume",
}

_DAY = StructType([StructField(f, StringType()) for f in FIELD_NAMES])
RESPONSE = StructType([StructField(SERIES_KEY, MapType(StringType(), _DAY))])


def flatten_daily_series(df: DataFrame, json_col: str, symbol_col: str) -> DataFrame:
    """One row per symbol and day, fields under their response names and as numbers.
    A response without the series, or one that is not JSON, gives no rows."""
    parsed = df.select(
        F.col(symbol_col).alias("company"),
        F.from_json(json_col, RESPONSE).getField(SERIES_KEY).alias("days"),
    )
    daily = parsed.select("company", F.explode("days").alias("day", "fields"))
    return daily.select(
        F.try_to_date("day").alias("date"),
        *[F.col("fields").getField(f).try_cast("double").alias(f) for f in FIELD_NAMES],
        "company",
    ).where(F.col("date").isNotNull())


def rename(df: DataFrame, names: dict[str, str] = FIELD_NAMES) -> DataFrame:
    return df.withColumnsRenamed(names)


def union_series(*series: DataFrame) -> DataFrame:
    """All rows of all series, columns matched by name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), series)
