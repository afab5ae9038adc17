"""Row order, last-row-wins upserts and surrogate keys within one batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType


def with_seq(df: DataFrame, order_column: str | None = None) -> DataFrame:
    """Adds ``seq``, the position of a row in its input.

    Raw files carry their own running id; pass it as ``order_column``. Without one
    the scan position is used, which follows the row order of a single file only.
    """
    if order_column:
        return df.withColumn("seq", F.col(order_column).cast("long"))
    return df.withColumn("seq", F.monotonically_increasing_id() + 1)


def last_wins(df: DataFrame, keys: list[str], seq: str = "seq") -> DataFrame:
    """One row per key: each other column from the row with the highest ``seq``,
    which must be unique within a key. Rows are combined before the shuffle, so a key
    with very many copies sends one row per task.

    Fixed-width values are taken column by column, which keeps the aggregation
    hash-based; with a text column among them the whole row moves as one struct.
    """
    rest = [c for c in df.columns if c not in keys]
    variable = any(isinstance(df.schema[c].dataType, StringType | BinaryType) for c in rest)
    if not variable:
        picked = [F.max_by(c, seq).alias(c) for c in rest if c != seq]
        return df.groupBy(*keys).agg(*picked, F.max(seq).alias(seq)).select(df.columns)
    latest = F.max_by(F.struct(*rest), F.col(seq)).alias("_latest")
    return df.groupBy(*keys).agg(latest).select(*keys, "_latest.*").select(df.columns)


def first_seen_key(df: DataFrame, keys: list[str], seq: str = "seq", name: str = "id") -> DataFrame:
    """A surrogate key per natural key: the position of its first row. It grows with
    arrival, has gaps after repeated keys, and needs no global sort."""
    return df.groupBy(*keys).agg(F.min(seq).alias(name))
