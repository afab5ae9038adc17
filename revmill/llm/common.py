"""What several operators share: shipping code, checked broadcasts, numbering, components."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revmill.session import cut_lineage

# A side of a join is broadcast only when its counted rows take at most this many bytes.
# Beyond it the same join shuffles both sides.
BROADCAST_BYTES = 64 * 1024 * 1024

# Texts reach a worker in batches of about so many bytes, or of one row if that is longer.
BATCH_BYTES = 4 * 1024 * 1024

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once per application, for the Python workers."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    fd, path = tempfile.mkstemp(prefix="revmill-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in sorted(os.walk(package)):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def bound_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Lowers the session's bound on the bytes of an Arrow batch to this one. Batches of ten
    thousand long rows otherwise lie in memory several times, on either side."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))
    if now > most:
        spark.conf.set(name, f"{most}b")


def text_of(column: str = "text") -> Column:
    """A null text counts as an empty one."""
    return F.coalesce(F.col(column), F.lit(""))


def fold(mod: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo mod. A null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % mod


def if_small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Marks df for a broadcast if its counted rows fit the bound; else Spark shuffles."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def numbered(
    df: DataFrame, group: list[str], order: list[str], name: str, rows: int
) -> DataFrame:
    """Adds gapless numbers from 0 within each group (columns without nulls), by the order
    columns.

    No group is ever sorted in one task: rows fall into buckets by a hash of the order
    columns, a running sum over the few bucket counts gives each bucket its first number,
    and rows are numbered within their bucket. Numbers therefore follow buckets, then the
    order. Buckets grow with the root of the rows, so that neither their number nor their
    size grows as fast as the table. df is read twice, so it should be a written table;
    rows is its row count.
    """
    buckets = max(1, int(rows**0.5 / 8))
    hashed = df.withColumn("__bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    counts = hashed.groupBy(*group, "__bucket").count()
    before = Window.partitionBy(*group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(
        *[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)],
        F.col("__bucket").alias("__b"),
        F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__first"),
    )
    inside = Window.partitionBy(*group, "__bucket").orderBy(*order)
    ranked = hashed.withColumn("__rank", F.row_number().over(inside))
    match = [F.col(g) == F.col(f"__g{i}") for i, g in enumerate(group)]
    joined = ranked.join(firsts, [*match, F.col("__bucket") == F.col("__b")])
    return joined.withColumn(name, F.col("__first") + F.col("__rank") - 1).drop(
        "__bucket", "__b", "__first", "__rank", *[f"__g{i}" for i in range(len(group))]
    )


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node reachable over the edges (columns a, b, long).

    Alternating star steps: every node hands its larger neighbours, then its smaller ones,
    to the smallest node it sees, until no edge moves. Edges stay distributed; each round is
    written to the shared folder, so a lost executor does not set it back.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = cut_lineage(edges.filter("a <> b").distinct())
    seen = None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a")
        large = large.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        ).select("e.a", "e.b")
        edges = cut_lineage(small.filter("a <> b").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
