"""Finds benchmark items inside documents by MinHash containment, with SQL functions only.

A document contains an item if it holds at least a given part of the item's distinct word
shingles. Items are partitioned by size, and each item is represented by its smallest shingle
hashes: so many, by its partition's largest size, that an item which is contained can't miss
them all. A document of any length then needs one lookup for each of its shingles, and can't
contain an item that needs more shingles than it has. Candidates are verified on the shingles
themselves.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revmill.llm.common import if_small
from revmill.session import cut_lineage


def _words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _with_words(df: DataFrame, keep: list[str], text: str) -> DataFrame:
    # The generator keeps the words a column of their own: they aren't made anew for every
    # shingle that refers to them.
    return df.select(*keep, F.explode(F.array(_words(F.coalesce(F.col(text), F.lit(""))))).alias("words")).filter(F.size("words") > 0)


def _starts(size: int) -> Column:
    return F.sequence(F.lit(0), F.greatest(F.size("words") - size, F.lit(0)))


def _hashes(size: int) -> Column:
    """Hashes of the word shingles; a text of fewer words is one shingle."""
    words = [lambda i, k=k: F.get(F.col("words"), i + k) for k in range(size)]
    return F.transform(_starts(size), lambda i: F.xxhash64(*[w(i) for w in words]))


def _shingles(size: int) -> Column:
    whole = F.transform(_starts(size), lambda i: F.array_join(F.slice(F.col("words"), i + 1, size), " "))
    return F.array_distinct(whole)


def _sketches(items: DataFrame, size: int, least: float) -> DataFrame:
    """item_id, need (shingles a document must have), hash: the smallest hashes of each item.

    An item of q shingles that is contained may miss up to (1 - least) q of them. Its
    partition's upper bound takes the place of q, so an item has at least one hash more than
    it may miss.
    """
    hashed = _with_words(items, ["item_id"], "text").select(
        "item_id", F.array_sort(F.array_distinct(_hashes(size))).alias("hashes")
    )
    n = F.size("hashes")
    partition = F.ceil(F.log2(n))  # size partitions: up to 1, 2, 4, 8, ... shingles
    upper = F.pow(F.lit(2), partition)
    # Rounding must not shorten a sketch, so the share is widened by a hair.
    length = F.least(n, F.floor(upper * (1 - least) + 1e-9).cast("int") + 1)
    return hashed.select(
        "item_id",
        F.ceil(n * least - 1e-9).cast("int").alias("need"),
        F.explode(F.slice("hashes", F.lit(1), length)).alias("hash"),
    )


def candidates(docs: DataFrame, items: DataFrame, size: int, least: float) -> DataFrame:
    """doc_id, item_id: documents that hold a hash of an item's sketch."""
    sketch = cut_lineage(_sketches(items, size, least))
    sketch = if_small(sketch, sketch.count(), 24)
    held = _with_words(docs, ["doc_id"], "text").select(
        "doc_id", F.size("words").alias("n"), F.explode(_hashes(size)).alias("hash")
    )
    room = F.greatest(F.col("n") - size + 1, F.lit(1)) >= F.col("need")
    return held.join(sketch, "hash").filter(room).select("doc_id", "item_id").distinct()


def contained_items(docs: DataFrame, items: DataFrame, size: int = 5, least: float = 0.8) -> DataFrame:
    """doc_id, item_id, item_shingles, shared_shingles, containment: a row for each document
    and item of which it holds at least the part `least` of the distinct shingles.

    An item or document of fewer words than a shingle is one shingle of all its words; one
    without words, or null, matches nothing. Rows that repeat an id count as one document;
    ids may be null. Other columns are left out.
    """
    if not 0 < least <= 1 or math.isnan(least):
        raise ValueError("least must be above 0 and at most 1")
    found = cut_lineage(candidates(docs, items, size, least))
    n = found.count()
    some = if_small(found.select(F.col("doc_id").alias("__id")).distinct(), n, 16)
    rows = docs.select("doc_id", "text").join(some, F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")
    held = _with_words(rows, ["doc_id"], "text").select("doc_id", _shingles(size).alias("held"))
    pairs = if_small(found.withColumnRenamed("doc_id", "__id"), n, 24)
    held = held.join(pairs, F.col("doc_id").eqNullSafe(F.col("__id"))).drop("__id")
    wanted = _with_words(items, [F.col("item_id").alias("__item")], "text").select("__item", _shingles(size).alias("wanted"))
    both = held.join(wanted, F.col("item_id").eqNullSafe(F.col("__item")))
    total, shared = F.size("wanted"), F.size(F.array_intersect("held", "wanted"))
    counted = both.select("doc_id", "item_id", total.alias("item_shingles"), shared.alias("shared_shingles"))
    counted = counted.withColumn("containment", F.col("shared_shingles") / F.col("item_shingles"))
    hits = counted.filter(F.col("containment") >= least)
    best = hits.groupBy("doc_id", "item_id").agg(F.max_by(F.struct("item_shingles", "shared_shingles", "containment"), "containment").alias("m"))
    return best.select("doc_id", "item_id", "m.*")


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = 5, least: float = 0.8) -> DataFrame:
    """The rows of docs that contain no item. A row without an id goes if any such row does."""
    found = cut_lineage(contained_items(docs, items, size, least).select(F.col("doc_id").alias("__id")).distinct())
    gone = if_small(found, found.count(), 16)
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col("__id")), "left_anti")
