"""Near-duplicates by SimHash, linked through a popcount embedding.

A fingerprint is cut into segments; the set bits of each segment make a point on a small
grid. Changing one bit moves the point by one step, so the Manhattan distance of two points is
a lower bound of their fingerprints' distance. Points within 2r steps of each other share a
grid cell within r steps of both, which turns the range join into an equal join on cells;
pairs are then verified on the bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmill.llm.common import components, if_small, ship, text_of
from revmill.session import cut_lineage

SEGMENTS = 16
# A cell with more fingerprints than this isn't paired; its members go the other exact way.
PAIRED = 48
_AT_ONCE = 1 << 16


def _fingerprint(text: str, size: int, digest) -> int:
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    first = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - size + 1)
    begin, end = first[:n].tolist(), ends[-n:].tolist()
    total = np.zeros(64, np.int64)
    for at in range(0, n, _AT_ONCE):
        part = [digest(joined[a:b], 42) for a, b in zip(begin[at : at + _AT_ONCE], end[at : at + _AT_ONCE])]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, fp (long): SimHash of the whole text's word shingles, repeats included.

    Words are what stands between ASCII white space, A-Z lower-cased; shingles are hashed by
    XXH64 with seed 42. A text of fewer words is one shingle; one without words, or null, has
    fingerprint zero.
    """
    ship(docs.sparkSession)
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh64_intdigest
        for batch in batches:
            found = [_fingerprint(t, size, digest) for t in batch.column(1).to_pylist()]
            fp = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], ["doc_id", "fp"])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, schema)


def _around(steps: list[Column], start: Column, radius: int) -> Column:
    """start and everything within `radius` of the steps, as an array."""
    out = F.array(start)
    for _ in range(radius):
        out = F.array_distinct(F.flatten(F.transform(out, lambda c: F.array(c, *[s(c) for s in steps]))))
    return out


def links(fps: DataFrame, max_bits: int, segments: int = SEGMENTS) -> DataFrame:
    """a, b: links between distinct fingerprints (column fp, written) that differ in at most
    max_bits bits (an even number), enough of them to connect all that are connected.

    Cells of up to PAIRED fingerprints pair them and verify each pair. Fingerprints of larger
    cells are regrouped by every value within max_bits / 2 flipped bits of them: two that
    share one are linked, and two that are linked share one, so linking each to the smallest
    of the group is exact and takes no pairs.
    """
    if max_bits % 2:
        raise ValueError("max_bits must be even")
    radius, width = max_bits // 2, 64 // segments
    digit = (width + 2).bit_length()  # holds -1 to width + 1, shifted by one
    if digit * segments > 63:
        raise ValueError("too many segments")
    point = F.lit(0).cast("long")
    for i in range(segments):
        ones = F.bit_count(F.shiftrightunsigned("fp", width * i).bitwiseAND(F.lit((1 << width) - 1))) + 1
        point = point + F.shiftleft(ones.cast("long"), digit * i)
    moves = [(lambda c, d=sign << (digit * i): c + F.lit(d)) for i in range(segments) for sign in (1, -1)]
    cells = fps.select("fp", point.alias("p")).select("fp", F.explode(_around(moves, F.col("p"), radius)).alias("cell"))
    cells = cut_lineage(cells.repartition("cell"))
    many = cells.groupBy("cell").agg(F.count("*").alias("n")).filter("n > 1")
    many = cut_lineage(many)
    shared = cut_lineage(cells.join(many, "cell"))
    pairs = shared.filter(F.col("n") <= PAIRED).select("cell", "fp")
    other = pairs.select("cell", F.col("fp").alias("b"))
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("b"))) <= max_bits
    paired = pairs.join(other, "cell").filter(F.col("fp") < F.col("b")).filter(near).select(F.col("fp").alias("a"), "b")
    crowded = shared.filter(F.col("n") > PAIRED).select("fp").distinct()
    flips = [(lambda c, b=i: c.bitwiseXOR(F.shiftleft(F.lit(1).cast("long"), b))) for i in range(64)]
    spread = crowded.select("fp", F.explode(_around(flips, F.col("fp"), radius)).alias("near"))
    least = spread.groupBy("near").agg(F.min("fp").alias("b"), F.count("*").alias("n")).filter("n > 1")
    starred = spread.join(least, "near").filter("fp > b").select(F.col("fp").alias("a"), "b")
    return paired.unionAll(starred).distinct()


def near_duplicates(docs: DataFrame, size: int = 3, max_bits: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable over
    links of at most max_bits bits): a row for each row of docs.

    Null ids never name a component, unless it has no other id. Repeated rows stay repeated.
    """
    rows = cut_lineage(fingerprints(docs, size))
    nodes = cut_lineage(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    tree = components(links(nodes.select("fp"), max_bits))
    members = cut_lineage(tree.unionAll(tree.select(F.col("root").alias("node"), "root").distinct()))
    named = members.join(nodes, F.col("node") == F.col("fp"))
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = members.join(smallest, "root").select(F.col("node").alias("fp"), "component_id")
    all_nodes = cut_lineage(
        nodes.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "first_id").alias("component_id"))
    )
    text = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return rows.join(all_nodes, "fp").select("doc_id", text, "component_id")


def keep_one(docs: DataFrame, size: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of docs whose id names its component: one document of each group.

    A row without an id can't be named and stays. Rows that repeat the id of a document that
    stays are reduced to one.
    """
    found = cut_lineage(near_duplicates(docs, size, max_bits))
    sizes = found.agg(
        F.count_if(F.col("doc_id") != F.col("component_id")).alias("gone"),
        F.count("doc_id").alias("rows"),
        F.countDistinct("doc_id").alias("ids"),
    ).first()
    gone = found.filter(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    left = docs.join(if_small(gone, sizes["gone"], 16), "doc_id", "left_anti").select(docs.columns)
    if sizes["rows"] == sizes["ids"]:
        return left
    named = left.filter(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id"])
    return named.unionByName(left.filter(F.col("doc_id").isNull()))
