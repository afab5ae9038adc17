"""Exact duplicates by an exchange of Golomb-coded fingerprints.

Rows are taken in chunks. For each owner of a range of hash values, a chunk sends its sorted
distinct fingerprints as Golomb-coded gaps (with a power of two as divisor). An owner answers
with a bitmap of those that another chunk holds too. Only the texts behind set bits are
shuffled, and compared byte by byte as grouping keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmill.llm.common import if_small, ship, text_of
from revmill.session import cut_lineage

CHUNK = 8_192
# Fingerprints that an owner holds at a time, about.
OWNED = 1_000_000


def golomb_encode(values: np.ndarray) -> bytes:
    """Sorted unsigned 64-bit values: count, divisor's exponent, first value, remainders of
    the gaps in fixed width, quotients in unary."""
    n = len(values)
    if not n:
        return b""
    gaps = np.diff(values)
    mean = int(values[-1] - values[0]) // max(1, n - 1)
    k = max(0, mean.bit_length() - 1)
    rest = gaps & np.uint64((1 << k) - 1)
    bits = (rest[:, None] >> np.arange(k, dtype=np.uint64)) & np.uint64(1)
    quotient = (gaps >> np.uint64(k)).astype(np.int64)
    unary = np.ones(int(quotient.sum()) + n - 1, np.uint8)
    unary[np.cumsum(quotient + 1) - 1] = 0
    head = np.array([n, k, values[0]], "<u8").tobytes()
    return head + np.packbits(bits.astype(np.uint8).ravel()).tobytes() + np.packbits(unary).tobytes()


def golomb_decode(code: bytes) -> np.ndarray:
    if not code:
        return np.zeros(0, np.uint64)
    n, k, first = (int(x) for x in np.frombuffer(code, "<u8", 3))
    split = 24 + -(-(n - 1) * k // 8)
    bits = np.unpackbits(np.frombuffer(code[24:split], np.uint8), count=(n - 1) * k).reshape(n - 1, k)
    rest = (bits.astype(np.uint64) << np.arange(k, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    stops = np.flatnonzero(np.unpackbits(np.frombuffer(code[split:], np.uint8)) == 0)[: n - 1]
    quotient = np.diff(stops, prepend=-1).astype(np.uint64) - np.uint64(1)
    out = np.empty(n, np.uint64)
    out[0] = first
    out[1:] = np.uint64(first) + np.cumsum((quotient << np.uint64(k)) + rest, dtype=np.uint64)
    return out


def _chunks(id_type: T.DataType, owners: int):
    names = ["chunk", "owner", "coded", "sizes", "ids"]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                piece = batch.slice(at, CHUNK)
                hashes = piece.column(1).to_numpy().view(np.uint64)
                order = np.argsort(hashes, kind="stable")
                distinct, first, sizes = np.unique(hashes[order], return_index=True, return_counts=True)
                # The owner of a hash value: equal ranges, so even by the hash.
                owner = ((distinct >> np.uint64(32)) * np.uint64(owners)) >> np.uint64(32)
                ids = piece.column(0).take(pa.array(order))
                to, begin = np.unique(owner, return_index=True)
                ends = np.append(begin[1:], len(distinct))
                rows = {n: [] for n in names[:3]}
                size_lists, id_lists, edges = [], [], [0]
                for o, a, b in zip(to.tolist(), begin.tolist(), ends.tolist()):
                    rows["chunk"].append(f"{part}-{number}")
                    rows["owner"].append(o)
                    rows["coded"].append(golomb_encode(distinct[a:b]))
                    size_lists.append(sizes[a:b].astype(np.int32))
                    edges.append(int(first[a] + sizes[a:b].sum()))
                number += 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rows["chunk"], pa.string()),
                        pa.array(rows["owner"], pa.int32()),
                        pa.array(rows["coded"], pa.binary()),
                        pa.array(size_lists, pa.list_(pa.int32())),
                        pa.ListArray.from_arrays(pa.array(edges, pa.int32()), ids),
                    ],
                    names,
                )

    schema = T.StructType(
        [
            T.StructField("chunk", T.StringType()),
            T.StructField("owner", T.IntegerType()),
            T.StructField("coded", T.BinaryType()),
            T.StructField("sizes", T.ArrayType(T.IntegerType())),
            T.StructField("ids", T.ArrayType(id_type)),
        ]
    )
    return send, schema


def _answer(table: pa.Table) -> pa.Table:
    """Bitmaps over each chunk's fingerprints: set where another chunk has the same."""
    coded = [golomb_decode(c.as_py()) for c in table.column("coded")]
    everything = np.concatenate(coded)
    distinct, counts = np.unique(everything, return_counts=True)
    shared = distinct[counts > 1]
    maps = []
    for values in coded:
        at = np.minimum(np.searchsorted(shared, values), max(0, len(shared) - 1))
        hit = shared[at] == values if len(shared) else np.zeros(len(values), bool)
        maps.append(np.packbits(hit).tobytes())
    return pa.table(
        {"chunk": table.column("chunk"), "owner": table.column("owner"), "bitmap": pa.array(maps, pa.binary())}
    )


def _suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        picked = []
        for r in range(batch.num_rows):
            sizes = batch.column("sizes")[r].values.to_numpy()
            bits = np.unpackbits(np.frombuffer(batch.column("bitmap")[r].as_py(), np.uint8), count=len(sizes)).astype(bool)
            bits |= sizes > 1
            where = np.flatnonzero(np.repeat(bits, sizes))
            if len(where):
                picked.append(batch.column("ids")[r].values.take(pa.array(where)))
        if picked:
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(picked)], ["doc_id"])


def suspects(docs: DataFrame, text: str = "text") -> tuple[DataFrame, int]:
    """doc_id of the rows whose fingerprint another row has too, as a written table, and its
    size. The rows' texts are read once and never leave their partition."""
    spark = docs.sparkSession
    ship(spark)
    hashed = docs.select("doc_id", F.xxhash64(text_of(text)).alias("h"))
    rows = docs.count()
    owners = max(2, -(-rows // OWNED) * 4)
    id_type = docs.schema["doc_id"].dataType
    send, schema = _chunks(id_type, owners)
    chunks = cut_lineage(hashed.mapInArrow(send, schema))
    sent = chunks.select("chunk", "owner", "coded")
    bitmaps = sent.groupBy("owner").applyInArrow(_answer, "chunk string, owner int, bitmap binary")
    joined = chunks.select("chunk", "owner", "sizes", "ids").join(bitmaps, ["chunk", "owner"])
    found = joined.mapInArrow(_suspects, T.StructType([T.StructField("doc_id", id_type)]))
    found = cut_lineage(found.distinct())
    return found, found.count()


def exact_groups(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: a row for each row of docs.

    Texts are equal when their bytes are; null counts as empty. The row with the largest
    doc_id of equal texts stays. Rows without an id are compared too and stay only in a group
    without any id; repeated rows count each, and all copies of the largest id are kept.
    """
    base = docs.select("doc_id", text_of().alias("text"))
    found, n = suspects(base)
    ids = if_small(found.select(F.col("doc_id").alias("__id")), n, 16)
    same = F.col("doc_id").eqNullSafe(F.col("__id"))
    sha = F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256")
    alone = base.join(ids, same, "left_anti").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), sha
    )
    doubtful = base.join(ids, same, "left_semi")
    groups = doubtful.groupBy("text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    # Written, so that the join deals both sides out and can split a text that many rows share.
    groups = cut_lineage(groups)
    verified = doubtful.join(groups, "text").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), sha
    )
    return alone.unionAll(verified)
