"""Shards of near-equal bytes by a K-d tree over document metadata.

A node that holds several shards is cut along the dimension in which its documents spread
widest, at the weighted median (or the share that its shards ask for), until every leaf is
one shard. Medians are found by histograms of bytes that narrow the range of the cut, so the
driver sees a bounded number of sums and no document. Equal texts fall together unless their
group alone is too large for that: then it is cut by a hash of the ids.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revmill.llm.common import if_small, numbered, text_of
from revmill.session import cut_lineage

BUCKETS = 4096
# A cut may miss its share by this part of a shard's bytes.
TOLERANCE = 0.004
# A group of equal texts in the way of a cut stays whole up to this part of a shard's bytes.
WHOLE = 0.02
_SPAN = 1 << 30


def _choose(node: Column, values: dict[int, object], default) -> Column:
    """A literal for each node, as a chain of whens over the few nodes of a level."""
    return reduce(lambda c, kv: F.when(node == kv[0], F.lit(kv[1])).otherwise(c), values.items(), F.lit(default))


def _cuts(rows: DataFrame, key: str, shares: dict[int, tuple[float, float, float]], span: int):
    """For each node: the value below which rows go left, and (value, bytes still wanted) if
    the rows of one value alone must be cut further. shares: bytes wanted left of the cut,
    the tolerance in bytes, and up to how many bytes the rows of one value stay together.
    Keys lie in [0, span)."""
    ranges = {n: (0, span, 0.0) for n in shares}  # from, up to, bytes before
    done: dict[int, tuple[int, tuple[int, float] | None]] = {}
    while ranges:
        node = F.col("node")
        low = _choose(node, {n: r[0] for n, r in ranges.items()}, 0).cast("long")
        width = {n: -(-(r[1] - r[0]) // BUCKETS) for n, r in ranges.items()}
        step = _choose(node, width, 1).cast("long")
        high = _choose(node, {n: r[1] for n, r in ranges.items()}, 0).cast("long")
        inside = rows.filter(node.isin(list(ranges)) & (F.col(key) >= low) & (F.col(key) < high))
        bucket = F.expr("key_offset div key_step").alias("bucket")
        offset = inside.select("node", "size", (F.col(key) - low).alias("key_offset"), step.alias("key_step"))
        sums = offset.groupBy("node", bucket).agg(F.sum("size").alias("bytes"))
        found = sums.collect()  # at most BUCKETS rows a node
        by_node: dict[int, list] = {n: [] for n in ranges}
        for r in found:
            by_node[r["node"]].append((r["bucket"], r["bytes"]))
        for n, buckets in by_node.items():
            start, stop, before = ranges.pop(n)
            wanted, slack, whole = shares[n]
            cut, narrowed = start, False
            for bucket, size in sorted(buckets):
                begin = start + bucket * width[n]
                if before + size <= wanted:
                    before, cut = before + size, begin + width[n]
                    continue
                if size <= (whole if width[n] == 1 else slack) or min(wanted - before, before + size - wanted) <= slack / 4:
                    if before + size - wanted < wanted - before:
                        cut = begin + width[n]
                    else:
                        cut = begin
                elif width[n] == 1:
                    done[n] = (begin, (begin, wanted - before))
                    narrowed = True
                else:
                    ranges[n] = (begin, min(stop, begin + width[n]), before)
                    narrowed = True
                break
            if not narrowed:
                done[n] = (min(cut, span), None)
    return done


def _in_range(value: Column) -> Column:
    """Whole numbers whose differences stay 64-bit; what lies beyond counts as the limit."""
    value = F.coalesce(value.cast("long"), F.lit(0))
    return F.greatest(F.least(value, F.lit(1 << 61)), F.lit(-(1 << 61)))


def _one_place_per_text(rows: DataFrame, dims: list[str]) -> DataFrame:
    """Gives equal texts (by size and CRC) the dimensions of the smallest of them, so that
    they meet in one point. Written to the shared folder."""
    rows = cut_lineage(rows)
    if not dims:
        return rows
    text = ["size", "text_crc32"]
    groups = rows.groupBy(*text).agg(F.min(F.struct(*dims)).alias("place"), F.count("*").alias("n")).filter("n > 1")
    groups = cut_lineage(groups.select(*[F.col(c).alias(f"g_{c}") for c in text], "place"))
    groups = if_small(groups, groups.count(), 64)
    joined = rows.join(groups, [F.col(c) == F.col(f"g_{c}") for c in text], "left")
    moved = {d: F.coalesce(F.col("place")[d], F.col(d)) for d in dims}
    return cut_lineage(joined.withColumns(moved).select(rows.columns))


def kd_shards(docs: DataFrame, shards: int, dimensions: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard (0 to shards - 1), slot (gapless from 0 in each shard):
    a row for each row of docs.

    size is the text's UTF-8 bytes (null: none) plus 8. dimensions: whole-number columns of
    docs to cut along, besides the size; by default hashes of lang and source, where docs has
    them. Null values count as 0; documents alike in every dimension, in text and in id can't
    be told apart and stay together.
    """
    if dimensions is None:
        dimensions = {c: F.shiftright(F.xxhash64(F.col(c)), 2) for c in ("lang", "source") if c in docs.columns}
    text = text_of().cast("binary")
    names = ["size", *[f"dim_{i}" for i in range(len(dimensions))]]
    rows = _one_place_per_text(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            *[_in_range(c).alias(n) for n, c in zip(names[1:], dimensions.values())],
            F.lit(0).alias("node"),
        ),
        names[1:],
    )
    # node: its first shard; the number of shards below it.
    open_ = {0: shards}
    whole: dict[str, int] = {}
    while any(n > 1 for n in open_.values()):
        cut_now = {n: k for n, k in open_.items() if k > 1}
        ends = [f(c).alias(f"{p}_{c}") for c in names for p, f in (("lo", F.min), ("hi", F.max))]
        found = rows.filter(F.col("node").isin(list(cut_now))).groupBy("node").agg(F.sum("size").alias("bytes"), *ends).collect()
        if not whole:
            whole = {c: max(1, found[0][f"hi_{c}"] - found[0][f"lo_{c}"]) for c in names} if found else {c: 1 for c in names}
        shares, axis, low, spread = {}, {}, {}, {}
        for r in found:
            n = r["node"]
            widths = {c: (r[f"hi_{c}"] - r[f"lo_{c}"]) / whole[c] for c in names}
            axis[n] = max(names, key=lambda c: widths[c])
            low[n], spread[n] = r[f"lo_{axis[n]}"], r[f"hi_{axis[n]}"] - r[f"lo_{axis[n]}"] + 1
            left = cut_now[n] // 2
            shard = r["bytes"] / cut_now[n]
            shares[n] = (shard * left, TOLERANCE * shard, WHOLE * shard)
        node = F.col("node")
        along = reduce(lambda c, n: F.when(node == n, F.col(axis[n])).otherwise(c), axis, F.lit(0).cast("long"))
        start = _choose(node, low, 0).cast("decimal(20,0)")
        width = _choose(node, spread, 1).cast("decimal(20,0)")
        scaled = F.floor((along.cast("decimal(20,0)") - start) * F.lit(_SPAN) / width).cast("long")
        scaled = F.greatest(F.least(scaled, F.lit(_SPAN - 1)), F.lit(0))
        keyed = cut_lineage(rows.withColumn("key", F.shiftleft(scaled, 32) + F.col("text_crc32")))
        cuts = _cuts(keyed, "key", shares, _SPAN << 32)
        single = {n: c[1] for n, c in cuts.items() if c[1] is not None}
        id_key = F.shiftrightunsigned(F.xxhash64("doc_id"), 2)
        inner: dict[int, tuple[int, tuple[int, float] | None]] = {}
        if single:
            own = keyed.filter(F.col("key") == _choose(node, {n: s[0] for n, s in single.items()}, -1)).withColumn("id_key", id_key)
            inner = _cuts(own, "id_key", {n: (s[1], *shares[n][1:]) for n, s in single.items()}, _SPAN << 32)
        at = _choose(node, {n: c[0] for n, c in cuts.items()}, 1 << 62).cast("long")
        goes_left = F.col("key") < at
        if single:
            same = F.col("key") == _choose(node, {n: s[0] for n, s in single.items()}, -1)
            below = _choose(node, {n: c[0] for n, c in inner.items()}, 0)
            goes_left = goes_left | (same & (id_key < below))
        half = _choose(node, {n: k // 2 for n, k in cut_now.items()}, 0)
        moved = node.isin(list(cuts)) & ~goes_left
        rows = cut_lineage(keyed.withColumn("node", F.when(moved, node + half).otherwise(node)).drop("key"))
        open_ = {m: c for n, k in open_.items() for m, c in ([(n, k // 2), (n + k // 2, k - k // 2)] if k > 1 else [(n, 1)])}
    n = rows.count()
    placed = rows.select("doc_id", "size", "text_crc32", F.col("node").alias("shard"))
    return numbered(placed, ["shard"], ["doc_id", "text_crc32"], "slot", n)
