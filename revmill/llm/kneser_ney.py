"""An interpolated modified Kneser-Ney bigram model, counted in Spark.

Tasks count the words and word pairs of their part of the text by 64-bit hash and send them,
packed, to shards by ranges of hash values. Each shard adds its counts up and is stored as
sorted hash arrays in the shared folder. Scoring tasks memory-map the arrays and look up the
distinct words and pairs of a batch at a time, in hash order, so that a shard is read from
front to back.

Pairs are dealt out by the hash of the pair, so a frequent word's pairs are spread evenly;
what a word needs as a context (its total, and how many successors it has once, twice, more
often) and as a successor (of how many words) is summed up in each shard before it moves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmill.llm import store
from revmill.llm.common import ship, text_of
from revmill.llm.vectext import Chars, ascii_space, combine, runs, small_batches
from revmill.session import cut_lineage, scratch

# Hashes of the mark before the first word and of the end token. Words hash through a
# scrambling that leaves these two as likely as any other value.
BEGIN, END = np.uint64(0x6265676E6265676E), np.uint64(0x656E6420656E6420)
# Text bytes per shard of pairs and of words.
SHARD_BYTES = 22 * 1024 * 1024
# Distinct pairs a task gathers before it sends them, and characters it tokenises at once:
# a worker's memory follows these two.
HELD = 1_200_000
CHARS = 1 << 20
WORD_COLUMNS = 6  # count, words before it, and as a context: total, successors seen 1, 2, 3+ times


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and text of every token in order, and the hash of the one before it. Words stand
    between ASCII white space, A-Z lower-cased; each text ends with the end token."""
    chars = Chars(texts, separator=32)
    chars.lower_ascii()
    begin, end = runs(~ascii_space(chars.codes))
    words = chars.hashes(begin, end)
    owner = chars.owners(begin)
    per_text = np.bincount(owner, minlength=len(texts))
    stops = np.cumsum(per_text + 1) - 1
    hashes = np.empty(len(words) + len(texts), np.uint64)
    is_end = np.zeros(len(hashes), bool)
    is_end[stops] = True
    hashes[is_end] = END
    hashes[~is_end] = words
    before = np.empty_like(hashes)
    before[1:] = hashes[:-1]
    before[stops - per_text] = BEGIN
    return hashes, np.repeat(np.arange(len(texts)), per_text + 1), before


def _shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    return (((hashes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)


def _planes(column: np.ndarray) -> bytes:
    """Numbers as planes of bytes, which compress better than numbers side by side."""
    width = column.dtype.itemsize
    return np.ascontiguousarray(column.view(np.uint8).reshape(-1, width).T).tobytes()


def _unplane(data: memoryview, dtype: str, n: int) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8, n * width).reshape(width, n).T).view(dtype).ravel()


def _gaps(ascending: np.ndarray) -> bytes:
    """Sorted hashes as their gaps, whose upper bytes are mostly zero."""
    return _planes(np.diff(ascending, prepend=np.uint64(0)))


def _from_gaps(data: memoryview, n: int) -> np.ndarray:
    return np.cumsum(_unplane(data, "<u8", n), dtype=np.uint64)


_zstd = pa.Codec("zstd", compression_level=1)


def pack_pairs(u: np.ndarray, w: np.ndarray, count: np.ndarray) -> bytes:
    """Pairs as indexes into the list of their distinct words."""
    words, index = np.unique(np.concatenate([u, w]), return_inverse=True)
    iu, iw = index[: len(u)], index[len(u) :]
    order = np.lexsort((iw, iu))
    raw = b"".join(
        [
            np.array([len(words), len(u)], "<u8").tobytes(),
            _gaps(words),
            _planes(np.diff(iu[order], prepend=0).astype("<u4")),
            _planes(iw[order].astype("<u4")),
            _planes(count[order].astype("<u8")),
        ]
    )
    return len(raw).to_bytes(8, "little") + _zstd.compress(raw, asbytes=True)


def unpack_pairs(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = memoryview(_zstd.decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True))
    v, n = (int(x) for x in np.frombuffer(raw, "<u8", 2))
    words = _from_gaps(raw[16:], v)
    at = 16 + 8 * v
    iu = np.cumsum(_unplane(raw[at:], "<u4", n), dtype=np.int64)
    iw = _unplane(raw[at + 4 * n :], "<u4", n).astype(np.int64)
    return words[iu], words[iw], _unplane(raw[at + 8 * n :], "<u8", n).astype(np.int64)


def pack_words(h: np.ndarray, columns: np.ndarray) -> bytes:
    raw = np.array([len(h)], "<u8").tobytes() + _gaps(h) + b"".join(_planes(c.astype("<u8")) for c in columns)
    return len(raw).to_bytes(8, "little") + _zstd.compress(raw, asbytes=True)


def unpack_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = memoryview(_zstd.decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True))
    n = int(np.frombuffer(raw, "<u8", 1)[0])
    h = _from_gaps(raw[8:], n)
    at = 8 + 8 * n
    return h, np.array([_unplane(raw[at + 8 * n * k :], "<u8", n).astype(np.int64) for k in range(WORD_COLUMNS)])


def _sum_words(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    h = np.concatenate([p[0] for p in parts])
    columns = np.concatenate([p[1] for p in parts], axis=1)
    order = np.argsort(h, kind="stable")
    h = h[order]
    first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
    return h[first], (np.add.reduceat(columns[:, order], first, axis=1) if len(h) else columns)


def _sum_pairs(parts) -> tuple[np.ndarray, ...]:
    u, w, c = (np.concatenate(x) for x in zip(*parts))
    g = combine(u, w)
    order = np.argsort(g, kind="stable")
    g = g[order]
    first = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1]))) if len(g) else np.zeros(0, np.int64)
    total = np.add.reduceat(c[order], first) if len(g) else c
    return g[first], u[order][first], w[order][first], total


def _only(column: int, values: np.ndarray) -> np.ndarray:
    out = np.zeros((WORD_COLUMNS, len(values)), np.int64)
    out[column] = values
    return out


def _parts(kind: str, shard_of: np.ndarray, pack) -> list[tuple[str, int, bytes]]:
    order = np.argsort(shard_of, kind="stable")
    shards, first = np.unique(shard_of[order], return_index=True)
    return [(kind, int(s), pack(rows)) for s, rows in zip(shards, np.split(order, first[1:]))]


_COUNTS = "kind string, shard int, packed binary"


def _counter(pair_shards: int, word_shards: int):
    def flush(words, pairs) -> pa.RecordBatch:
        h, back = np.unique(np.concatenate([x for x, _ in words]), return_inverse=True)
        n = np.bincount(back, weights=np.concatenate([x for _, x in words])).astype(np.int64)
        columns = _only(0, n)
        g, u, w, c = _sum_pairs(pairs)
        rows = _parts("word", _shard(h, word_shards), lambda r: pack_words(h[r], columns[:, r]))
        rows += _parts("pair", _shard(g, pair_shards), lambda r: pack_pairs(u[r], w[r], c[r]))
        kind, shard, packed = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(kind), pa.array(shard, pa.int32()), pa.array(packed, pa.binary())], ["kind", "shard", "packed"]
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs, held = [], [], 0
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in small_batches(texts, CHARS):
                h, _, before = tokens(texts[a:b])
                distinct, n = np.unique(h, return_counts=True)
                words.append((distinct, n))
                _, first, n = np.unique(combine(before, h), return_index=True, return_counts=True)
                pairs.append((before[first], h[first], n))
                held += len(first)
                if held > HELD:
                    yield flush(words, pairs)
                    words, pairs, held = [], [], 0
        if held:
            yield flush(words, pairs)

    return count


def _narrow(numbers: np.ndarray) -> np.ndarray:
    """Counts in the narrowest type that holds all of them."""
    most = int(numbers.max()) if numbers.size else 0
    return numbers.astype("u2" if most < 1 << 16 else "u4" if most < 1 << 32 else "i8")


def _ones(counts: np.ndarray) -> list[int]:
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)]


_STORED = "kind string, shard int, packed binary, hashes string, numbers string, n long, total long, known long, seen array<long>"


def _context(u: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the pairs of a shard say about their first words."""
    order = np.argsort(u, kind="stable")
    u, c = u[order], c[order]
    first = np.flatnonzero(np.concatenate(([True], u[1:] != u[:-1])))
    columns = np.zeros((WORD_COLUMNS, len(first)), np.int64)
    for row, values in ((2, c), (3, c == 1), (4, c == 2), (5, c >= 3)):
        columns[row] = np.add.reduceat(values.astype(np.int64), first)
    return u[first], columns


def _store_counts(folder: str, word_shards: int):
    """Adds up the counts of a shard. Pairs are stored, and what they say about words is sent
    on to the words' shards, as the words' own counts are."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        kind, shard = key[0].as_py(), key[1].as_py()
        if kind == "word":
            h, columns = _sum_words([unpack_words(x.as_py()) for x in table.column("packed")])
            return pa.Table.from_pylist([{"kind": "word", "shard": shard, "packed": pack_words(h, columns)}], _schema())
        g, u, w, c = _sum_pairs([unpack_pairs(x.as_py()) for x in table.column("packed")])
        after, n = np.unique(w, return_counts=True)
        h, columns = _sum_words([_context(u, c), (after, _only(1, n))])
        del u, w
        moved = _parts("word", _shard(h, word_shards), lambda r: pack_words(h[r], columns[:, r]))
        numbers = _narrow(c)
        rows = [
            {
                "kind": "pair",
                "shard": shard,
                "hashes": store.put(folder, f"pair-{shard}-hash", g),
                "numbers": store.put(folder, f"pair-{shard}-{numbers.dtype.str[1:]}", numbers),
                "n": len(g),
                "total": len(g),
                "known": 0,
                "seen": _ones(c),
            }
        ]
        rows += [{"kind": k, "shard": s, "packed": p} for k, s, p in moved]
        return pa.Table.from_pylist(rows, _schema())

    return run


def _store_words(folder: str):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        h, columns = _sum_words([unpack_words(x.as_py()) for x in table.column("packed")])
        shard, numbers = key[0].as_py(), _narrow(np.ascontiguousarray(columns.T))
        row = {
            "kind": "word",
            "shard": shard,
            "hashes": store.put(folder, f"word-{shard}-hash", h),
            "numbers": store.put(folder, f"word-{shard}-{numbers.dtype.str[1:]}", numbers),
            "n": len(h),
            "total": int(columns[0].sum()),
            "known": int((columns[0] > 0).sum()),
            "seen": _ones(columns[1]),
        }
        return pa.Table.from_pylist([row], _schema())

    return run


def _schema() -> pa.Schema:
    kinds = {"kind": pa.string(), "shard": pa.int32(), "packed": pa.binary(), "hashes": pa.string(), "numbers": pa.string()}
    kinds |= {"n": pa.int64(), "total": pa.int64(), "known": pa.int64(), "seen": pa.list_(pa.int64())}
    return pa.schema(list(kinds.items()))


@dataclass(frozen=True)
class Model:
    """Where the arrays lie, by shard, and the sums that the probabilities need."""

    words: dict[int, tuple[str, str]]
    pairs: dict[int, tuple[str, str]]
    word_shards: int
    pair_shards: int
    tokens: int
    vocabulary: int
    distinct_pairs: int
    word_discounts: tuple[float, float, float]
    pair_discounts: tuple[float, float, float]
    word_spare: float  # part of the lower order's mass that goes to the uniform distribution


def discounts(seen: list[int]) -> tuple[float, float, float]:
    """What is taken from counts of 1, 2, and 3 or more, from how many grams were counted 1,
    2, 3 and 4 times. Where that can't be told, half of what is usual at least."""
    n1, n2, n3, n4 = seen
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    out = [k - (k + 1) * y * more / n if n else k * 0.5 for k, n, more in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in zip((1, 2, 3), out))


def train(docs: DataFrame, may_learn: Column) -> Model:
    """A model of the texts for which may_learn holds; null texts are empty, rows without any
    id count like others."""
    spark = docs.sparkSession
    ship(spark)
    chosen = docs.filter(may_learn).select(text_of().alias("text"))
    size = chosen.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    pair_shards = max(8, -(-size // SHARD_BYTES))
    word_shards = pair_shards
    folder = scratch(spark, "kneser-ney")
    counts = chosen.mapInArrow(_counter(pair_shards, word_shards), _COUNTS)
    stored = cut_lineage(counts.groupBy("kind", "shard").applyInArrow(_store_counts(folder, word_shards), _STORED))
    words = stored.filter("kind = 'word'").select("shard", "packed")
    kept = cut_lineage(words.groupBy("shard").applyInArrow(_store_words(folder), _STORED))
    # One row for each shard: addresses and sums, no counts.
    columns = ["shard", "hashes", "numbers", "n", "total", "known", "seen"]
    pair_rows = stored.filter("kind = 'pair'").select(columns).collect()
    word_rows = kept.select(columns).collect()
    seen = lambda rows: [sum(r["seen"][k] for r in rows) for k in range(4)]
    word_seen, pair_seen = seen(word_rows), seen(pair_rows)
    distinct = sum(r["n"] for r in pair_rows)
    known = sum(r["known"] for r in word_rows)
    down = discounts(word_seen)
    often = known - word_seen[0] - word_seen[1]
    spare = (down[0] * word_seen[0] + down[1] * word_seen[1] + down[2] * often) / distinct if distinct else 1.0
    return Model(
        {r["shard"]: (r["hashes"], r["numbers"]) for r in word_rows},
        {r["shard"]: (r["hashes"], r["numbers"]) for r in pair_rows},
        word_shards,
        pair_shards,
        sum(r["total"] for r in word_rows),
        known,
        distinct,
        down,
        discounts(pair_seen),
        spare,
    )


def _look_up(sorted_hashes: np.ndarray, places: dict[int, tuple[str, str]], shards: int, width: int) -> np.ndarray:
    """Numbers of sorted distinct hashes; zeros where a hash isn't stored."""
    out = np.zeros((len(sorted_hashes), width), np.int64)
    shard = _shard(sorted_hashes, shards)
    for s, first, last in _stretches(shard):
        if s not in places:
            continue
        hashes, numbers = places[s]
        kind = numbers.rsplit("/", 1)[-1].split("-")[2]
        stored, values = store.mapped(hashes, "u8"), store.mapped(numbers, kind)
        if not len(stored):
            continue
        wanted = sorted_hashes[first:last]
        at = np.minimum(np.searchsorted(stored, wanted), len(stored) - 1)
        hit = stored[at] == wanted
        out[first:last][hit] = values.reshape(-1, width)[at[hit]]
    return out


def _stretches(sorted_values: np.ndarray) -> list[tuple[int, int, int]]:
    values, first = np.unique(sorted_values, return_index=True)
    return list(zip(values.tolist(), first.tolist(), [*first[1:].tolist(), len(sorted_values)]))


def _taken(counts: np.ndarray, by: tuple[float, float, float]) -> np.ndarray:
    return np.maximum(counts - np.array([0.0, *by])[np.minimum(counts, 3)], 0)


def log_probabilities(texts: list[str], model: Model) -> tuple[np.ndarray, ...]:
    """Of each text: tokens, known tokens, base score and the model's log10 probability."""
    h, owner, before = tokens(texts)
    distinct, back = np.unique(np.concatenate([h, before]), return_inverse=True)
    records = _look_up(distinct, model.words, model.word_shards, WORD_COLUMNS)
    own, context = records[back[: len(h)]], records[back[len(h) :]]
    grams, gram_back = np.unique(combine(before, h), return_inverse=True)
    pair = _look_up(grams, model.pairs, model.pair_shards, 1)[gram_back, 0]
    uniform = 1 / (model.vocabulary + 1)
    if model.distinct_pairs:
        lower = _taken(own[:, 1], model.word_discounts) / model.distinct_pairs + model.word_spare * uniform
    else:
        lower = np.full(len(h), uniform)
    total = context[:, 2]
    spare = (context[:, 3:] * np.array(model.pair_discounts)).sum(axis=1)
    safe = np.maximum(total, 1)
    p = np.where(total > 0, _taken(pair, model.pair_discounts) / safe + spare / safe * lower, lower)
    base = np.log10((own[:, 0] + 0.1) / (model.tokens + 0.1 * (model.vocabulary + 1)))
    sums = [np.bincount(owner, weights=x, minlength=len(texts)) for x in (np.ones(len(h)), own[:, 0] > 0, base, np.log10(p))]
    return sums[0].astype(np.int64), sums[1].astype(np.int64), sums[2], sums[3]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score, perplexity of every whole text (null:
    empty, which is one end token). Repeated rows and null ids stay."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)  # addresses of shards, no arrays
    names = ["n_tokens", "n_known", "base_score", "score", "perplexity"]
    kinds = [T.LongType(), T.LongType(), T.DoubleType(), T.DoubleType(), T.DoubleType()]
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *[T.StructField(n, k) for n, k in zip(names, kinds)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in small_batches(texts, CHARS):
                n, known, base, own = log_probabilities(texts[a:b], sent.value)
                columns = [batch.column(0).slice(a, b - a), *map(pa.array, (n, known, base, own, 10 ** (-own / n)))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *names])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, schema)
