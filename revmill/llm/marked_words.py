"""SentencePiece encoding and decoding through a table of distinct marked words.

A model whose pieces hold the white-space mark at their begin alone never joins characters
across the begin of a marked word: a run of marks and the characters up to the next mark. So a
text's ids are those of its marked words, one behind the other. Tasks send each marked word
that they meet once; Spark leaves one row of each over all tasks, the library segments it, and
its ids go to sorted hash arrays in the shared folder (`lookup.py`). A second pass over the
texts puts the ids back by position, decodes them by the pieces' bytes, and compares the result
with the text: where two marked words should share a 64-bit hash, the text goes through the
library as a whole, so that the result is exact.

Models of another kind (a normaliser that rewrites text, pieces across marks, added symbols,
no bytes for unknown characters) have no such table; their texts go through the library whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmill.llm import lookup, store
from revmill.llm.common import ship, text_of
from revmill.llm.vectext import Chars, small_batches
from revmill.session import scratch

MARK = "▁"
# What the published model format calls its parts.
BPE, NORMAL, CONTROL, USER_DEFINED, BYTE = 2, 1, 3, 4, 6
# Characters worked on at a time; a longer text is cut between marked words.
CHARS = 1 << 20
# Text bytes for each shard of the table.
SHARD_BYTES = 8 * 1024 * 1024
# Hashes of marked words that a task remembers to have sent; a full memory is dropped, which
# costs repeated rows only.
REMEMBERED = 2_000_000

_EDGE = re.compile(f"[^{MARK}]{MARK}")

_models: dict[str, "Pieces"] = {}


class Pieces:
    """A model file: the library, and the bytes of each piece where they can be joined."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        pieces = [(p.piece, p.type) for p in spec.pieces]
        normal, trained = spec.normalizer_spec, spec.trainer_spec
        self.by_words = (
            trained.model_type == BPE
            and trained.byte_fallback
            and not trained.treat_whitespace_as_suffix
            and not normal.precompiled_charsmap
            and normal.add_dummy_prefix
            and normal.escape_whitespaces
            and not normal.remove_extra_whitespaces
            and not spec.denormalizer_spec.precompiled_charsmap
            and all(kind != USER_DEFINED for _, kind in pieces)
            and not any(MARK in p.lstrip(MARK) for p, _ in pieces)
            and (MARK, NORMAL) in pieces
        )
        own = [p.replace(MARK, " ").encode() if kind == NORMAL else bytes([int(p[3:5], 16)]) if kind == BYTE else b"" for p, kind in pieces]
        self.size = np.array([len(b) for b in own], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(own), np.uint8)
        self.plain = np.array([kind in (NORMAL, BYTE) for _, kind in pieces])
        self.marked = np.array([kind == NORMAL and p.startswith(MARK) for p, kind in pieces])
        self.lone = self.library.encode("a" + MARK)[len(self.library.encode("a")) :]

    def segment(self, words: list[str]) -> list[list[int]]:
        """Ids of marked words. The library puts the first mark before each itself."""
        ids = self.library.encode([w[1:] for w in words], num_threads=1)
        return [self.lone if w == MARK else i for w, i in zip(words, ids)]

    def joined(self, ids: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of consecutive sequences of ids, without the blank of a mark that a
        sequence begins with, and where each sequence begins and the last one ends."""
        size = self.size[ids]
        before = np.concatenate(([0], np.cumsum(size)))
        at = np.repeat(self.begin[ids] - before[:-1], size) + np.arange(before[-1])
        out = self.bytes[at]
        edge = before[edges]
        first = edges[:-1][edges[:-1] < edges[1:]]
        heads = before[first[self.marked[ids[first]]]]
        keep = np.ones(len(out), bool)
        keep[heads] = False
        return out[keep], edge - np.searchsorted(heads, edge)


def pieces_of(path: str) -> Pieces:
    """The worker's model; read once."""
    if path not in _models:
        _models[path] = Pieces(path)
    return _models[path]


def marked(text: str) -> str:
    """The text as the model sees it: a mark for each blank, and one before it."""
    return MARK + text.replace(" ", MARK) if text else ""


def cut(text: str, size: int = CHARS) -> Iterator[str]:
    """A marked text in parts of about so many characters, each beginning with a word."""
    begin = 0
    while len(text) - begin > size and (edge := _EDGE.search(text, begin + size - 1)):
        yield text[begin : edge.start() + 1]
        begin = edge.start() + 1
    if begin < len(text):
        yield text[begin:]


def words_of(parts: list[str]) -> tuple[Chars, np.ndarray, np.ndarray, np.ndarray]:
    """Marked words of parts that each begin with one: begins, ends and hashes."""
    chars = Chars(parts)
    mark = chars.codes == ord(MARK)
    start = mark.copy()
    start[1:] &= ~mark[:-1]
    start[chars.starts[:-1]] = True
    begin = np.flatnonzero(start)
    end = np.append(begin[1:], len(chars.codes))
    return chars, begin, end, chars.hashes(begin, end).view(np.int64)


def _batches(parts: list[str]) -> Iterator[tuple[int, int]]:
    return small_batches(parts, CHARS)


def _senders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sent = np.zeros(0, np.int64)
    for batch in batches:
        parts = [p for text in batch.column(0).to_pylist() for p in cut(marked(text))]
        for a, b in _batches(parts):
            chars, begin, end, hashes = words_of(parts[a:b])
            distinct, example = np.unique(hashes, return_index=True)
            new = ~np.isin(distinct, sent, assume_unique=True)
            if len(sent) + int(new.sum()) > REMEMBERED:
                sent = distinct
            else:
                sent = np.concatenate([sent, distinct[new]])
            where = example[new]
            words = [chars.text[i:j] for i, j in zip(begin[where].tolist(), end[where].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(distinct[new]), pa.array(words, pa.string())], ["hash", "word"])


def _segmenter(model: str, folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model)
        kind = "u2" if len(pieces.size) <= 1 << 16 else "u4"
        for table in lookup.stretches(batches):
            hashes = table.column("hash").to_numpy().astype(np.int64)
            flat, sizes = [], []
            for part in table.column("word").chunks:
                ids = pieces.segment(part.to_pylist())
                sizes.append(np.fromiter(map(len, ids), np.int64, len(ids)))
                flat.append(np.fromiter((x for i in ids for x in i), kind, int(sizes[-1].sum())))
            ends = np.cumsum(np.concatenate(sizes)).astype("u4")
            arrays = {"hash": hashes, "ends": ends, f"ids-{kind}": np.concatenate(flat)}
            addresses = [store.put(folder, name, array) for name, array in arrays.items()]
            yield lookup.file_row(int(hashes[0]), addresses, len(hashes))

    return run


@dataclass(frozen=True)
class Codec:
    """A model file and the table of marked words made with it, if the model allows one."""

    model: str
    table: lookup.Places | None


def build(docs: DataFrame, model: str) -> Codec:
    """A codec whose table has every marked word of the docs' texts; null texts are empty. It
    encodes other texts as well: words that the table lacks are segmented where they occur."""
    spark = docs.sparkSession
    ship(spark)
    if not pieces_of(model).by_words:
        return Codec(model, None)
    texts = docs.select(text_of().alias("text"))
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shards = lookup.shard_count(size, SHARD_BYTES)
    sent = lookup.dealt(texts.mapInArrow(_senders, "hash long, word string"), shards, "hash")
    distinct = sent.groupBy("shard", "hash").agg(F.first("word").alias("word"))
    ordered = distinct.sortWithinPartitions("shard", "hash")
    files = ordered.mapInArrow(_segmenter(model, scratch(spark, "marked-words")), lookup.FILES)
    return Codec(model, lookup.written(files))


def _ids_of(parts: list[str], codec: Codec, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all parts end to end, and where those of each part end."""
    chars, begin, end, hashes = words_of(parts)
    distinct, example, back = np.unique(hashes, return_index=True, return_inverse=True)
    size, where = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
    known = np.zeros(len(distinct), bool)
    pool, held = [], 0
    for addresses, which, rows in lookup.found(codec.table, distinct):
        ends = store.mapped(addresses[1], "u4")
        stop = ends[rows].astype(np.int64)
        start = np.where(rows > 0, ends[np.maximum(rows, 1) - 1], 0).astype(np.int64)
        own = stop - start
        before = np.cumsum(own) - own
        ids = store.mapped(addresses[2], addresses[2].rsplit("/", 1)[-1].split("-")[1])
        pool.append(ids[np.repeat(start - before, own) + np.arange(own.sum())].astype(np.int32))
        size[which], where[which], known[which] = own, held + before, True
        held += len(pool[-1])
    if not known.all():
        new = np.flatnonzero(~known)
        words = [chars.text[begin[i] : end[i]] for i in example[new].tolist()]
        ids = pieces.segment(words)
        own = np.fromiter(map(len, ids), np.int64, len(ids))
        pool.append(np.fromiter((x for i in ids for x in i), np.int32, int(own.sum())))
        size[new], where[new] = own, held + np.cumsum(own) - own
    if not pool:
        return np.zeros(0, np.int32), np.zeros(len(parts), np.int64)
    own = size[back]
    before = np.concatenate(([0], np.cumsum(own)))
    flat = np.concatenate(pool)[np.repeat(where[back] - before[:-1], own) + np.arange(before[-1])]
    return flat, before[np.searchsorted(begin, chars.starts[1:])]


def _utf8(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def round_trip(texts: list[str], codec: Codec, pieces: Pieces) -> tuple[list[np.ndarray], list[bytes]]:
    """Ids of each text, and the bytes they decode to."""
    if codec.table is None:
        ids = pieces.library.encode(texts, num_threads=1)
        return [np.array(i, np.int32) for i in ids], [_utf8(t) for t in decode_all(ids, pieces)]
    parts, owner = [], []
    for i, text in enumerate(texts):
        own = list(cut(marked(text)))
        parts += own
        owner += [i] * len(own)
    flats, ends, total = [], [], 0
    for a, b in _batches(parts):
        flat, stops = _ids_of(parts[a:b], codec, pieces)
        flats.append(flat)
        ends.append(stops + total)
        total += len(flat)
    sizes = np.zeros(len(texts), np.int64)
    if parts:
        np.add.at(sizes, owner, np.diff(np.concatenate(ends), prepend=0))
    edges = np.concatenate(([0], np.cumsum(sizes)))
    flat = np.concatenate(flats) if flats else np.zeros(0, np.int32)
    raw, at = pieces.joined(flat, edges)
    raw = raw.tobytes()
    ids = [flat[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
    out = [raw[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
    for i, text in enumerate(texts):
        if out[i] != _utf8(text.replace(MARK, " ")):
            whole = pieces.library.encode(text)
            ids[i], out[i] = np.array(whole, np.int32), _utf8(pieces.library.decode(whole))
    return ids, out


def decode_all(sequences: list, pieces: Pieces) -> list[str]:
    """The library's text of each sequence of ids. Sequences of plain pieces whose bytes are
    valid UTF-8 are joined by position; others go through the library."""
    lists = [np.asarray(s, np.int64) for s in sequences]
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    edges = np.concatenate(([0], np.cumsum(sizes)))
    flat = np.concatenate(lists) if lists else np.zeros(0, np.int64)
    out: list[str | None] = [None] * len(lists)
    if pieces.by_words:
        inside = (flat >= 0) & (flat < len(pieces.size))
        safe = np.where(inside, flat, 0)
        odd = np.concatenate(([0], np.cumsum(~(inside & pieces.plain[safe]))))
        raw, at = pieces.joined(safe, edges)
        raw = raw.tobytes()
        for i in np.flatnonzero(odd[edges[1:]] == odd[edges[:-1]]).tolist():
            try:
                out[i] = raw[at[i] : at[i + 1]].decode()
            except UnicodeDecodeError:
                pass
    return [pieces.library.decode(x.tolist()) if t is None else t for x, t in zip(lists, out)]


def _fields(docs: DataFrame, **more: T.DataType) -> T.StructType:
    fields = [T.StructField("doc_id", docs.schema["doc_id"].dataType)]
    return T.StructType(fields + [T.StructField(n, k) for n, k in more.items()])


def encode(docs: DataFrame, codec: Codec) -> DataFrame:
    """doc_id, ids (array of int), decoded of every row of docs: the whole text's ids, without
    begin and end, and the text that these ids decode to.

    Null texts are empty; an empty text has no ids and decodes to an empty one. Repeated rows
    and null ids stay; other columns are left out. A text of any length is worked on in parts
    of bounded size, and its own ids are held at once.
    """
    sent = docs.sparkSession.sparkContext.broadcast(codec)  # addresses of files, no arrays

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        pieces = pieces_of(own.model)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in small_batches(texts, CHARS):
                ids, out = round_trip(texts[a:b], own, pieces)
                edges = np.concatenate(([0], np.cumsum([len(i) for i in ids])))
                lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(np.concatenate(ids), pa.int32()))
                texts_out = pa.array(out, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists, texts_out], ["doc_id", "ids", "decoded"])

    schema = _fields(docs, ids=T.ArrayType(T.IntegerType()), decoded=T.StringType())
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id, decoded of rows of doc_id and ids (array of int), as the library decodes them;
    null ids are an empty sequence. An id that the model lacks fails, as it does there."""
    ship(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model)
        for batch in batches:
            out = decode_all([[] if i is None else i for i in batch.column(1).to_pylist()], pieces)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, _fields(encoded, decoded=T.StringType()))


def default_model() -> str:
    """Where the public model file of the registered query lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")
