from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from revmill.llm import lookup, marked_words, queries

PATH = marked_words.default_model()
EMPTY = lookup.Places(np.zeros(0, np.int64), [], 0)
BITS = [" ", "  ", "   ", "▁", "▁▁", "\n", "\t", "a", "Zé", "the", "tion", " der", "ß", "漢字", "😀", "\x00", "<s>", "</s>", "<unk>", "<0x0A>", ".", "1", "\xa0", "\r\n"]


def texts(n, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(BITS) for _ in range(rnd.randint(0, 16))) for _ in range(n)] + ["", " ", "▁", "  ", "\n"]


def library(texts):
    model = marked_words.pieces_of(PATH).library
    ids = model.encode(texts)
    return ids, model.decode(ids)


@pytest.mark.parametrize("size", [1, 40, 1 << 20])
def test_ids_and_texts_equal_the_library(monkeypatch, size):
    monkeypatch.setattr(marked_words, "CHARS", size)
    monkeypatch.setattr(marked_words.cut, "__defaults__", (size,))
    every = texts(400 if size == 1 else 5000, 3)
    ids, decoded = marked_words.round_trip(every, marked_words.Codec(PATH, EMPTY), marked_words.pieces_of(PATH))
    want_ids, want = library(every)
    assert [i.tolist() for i in ids] == want_ids
    assert [d.decode() for d in decoded] == want


def test_any_ids_decode_like_the_library():
    pieces = marked_words.pieces_of(PATH)
    rnd = random.Random(5)
    n = len(pieces.size)
    pick = [lambda: rnd.randrange(n), lambda: rnd.randrange(3, 259), lambda: rnd.randrange(3), lambda: 35, lambda: pieces.lone[0]]
    sequences = [[rnd.choice(pick)() for _ in range(rnd.randint(0, 6))] for _ in range(20_000)]
    assert marked_words.decode_all(sequences, pieces) == pieces.library.decode(sequences)


def test_a_cut_text_is_the_text():
    for text in texts(500, 8):
        whole = marked_words.marked(text)
        parts = list(marked_words.cut(whole, 3))
        assert "".join(parts) == whole and all(p[0] == marked_words.MARK for p in parts)


def rows(df):
    return sorted(((r.doc_id, list(r.ids), r.decoded) for r in df.collect()), key=repr)


def want_of(docs):
    own = [(r.doc_id, r.text or "") for r in docs.collect()]
    ids, decoded = library([t for _, t in own])
    return sorted(zip([i for i, _ in own], ids, decoded), key=repr)


def test_odd_rows(odd, none):
    codec = marked_words.build(odd, PATH)
    assert rows(marked_words.encode(odd, codec)) == want_of(odd)
    assert marked_words.encode(none, marked_words.build(none, PATH)).collect() == []


def test_each_distinct_word_is_in_the_table_once(spark, documents, monkeypatch):
    docs = documents(list(enumerate([f"w{i % 50} common  x" for i in range(400)] + texts(300, 2))))
    codec = marked_words.build(docs, PATH)
    words = set()
    for r in docs.collect():
        whole = marked_words.marked(r.text)
        words |= {p for p in marked_words.cut(whole, 1)} if whole else set()
    assert codec.table.rows == len(words)
    assert (np.diff(codec.table.first) > 0).all()
    assert rows(marked_words.encode(docs, codec)) == want_of(docs)
    # Words that the table lacks are segmented where they occur.
    other = documents([(1, "unseen words here"), (2, "common x")])
    assert rows(marked_words.encode(other, codec)) == want_of(other)


def test_words_that_share_a_hash_change_nothing(documents, monkeypatch):
    whole = marked_words.words_of

    def colliding(parts):
        chars, begin, end, hashes = whole(parts)
        return chars, begin, end, hashes % 5

    docs = documents(list(enumerate(texts(200, 9))))
    codec = marked_words.build(docs, PATH)
    monkeypatch.setattr(marked_words, "words_of", colliding)
    every = [r.text or "" for r in docs.collect()]
    ids, decoded = marked_words.round_trip(every, marked_words.Codec(PATH, EMPTY), marked_words.pieces_of(PATH))
    assert ([i.tolist() for i in ids], [d.decode() for d in decoded]) == library(every)
    assert codec.table.rows > 5


def test_models_of_another_kind_go_through_the_library(odd, monkeypatch):
    monkeypatch.setattr(marked_words.pieces_of(PATH), "by_words", False)
    every = [r.text or "" for r in odd.collect()]
    codec = marked_words.build(odd, PATH)
    assert codec.table is None
    ids, decoded = marked_words.round_trip(every, codec, marked_words.pieces_of(PATH))
    assert ([i.tolist() for i in ids], [d.decode() for d in decoded]) == library(every)


def test_decoding_of_stored_ids(spark):
    df = spark.createDataFrame([(1, [523, 28713]), (2, []), (3, None), (None, [3, 4, 259, 28705]), (5, [1, 2])], "doc_id bigint, ids array<int>")
    got = {r.doc_id: r.decoded for r in marked_words.decode(df, PATH).collect()}
    model = marked_words.pieces_of(PATH).library
    assert got == {1: model.decode([523, 28713]), 2: "", 3: "", None: model.decode([3, 4, 259, 28705]), 5: model.decode([1, 2])}


def test_query_equals_the_library(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = {i: (len(x), sha(",".join(map(str, x))), sha(t)) for i, x, t in want_of(docs)}
    got = {r[0]: tuple(r)[1:] for r in queries.QUERIES["op12_marked_words"](spark, sf_dir).collect()}
    assert got == want
