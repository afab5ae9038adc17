from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from revmill.llm import collocations, lookup, packed


def counts(rows, most=5):
    """Occurrences of every phrase by language, and all words."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for size in range(1, most + 1):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i : i + size])] += 1
    return f, n


def brute(rows, least, most, percent, top):
    f, n = counts(rows, most)
    often = {k: a for k, a in f.items() if a >= least}
    longer: dict = {}
    for (lang, w), a in often.items():
        for size in range(2, len(w)):
            for i in range(len(w) - size + 1):
                key = (lang, w[i : i + size])
                longer[key] = max(longer.get(key, 0), a)
    out = []
    for (lang, w), a in often.items():
        if len(w) < 2 or (key := longer.get((lang, w))) is not None and 100 * key >= percent * a:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.append((lang, " ".join(w), a, f[lang, w[:k]], f[lang, w[k:]], n[lang], score))
    ranked = []
    for lang in {r[0] for r in out}:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(lang, i, *r[1:]) for i, r in enumerate(own[:top], 1)]
    return sorted(ranked)


def docs_of(spark, rows, parts=4):
    schema = "doc_id bigint, text string, lang string, size int, phrase string, n bigint, total bigint, hash string"
    return spark.createDataFrame([(i, t, g, 1, "p", 2, 3, "h") for i, (g, t) in enumerate(rows)], schema).repartition(parts)


def corpus(n, seed):
    rnd = random.Random(seed)
    words = ["the", "The", "of", "New", "new", "york", "city", "É", "é", "in", "a", "漢字", "x\x1cy", "hall"]
    rows = []
    for i in range(n):
        parts = [rnd.choice(words) if rnd.random() < 0.6 else f"w{rnd.randint(0, 400)}" for _ in range(rnd.randint(0, 60))]
        if i % 4 == 0:
            parts += ["City", "of", "New", "York"] * rnd.randint(1, 3)
        text = "".join(w + rnd.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\x0b", " ; "]) for w in parts)
        rows.append((rnd.choice(["en", "en", "de", None, "und"]), text))
    return rows + [("en", None), (None, ""), ("fr", " .\t"), ("fr", None), ("en", "tail end")]


@pytest.mark.parametrize(
    "shard_chars,least,percent,top", [(2000, 1, 100, 50), (1, 3, 100, 2000), (2000, 12, 80, 20), (10**9, 3, 90, 40), (2000, 10**6, 100, 10)]
)
def test_results_equal_brute_force(spark, shard_chars, least, percent, top):
    rows = corpus(60 if least == 1 else 300, least)
    got = collocations.collocations(docs_of(spark, rows), least, 5, percent, top, shard_chars)
    assert sorted(map(tuple, got.collect())) == brute(rows, least, 5, percent, top)


def test_frequent_phrases_of_shards_that_differ(spark):
    """A phrase that a few shards hold alone, and one that each shard holds a little of."""
    rows = [("en", "rare pair " * 40)] + [("en", f"thin spread w{i} w{i + 1} w{i + 2}") for i in range(200)]
    f, n = counts(rows)
    frequent, langs = collocations.frequent_phrases(docs_of(spark, rows, 7), 40, 5, 300)
    want = sorted(("en", len(w), " ".join(w), a) for (_, w), a in f.items() if a >= 40)
    assert sorted((r.lang, r.size, r.phrase, r.a) for r in frequent.collect()) == want and [tuple(r) for r in langs.collect()] == [("en", n["en"])]


def test_local_supports_add_up():
    rnd = random.Random(3)
    for _ in range(500):
        chars = [rnd.randint(0, 50) for _ in range(rnd.randint(1, 12))]
        least = rnd.randint(1, 40)
        local = [collocations.local_support(least, c, sum(chars)) for c in chars]
        assert sum(x - 1 for x in local) < least


def test_the_rest_of_a_task_is_no_small_shard(spark):
    def sizes(chars):
        batch = pa.RecordBatch.from_arrays([pa.array(["en"] * chars), pa.array(["x"] * chars), pa.array([chars] * chars)], ["lang", "text", "total"])
        return [sum(s.chars) for s in collocations.shards(iter([batch.slice(i, 1) for i in range(chars)]), 10)]

    assert sizes(0) == [] and sizes(3) == [3] and sizes(10) == [10] and sizes(14) == [14]
    assert sizes(15) == [10, 5] and sizes(24) == [10, 14] and sizes(25) == [10, 10, 5]


@pytest.mark.parametrize("most", [1, 2, 3])
def test_shorter_phrases_alone(spark, most):
    rows = corpus(120, 5)
    f, _ = counts(rows, most)
    frequent, _ = collocations.frequent_phrases(docs_of(spark, rows), 6, most, 1500)
    want = sorted((lang, len(w), " ".join(w), a) for (lang, w), a in f.items() if a >= 6)
    assert sorted((r.lang, r.size, r.phrase, r.a) for r in frequent.collect()) == want


def test_odd_rows(odd, none):
    rows = [(r.lang, r.text) for r in odd.collect()]
    got = collocations.collocations(odd, 2, 3, 100, 100_000)
    assert sorted(map(tuple, got.collect())) == brute(rows, 2, 3, 100, 100_000)
    assert collocations.collocations(none).collect() == []


def test_ranks_of_parts_join(spark):
    rows = corpus(200, 7)
    for top in (1, 15):
        got = collocations.collocations(docs_of(spark, rows), 4, 5, 100, top)
        assert sorted(map(tuple, got.collect())) == brute(rows, 4, 5, 100, top)


def test_scores_beyond_64_bits(spark):
    a, n, l, r = 123_456_789_012, 10**14 + 7, 223_456_789_012, 323_456_789_013
    frequent = spark.createDataFrame([("en", 2, "x y", a), ("en", 1, "x", l), ("en", 1, "y", r)], "lang string, size int, phrase string, a bigint")
    row = collocations.weakest_cuts(frequent, spark.createDataFrame([("en", n)], "lang string, n bigint")).first()
    assert (row.l, row.r, row.score) == (l, r, 1000 * a * n // (l * r))


def test_hash_files_hold_every_hash(spark, tmp_path):
    rnd = random.Random(2)
    values = sorted({rnd.getrandbits(64) - (1 << 63) for _ in range(5000)} | {-(1 << 63), -1, 0, 1, (1 << 63) - 1})
    df = lookup.dealt(spark.createDataFrame([(v,) for v in values], "hash bigint"), 7, "hash").sortWithinPartitions("shard", "hash")
    places = lookup.written(df.withColumn("v", df.hash % 1000).mapInArrow(lookup.hash_files(str(tmp_path), "hash", "v"), lookup.FILES))
    assert places.rows == len(values) and (np.diff(places.first) > 0).all() and len(places.first) == 7
    others = {rnd.getrandbits(64) - (1 << 63) for _ in range(5000)}
    wanted = list(others | set(values))
    rnd.shuffle(wanted)
    wanted = np.array(wanted, np.int64)
    known, (beside,) = lookup.beside(places, wanted)
    assert (known == np.isin(wanted, values)).all() and (lookup.holds(places, wanted) == known).all()
    assert (beside == np.where(known, np.fmod(wanted, 1000), 0)).all()
    assert not lookup.holds(lookup.Places(np.zeros(0, np.int64), [], 0), wanted).any()


def test_packed_columns_come_back():
    rnd = np.random.default_rng(4)
    for n in (0, 1, 2, 5000):
        hashes = np.sort(rnd.integers(-(2**63), 2**63, n, np.int64))
        beside = [rnd.integers(0, 2**32, n, np.uint32), np.arange(n, dtype=np.uint16), rnd.integers(-9, 9, n)]
        got = packed.unpack(packed.pack(hashes, *beside))
        assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(got, [hashes, *beside], strict=True))


def test_shards_and_their_phrases_are_whole(spark):
    shard = collocations.Shard(with_text=True)
    shard.add(["A b\tc, d", ""], ["en", "de"], [8, 1])
    shard.add(["É  F g"], ["en"], [8])
    shard.close()
    assert shard.words == 7 and shard.phrase(np.array([0, 4]), 3) == ["a b c", "É f g"]
    kept = Counter()
    for size, hashes, count, example in shard.levels(5, lambda size, h, c, lang: np.ones(len(h), bool)):
        kept[size] += len(hashes)
        assert len(hashes) == len(count) == len(example)
    assert kept == {1: 7, 2: 4, 3: 2}
