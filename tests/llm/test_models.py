from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from revmill.llm import decontam, kd_shards, kneser_ney, queries, toxicity
from revmill.llm.common import fold


def slow_words(text):
    return [w for w in "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()]


def slow_shingles(text, size=5):
    w = slow_words(text)
    return {" ".join(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def test_contained_items_against_brute_force(spark, documents, odd, none):
    rnd = random.Random(2)
    word = lambda: f"w{rnd.randint(0, 5000)}"
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([1, 3, 4, 5, 6, 9, 12, 14, 20, 33, 40, 65, 70])]
    items += [(90, None), (91, "..."), (92, "one two"), (93, items[8][1])]
    rows = []
    for d in range(150):
        text = [word() for _ in range(rnd.choice([3, 30, 300]))]
        for _ in range(rnd.randint(0, 2)):
            part = items[rnd.randrange(13)][1].split()
            for _ in range(rnd.choice([0, 0, 1, 1, 2])):
                part[rnd.randrange(len(part))] = "changed"
            at = rnd.randrange(len(text))
            text[at:at] = part
        rows.append((d, " ".join(w.upper() + "," if rnd.random() < 0.1 else w for w in text)))
    rows += [(200, "w1"), (201, items[0][1]), (202, items[1][1].upper()), (203, None), (None, items[9][1])]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    docs = documents(rows)
    want = []
    for d, text in rows:
        held = slow_shingles(text)
        for i, t in items:
            own = slow_shingles(t)
            if own and len(own & held) >= 0.8 * len(own):
                want.append((d, i, len(own), len(own & held)))
    got = [tuple(r)[:4] for r in decontam.contained_items(docs, bench).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr) and len(want) > 40
    gone = {x[0] for x in want}
    left = decontam.drop_contaminated(docs, bench)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(d for d, _ in rows if d not in gone)
    assert {(r.doc_id, r.item_id) for r in decontam.contained_items(odd, bench).collect()} == {(6, 92), (7, 92), (None, 92)}
    assert decontam.contained_items(none, bench).collect() == []
    assert decontam.contained_items(docs, bench.limit(0)).collect() == []


def test_decontamination_runs_no_python(spark, sf_dir):
    plan = queries.op2_decontamination(spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))


def toxic_documents(n=700, seed=1):
    rnd = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        lines = [" ".join(f"v{rnd.randint(0, 300)}" for _ in range(rnd.randint(3, 12))) for _ in range(rnd.randint(2, 8))]
        if bad:
            at = rnd.randrange(len(lines))
            lines[at] += rnd.choice([" horrid", " vilestem" + rnd.choice("abcdefgh") + rnd.choice("ijklmnop"), " NASTY"])
        rows.append((i, ". ".join(lines)))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_learns_and_finds_sentences(spark, documents):
    rows, labels = toxic_documents()
    docs, table = documents(rows), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    learned = F.col("doc_id") % 5 != 4
    model = toxicity.train(docs, table, (F.col("doc_id") / 5).cast("int") % 4 != 0)
    scored = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [(i, y) for i, y in labels if i // 5 % 4 == 0]
    right = sum((scored[i].score >= 0.5) == bool(y) for i, y in held)
    assert right >= 0.95 * len(held)
    texts = dict(rows)
    for i, y in held:
        for s in scored[i].sentences if y else []:
            assert any(w in texts[i][s.begin : s.end].lower() for w in ("horrid", "vilestem", "nasty"))
    clean = toxicity.drop_toxic(docs, table, learned)
    assert clean.columns == docs.columns
    gone = {i for i, _ in rows} - {r.doc_id for r in clean.collect()}
    assert len(gone & {i for i, y in labels if y}) >= 0.95 * 140 and len(gone - {i for i, y in labels if y}) <= 5


def test_toxicity_fits_the_same_model_whatever_the_order(documents, spark):
    rows, labels = toxic_documents(200)
    table = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    a = toxicity.train(documents(rows), table, F.lit(True))
    b = toxicity.train(documents(rows[::-1]).repartition(7), table, F.lit(True))
    assert a.bias == b.bias and (a.features == b.features).all() and (a.weights == b.weights).all()


def test_toxicity_of_odd_rows(odd, none, spark):
    kinds = "doc_id bigint, toxic int"
    none_known = toxicity.train(odd, spark.createDataFrame([(1, None), (77, 1)], kinds), F.lit(True))
    rows = toxicity.score(odd, none_known).collect()
    assert len(rows) == odd.count() and all(0 <= r.score < 0.5 for r in rows)
    one = toxicity.train(odd, spark.createDataFrame([(6, 1), (7, 1)], kinds), F.lit(True))
    assert {r.score >= 0.5 for r in toxicity.score(odd, one).collect() if r.doc_id == 4} == {True}
    assert toxicity.score(none, one).collect() == []
    empty = toxicity.train(none, spark.createDataFrame([], kinds), F.lit(True))
    assert toxicity.drop_toxic(odd, spark.createDataFrame([], kinds), F.lit(True)).count() == odd.count() and empty.bias < 0


class SlowModel:
    """The bigram model from dictionaries of strings."""

    def __init__(self, texts):
        self.pairs, self.words, self.follow = Counter(), Counter(), Counter()
        for t in texts:
            tokens = self.tokens(t)
            self.words.update(tokens)
            self.pairs.update(zip(["<s>", *tokens], tokens))
        self.before = Counter(w for _, w in self.pairs)
        self.total = Counter()
        for (u, _), c in self.pairs.items():
            self.total[u] += c
        seen = lambda counts: [sum(c == k for c in counts.values()) for k in (1, 2, 3, 4)]
        self.d1, self.d2 = kneser_ney.discounts(seen(self.before)), kneser_ney.discounts(seen(self.pairs))

    @staticmethod
    def tokens(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for c in "\t\n\x0b\x0c\r":
            low = low.replace(c, " ")
        return [w for w in low.split(" ") if w] + ["</s>"]

    def p(self, w, u):
        def off(c, d):
            return max(c - d[min(c, 3) - 1], 0) if c else 0

        def spare(counts, d):
            return sum(d[min(c, 3) - 1] for c in counts)

        v, n = len(self.words), len(self.pairs)
        lower = off(self.before[w], self.d1) / n + spare(self.before.values(), self.d1) / n / (v + 1)
        if not self.total[u]:
            return lower
        return (off(self.pairs[u, w], self.d2) + spare([c for (a, _), c in self.pairs.items() if a == u], self.d2) * lower) / self.total[u]


def test_kneser_ney_against_a_plain_model(documents, monkeypatch):
    monkeypatch.setattr(kneser_ney, "HELD", 50)
    rnd = random.Random(9)
    vocabulary = ["the", "The", "a", "of", "Ünï", "x\x1cy", *[f"w{i}" for i in range(25)]]
    rows = [(i, "".join(rnd.choice(vocabulary) + rnd.choice([" ", "\n", "\t "]) for _ in range(rnd.randint(0, 30)))) for i in range(120)]
    rows += [(500, None), (501, "never seen words"), (None, "the a")]
    learn = [t for i, t in rows if i is not None and i % 3]
    slow = SlowModel(learn)
    docs = documents(rows)
    model = kneser_ney.train(docs, F.col("doc_id") % 3 != 0)
    assert (model.tokens, model.vocabulary, model.distinct_pairs) == (sum(slow.words.values()), len(slow.words), len(slow.pairs))
    got = {r.doc_id: r for r in kneser_ney.score(docs, model).collect()}
    for i, t in rows:
        tokens = slow.tokens(t)
        score = sum(math.log10(slow.p(w, u)) for u, w in zip(["<s>", *tokens], tokens))
        base = sum(math.log10((slow.words[w] + 0.1) / (model.tokens + 0.1 * (model.vocabulary + 1))) for w in tokens)
        assert got[i].n_tokens == len(tokens) and got[i].n_known == sum(slow.words[w] > 0 for w in tokens)
        assert got[i].score == pytest.approx(score) and got[i].base_score == pytest.approx(base)
    for u in ("the", "<s>", "unknown"):
        total = sum(slow.p(w, u) for w in slow.words) + slow.p("unheard", u)
        assert total == pytest.approx(1)


def test_kneser_ney_of_odd_rows(odd, none):
    model = kneser_ney.train(none, F.lit(True))
    rows = kneser_ney.score(odd, model).collect()
    assert len(rows) == odd.count() and all(r.score == 0 and r.base_score == 0 for r in rows)
    own = kneser_ney.train(odd, F.lit(True))
    rows = kneser_ney.score(odd, own).collect()
    assert all(r.score < 0 and r.n_known == r.n_tokens for r in rows)
    assert kneser_ney.score(none, own).collect() == []


def test_packed_counts_round_trip():
    rnd = np.random.default_rng(0)
    pool = rnd.integers(0, 2**64, 50, np.uint64)
    u, w, c = rnd.choice(pool, 300), rnd.choice(pool, 300), rnd.integers(1, 2**40, 300)
    back = kneser_ney.unpack_pairs(kneser_ney.pack_pairs(u, w, c))
    assert Counter(zip(u.tolist(), w.tolist(), c.tolist())) == Counter(zip(*(x.tolist() for x in back)))
    h, columns = np.sort(pool), rnd.integers(0, 2**40, (kneser_ney.WORD_COLUMNS, 50))
    a, b = kneser_ney.unpack_words(kneser_ney.pack_words(h, columns))
    assert (a == h).all() and (b == columns).all()


def check_shards(rows, shards, slack):
    size, slots = Counter(), {}
    for r in rows:
        size[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(size) <= set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(size.values()) / shards
    assert max(size.values()) <= mean + slack and min(size[s] for s in range(shards)) >= mean - slack


def test_kd_shards_are_even(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = kd_shards.kd_shards(docs, 24).collect()
    assert len(rows) == docs.count()
    check_shards(rows, 24, 2 * max(r.size for r in rows))
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    assert all(r.size == len(texts[r.doc_id]) + 8 and r.text_crc32 == zlib.crc32(texts[r.doc_id]) for r in rows)


def test_kd_shards_with_a_hot_text_and_source(documents):
    rows = [(i, "hot text " * 5 if i % 3 else f"text {i} " * (i % 40)) for i in range(6000)]
    got = kd_shards.kd_shards(documents(rows), 24).collect()
    check_shards(got, 24, 1500)
    # Groups that are small beside a shard stay together.
    pairs = [(i, f"pair {i // 2} " * 10) for i in range(4000)]
    shards = {}
    for r in kd_shards.kd_shards(documents(pairs), 7).collect():
        shards.setdefault(r.doc_id // 2, set()).add(r.shard)
    assert all(len(s) == 1 for s in shards.values())


def test_kd_shards_of_odd_rows(odd, none):
    rows = kd_shards.kd_shards(odd, 3).collect()
    assert len(rows) == odd.count() and {r.size for r in rows if r.doc_id in (1, 2)} == {8}
    assert kd_shards.kd_shards(none, 24).collect() == []


def test_fold_is_crc32_of_the_id(spark):
    got = [r[0] for r in spark.range(50).select(fold(5, "id")).collect()]
    assert got == [zlib.crc32(str(i).encode()) % 5 for i in range(50)]
