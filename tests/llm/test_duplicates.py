from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from revmill.llm import common, exact_dedup, line_dedup, simhash


def test_golomb_round_trip():
    rnd = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 100, 5000):
        values = np.unique(rnd.integers(0, 2**64, n, np.uint64))
        assert (exact_dedup.golomb_decode(exact_dedup.golomb_encode(values)) == values).all()
    edge = np.array([0, 1, 2**64 - 1], np.uint64)
    assert (exact_dedup.golomb_decode(exact_dedup.golomb_encode(edge)) == edge).all()


def test_golomb_is_short():
    values = np.unique(np.random.default_rng(1).integers(0, 2**64, 8000, np.uint64))
    assert len(exact_dedup.golomb_encode(values)) < 8000 * 6.9


def test_exact_groups_of_odd_rows(odd, none):
    rows = exact_dedup.exact_groups(odd).collect()
    by_text = {}
    for r in odd.collect():
        by_text.setdefault(r.text or "", []).append(r.doc_id)
    want = sorted(
        ((i, max((x for x in ids if x is not None), default=None), len(ids)) for ids in by_text.values() for i in ids), key=repr
    )
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in rows), key=repr) == want
    assert all(r.kept == (r.doc_id == r.keep_id) for r in rows)
    assert exact_dedup.exact_groups(none).collect() == []


def test_exact_groups_with_a_hot_text(documents):
    rows = [(i, "same" if i % 3 == 0 else f"t{i // 2}") for i in range(3000)]
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.exact_groups(documents(rows)).collect()}
    groups = {}
    for i, t in rows:
        groups.setdefault(t, []).append(i)
    assert got == {i: (max(groups[t]), len(groups[t])) for i, t in rows}


def slow_fingerprint(text, size=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(ids, fps, bits=2):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [low.get(find(i)) for i in range(len(ids))]


def near_texts(seed=4, groups=12, copies=14):
    rnd = random.Random(seed)
    texts = []
    for _ in range(groups):
        base = [f"w{rnd.randint(0, 999)}" for _ in range(rnd.choice([5, 60, 400]))]
        for _ in range(rnd.randint(1, copies)):
            t = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2])):
                t[rnd.randrange(len(t))] = "x"
            texts.append(" ".join(t))
    return texts


def test_simhash_against_brute_force(documents, odd, none):
    rows = [(i, t) for i, t in enumerate(near_texts())] + [(900, None), (901, ""), (902, "a\x0bB c\x1cd"), (903, "é"), (904, "É")]
    for docs in (documents(rows), odd):
        own = [(r.doc_id, r.text) for r in docs.collect()]
        fps = [slow_fingerprint(t) for _, t in own]
        want = [(i, f"{f:016x}", c) for (i, _), f, c in zip(own, fps, slow_components([i for i, _ in own], fps))]
        got = [tuple(r) for r in simhash.near_duplicates(docs, 3, 2).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
    assert simhash.near_duplicates(none).collect() == []


@pytest.mark.parametrize("paired", [1, 3, 1000])
@pytest.mark.parametrize("bits", [0, 2, 4])
def test_links_whatever_way_a_cell_takes(spark, monkeypatch, paired, bits):
    monkeypatch.setattr(simhash, "PAIRED", paired)
    rnd = random.Random(bits)
    values = set()
    for _ in range(4):
        x = rnd.getrandbits(64)
        for _ in range(25 if bits < 4 else 8):
            y = x
            for _ in range(rnd.randint(0, 5)):
                y ^= 1 << rnd.randrange(64)
            values.add(y)
            x = y if rnd.random() < 0.3 else x
    fps = sorted(values)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(s,) for s in signed], "fp bigint")
    edges = [(r.a, r.b) for r in simhash.links(df, bits).collect()]
    mask = (1 << 64) - 1
    assert all(((a ^ b) & mask).bit_count() <= bits for a, b in edges)
    root = {s: s for s in signed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        root[find(a)] = find(b)
    want = slow_components(list(range(len(fps))), fps, bits)
    groups = {}
    for s, w in zip(signed, want):
        groups.setdefault(find(s), set()).add(w)
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want))


def test_links_needs_an_even_distance(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp bigint"), 3)


def test_components(spark):
    edges = [(5, 4), (4, 3), (9, 8), (3, 1), (7, 7), *[(100 + i, 101 + i) for i in range(40)], *[(1000, 2000 + i) for i in range(300)]]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {5: 1, 4: 1, 3: 1, 9: 8} | {101 + i: 100 for i in range(40)} | {2000 + i: 1000 for i in range(300)}
    assert got == want


def test_one_of_each_group_stays(documents, odd):
    docs = documents([(i, t) for i, t in enumerate(near_texts())])
    named = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(named.values()))
    ids = [r.doc_id for r in simhash.keep_one(odd).collect()]
    assert sorted(i for i in ids if i is not None) == [1, 4, 6, 8] and ids.count(None) == 2


def test_patience_diff():
    assert line_dedup.patience([1, 2, 3], [1, 2, 3]) == [(0, 0), (1, 1), (2, 2)]
    assert sorted(line_dedup.patience([1, 2, 3, 4], [9, 2, 3, 8])) == [(1, 1), (2, 2)]
    assert line_dedup.patience([1], [2]) == []
    # A block in another order aligns in a second pass.
    assert line_dedup.aligned([1, 2, 3, 4, 5, 6], [4, 5, 6, 1, 2, 3]) == [0, 1, 2, 3, 4, 5]
    rnd = random.Random(5)
    for _ in range(200):
        a, b = ([rnd.randint(0, 12) for _ in range(rnd.randint(0, 15))] for _ in range(2))
        pairs = sorted(line_dedup.patience(a, b))
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


def words(rnd, n):
    return " ".join(f"w{rnd.randint(0, 10**6)}" for _ in range(n))


def test_common_blocks_are_cut_from_the_later_document(documents):
    rnd = random.Random(6)
    passage, other, clean = words(rnd, 60) + ".", words(rnd, 30) + ". " + words(rnd, 30) + ".", words(rnd, 80) + "."
    short = words(rnd, 6) + "."
    rows = [
        (1, f"{words(rnd, 20)}.\n{passage}\n{words(rnd, 9)}."),
        (2, f"{words(rnd, 5)}. {other} {words(rnd, 5)}."),
        (3, f"alpha beta.\n{passage}\ngamma delta. {other} end."),
        (4, f"{clean}\n{short}"),
        (5, f"{words(rnd, 40)}.\n{short}\n{words(rnd, 40)}."),
        (6, f"{other}\n{passage}"),
    ]
    docs = documents(rows)
    got = {r.doc_id: r for r in line_dedup.drop_common_blocks(docs).collect()}
    texts = dict(rows)
    for i in (1, 2, 4, 5):
        assert got[i].text == texts[i] and got[i].removed is None and got[i].removed_lines == 0
    assert got[3].text == "alpha beta.\ngamma delta. end."
    assert [texts[3][s.begin : s.end].strip() for s in got[3].removed] == [passage, other]
    assert got[6].text == "" and got[6].removed_words == 120
    # Equal texts: the first stays whole.
    twins = {r.doc_id: r.text for r in line_dedup.drop_common_blocks(documents([(7, clean), (8, clean), (9, clean)])).collect()}
    assert twins == {7: clean, 8: "", 9: ""}


def test_a_passage_in_many_documents_makes_few_pairs(documents):
    rnd = random.Random(7)
    passage = words(rnd, 55) + "."
    docs = documents([(i, f"{words(rnd, 10)}.\n{passage}\n{words(rnd, 10)}.") for i in range(400)])
    got = line_dedup.drop_common_blocks(docs).collect()
    assert sum(passage in r.text for r in got) == 1 and min(r.doc_id for r in got if passage in r.text) == 0


def test_line_dedup_of_odd_rows(odd, none):
    rows = line_dedup.drop_common_blocks(odd).collect()
    assert len(rows) == odd.count()
    long = {r.doc_id: r.text for r in rows if r.doc_id in (4, 5)}
    assert len(long[4]) > 1000 and long[5] == ""
    assert {r.text for r in rows if r.doc_id == 6} == {"one two"} and {r.text for r in rows if r.doc_id == 1} == {None}
    assert line_dedup.drop_common_blocks(none).collect() == []


def test_clashing_columns_stay(odd):
    cut = line_dedup.drop_common_blocks(odd, prefix="__cut_").select(odd.columns)
    assert cut.schema.names == odd.schema.names
    assert sorted(r.key for r in cut.collect()) == sorted(r.key for r in odd.select(F.col("key")).collect())


def test_blocks_of_short_lines_are_cut(documents):
    rnd = random.Random(9)
    verse = "\n".join(words(rnd, rnd.choice([1, 2, 3])) for _ in range(40))
    dense = "\n".join("".join(chr(rnd.randrange(0x4E00, 0x9FFF)) for _ in range(9)) for _ in range(6))
    solid = "".join(rnd.choice("abcdef0123456789") for _ in range(2000))
    rows = [(1, verse), (2, verse), (3, f"{words(rnd, 9)}.\n{verse}\nthe end"), (4, dense), (5, dense), (6, solid), (7, solid)]
    got = {r.doc_id: r.text for r in line_dedup.drop_common_blocks(documents(rows)).collect()}
    texts = dict(rows)
    assert all(got[i] == texts[i] for i in (1, 4, 6)) and all(got[i] == "" for i in (2, 5, 7))
    assert got[3] == texts[3].replace(verse + "\n", "")


def plain_lines(text):
    """Hashed text, words, begin and end of each line, by regular expressions."""
    dense = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
    edges = sorted({0, len(text), *(m.end() for m in re.finditer(r"[.!?]+[^\S\n]+|\n", text))})
    out = []
    for a, b in zip(edges, edges[1:]):
        x = text[a:b].strip()
        if x:
            n = max(len(x.split()), -(-len(x) // line_dedup.WORD_CHARS))
            out.append((x, max(n, len(dense.findall(x)) + len(dense.sub(" ", x).split())), a, b))
    return out


def test_lines_equal_those_of_regular_expressions():
    rnd = random.Random(14)
    bits = ["a", "b c", "word", ".", "...", "!", "?", " ", "  ", "\n", "\r\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", "\u2003", "\u3000", "漢字", "ไท", "é", "x" * 50, "😀", "\U00020001"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 20))) for _ in range(4000)] + ["", "\n", ". ", "a.", "a. "]
    hashes, words, begin, end, edges = line_dedup.cut_lines(texts)
    names = {}
    for i, text in enumerate(texts):
        own = slice(edges[i], edges[i + 1])
        want = plain_lines(text)
        assert list(zip(words[own].tolist(), begin[own].tolist(), end[own].tolist())) == [w[1:] for w in want]
        for h, (x, *_) in zip(hashes[own].tolist(), want):
            assert names.setdefault(h, x) == x
    assert len(set(names.values())) == len(names)


def test_windows_cover_each_line_of_a_block():
    rnd = random.Random(10)
    for _ in range(200):
        sizes = [rnd.choice([1, 1, 2, 3, 7]) for _ in range(rnd.randint(1, 12))]
        edge = rnd.randint(0, len(sizes))
        edges = np.array([0, edge, len(sizes)])
        seen = set()
        for back in (False, True):
            for b, e in zip(*line_dedup.windows(np.array(sizes), edges, 4, back)):
                assert sum(sizes[b:e]) >= 4 and (e <= edge or b >= edge)
                assert sum(sizes[b + 1 : e] if back else sizes[b : e - 1]) < 4
                seen |= set(range(b, e))
        want = [i for a, b in ((0, edge), (edge, len(sizes))) if sum(sizes[a:b]) >= 4 for i in range(a, b)]
        assert sorted(seen) == want


def test_the_first_holder_of_a_block_is_aligned(documents):
    rnd = random.Random(11)
    long = [words(rnd, 9) + "." for _ in range(8)]
    # Each longer line has an earlier holder of its own, and what stands beside the short one differs.
    rows = [(i, f"{words(rnd, 7)}.\n{x}\n{words(rnd, 7)}.") for i, x in enumerate(long)]
    rows.append((20, "\n".join([*long[:4], "odd", "short", "even", *long[4:]])))
    copy = "\n".join([*long[:4], "short", *long[4:]])
    texts = dict([*rows, (21, copy), (22, rows[-1][1])])
    got = {r.doc_id: r.text for r in line_dedup.drop_common_blocks(documents(list(texts.items()))).collect()}
    assert got[21] == "" and got[22] == ""
    assert all(got[i] == texts[i] for i in range(8))


def test_blocks_without_an_anchor_are_aligned(documents):
    x, y = 1, 2
    assert line_dedup.aligned([x, y, x, y], [y, x, y, x]) == [0, 1, 2, 3]
    assert line_dedup.aligned([x, x, y, y], [y, y, x, x]) == [0, 1, 2, 3]
    rnd = random.Random(13)
    for _ in range(300):
        a, b = ([rnd.randint(0, 3) for _ in range(rnd.randint(0, 9))] for _ in range(2))
        i, j, n = line_dedup.longest_run(a, b)
        assert a[i : i + n] == b[j : j + n]
        assert not any(a[p : p + n + 1] == b[q : q + n + 1] for p in range(len(a) - n) for q in range(len(b) - n))
    one, two = words(rnd, 30) + ".", words(rnd, 12) + ".\n" + words(rnd, 16) + "."
    rows = [(1, f"{one}\n{two}\n{one}\n{two}"), (2, f"{two}\n{one}\n{two}\n{one}"), (3, "\n".join([two, one] * 4)), (4, "no. " * 3 + "yes."), (5, "no. " * 40)]
    got = {r.doc_id: r.text for r in line_dedup.drop_common_blocks(documents(rows)).collect()}
    assert got == {1: rows[0][1], 2: "", 3: "", 4: rows[3][1], 5: rows[4][1]}
