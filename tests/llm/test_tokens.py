from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from revmill.llm import bpe, packing, token_counts
from revmill.session import scratch

PATH = bpe.default_tokenizer()


def library_ids(texts):
    e = bpe.encoder(PATH)
    return [e.library.encode(t, add_special_tokens=False).ids for t in texts]


def own_ids(texts):
    out = []
    for _, counts, ids in bpe.encoder(PATH).encode(texts):
        out += [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    return out


def test_ids_equal_the_library():
    rnd = random.Random(3)
    bits = ["'s", "'", "'ll", "'re'", " ", "  ", "\n", "\t", "a", "Zé", "ß", "1", "٣", "½", "!", "...", "漢字", "　", "\xa0", "\x1c"]
    bits += ["don't", "we've'd", "<|endoftext|>", "<|end", "'S", "😀", "\x85", "\r\n", "l", "v", "t", "é"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 14))) for _ in range(4000)] + ["", "'", " ", "'s", "  a"]
    assert own_ids(texts) == library_ids(texts)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_counts_of_other_files(name):
    import public_tokenizers

    path = public_tokenizers.path(name)
    e = bpe.encoder(path)
    texts = ["Hello there", "", "a <|endoftext|> b", "x  y\n"]
    counts = [int(c) for _, n, _ in e.encode(texts, want_ids=False) for c in n]
    assert counts == [len(e.library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_cache_encodes_only_misses(spark, documents, monkeypatch):
    cache = scratch(spark, "cache")
    first = documents([(1, "alpha beta"), (2, "alpha beta"), (3, None)])
    want = {1: len(library_ids(["alpha beta"])[0]), 3: 0}
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(first, PATH, cache).collect()}
    assert got == {1: (10, want[1]), 2: (10, want[1]), 3: (0, 0)}
    assert spark.read.parquet(cache).count() == 2
    second = documents([(9, "alpha beta"), (8, "gamma"), (7, "gamma")])
    token_counts.count_tokens(second, PATH, cache).collect()
    assert spark.read.parquet(cache).count() == 3
    # What is stored is what is answered: a hit is not encoded again.
    version = token_counts.version_of(PATH)
    digest = token_counts.read_cache(spark, cache, version).collect()
    assert len(digest) == 3 and len({r.digest for r in digest}) == 3


def test_counts_of_odd_rows(odd, none, spark):
    rows = token_counts.count_tokens(odd, PATH, scratch(spark, "cache")).collect()
    texts = {(r.doc_id, len((r.text or "").encode())): len(library_ids([r.text or ""])[0]) for r in odd.collect()}
    assert len(rows) == odd.count()
    assert all(texts[(r.doc_id, r.n_bytes)] == r.n_tokens for r in rows)
    assert token_counts.count_tokens(none, PATH, scratch(spark, "cache")).collect() == []


def smallest(sizes, capacity):
    """Fewest bins, by trying every way to put the next piece."""
    best = len(sizes)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(sizes):
            best = len(bins)
            return
        for room in set(bins):
            if room >= sizes[i]:
                b = list(bins)
                b.remove(room)
                go(i + 1, [*b, room - sizes[i]])
        go(i + 1, [*bins, capacity - sizes[i]])

    go(0, [])
    return best


def test_bin_completion_reaches_the_optimum():
    rnd = random.Random(8)
    for _ in range(60):
        sizes = sorted((rnd.randint(2, 20) for _ in range(rnd.randint(1, 9))), reverse=True)
        counts = defaultdict(int)
        for s in sizes:
            counts[s] += 1
        plan = packing.complete_bins(dict(counts), 20)
        used = defaultdict(int)
        for pattern, times in plan:
            assert sum(s * k for s, k in pattern.items()) <= 20
            for s, k in pattern.items():
                used[s] += k * times
        assert used == counts
        assert sum(t for _, t in plan) == smallest(sizes, 20)


def test_fillings_are_undominated():
    counts = {7: 2, 5: 3, 3: 1, 2: 4}
    for room in range(1, 15):
        found = packing.fillings(counts, room)
        assert all(sum(f) <= room for f in found)
        for a, b in combinations([f for f in found if len(f) == 1], 2):
            assert a != b
        wastes = [room - sum(f) for f in found]
        assert wastes == sorted(wastes)


def check_packing(rows, docs, capacity):
    texts = [r.text or "" for r in docs.collect()]
    want = sorted(zlib.crc32(np.array([*ids, 0], "<u4").tobytes()) for ids in library_ids(texts) if len(ids) < capacity)
    assert sorted(r.ids_crc32 for r in rows if r.start == 0 and r.piece == 0 and r.length <= capacity)[:0] == []
    whole = [r for r in rows if r.piece == 0]
    assert len(whole) == len(texts)
    short = sorted(r.ids_crc32 for r in whole if r.length <= capacity)
    assert set(want) <= set(short)
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert sum(r.length for r in rows) == sum(len(i) + 1 for i in library_ids(texts))
    return len(bins)


def test_packing_of_odd_rows(odd, none):
    rows = packing.pack_documents(odd, PATH, 2048, 0).collect()
    assert check_packing(rows, odd, 2048) == -(-sum(r.length for r in rows) // 2048)
    long = sorted((r.piece, r.start, r.length) for r in rows if r.doc_id == 4)
    assert [x[2] for x in long[1:]] == [2048] * (len(long) - 1) and 1 <= long[0][2] <= 2048
    assert [x[1] for x in long] == [0, *np.cumsum([x[2] for x in long])[:-1].tolist()]
    assert packing.pack_documents(none, PATH).collect() == []


def test_packing_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(300)
    rows = packing.pack_documents(docs, PATH, 2048, 0).collect()
    n = check_packing(rows, docs, 2048)
    assert n <= -(-sum(r.length for r in rows) // 2048) + 1


def test_pieces_can_carry_their_ids(documents):
    docs = documents([(1, "alpha beta gamma")])
    row = packing.token_pieces(docs, PATH, 4, 0, with_ids=True).orderBy("piece").collect()
    assert [i for r in row for i in r.ids] == [*library_ids(["alpha beta gamma"])[0], 0]


def skewed(seed):
    rnd = random.Random(seed)
    sizes = [min(2048, max(20, int(rnd.lognormvariate(6.4, 0.8)))) for _ in range(1200)] + [1500] * 400
    return Counter(sizes)


def test_whole_branches_of_the_search_end():
    for seed in (0, 5):
        counts = dict(skewed(seed))
        plan, bound, nodes = packing.search(counts, 2048)
        packed = Counter()
        for pattern, times in plan:
            assert sum(s * k for s, k in pattern.items()) <= 2048
            packed.update({s: k * times for s, k in pattern.items()})
        assert packed == counts and nodes > len(counts)
        assert bound <= sum(t for _, t in plan) < sum(t for _, t in packing.best_fit(counts, 2048))


def test_fillings_hold_any_number_of_pieces():
    assert packing.fillings({8: 1, 1: 1, 3: 3}, 10) == [(3, 3, 3, 1), (8, 1)]
    assert packing.fillings({2: 9}, 18) == [(2,) * 9]
    rnd = random.Random(12)
    for _ in range(100):
        sizes = sorted((rnd.randint(1, 12) for _ in range(rnd.randint(1, 8))), reverse=True)
        room = rnd.randint(1, 20)
        every = {c for n in range(9) for c in combinations(sizes, n) if sum(c) <= room}
        want = {a for a in every if not any(a != b and packing.contained(a, b) for b in every)}
        found = packing.fillings(Counter(sizes), room)
        assert set(found) == want and len(found) == len(want)


def test_containment_is_a_packing():
    assert packing.contained((3, 3), (7,)) and packing.contained((5, 3, 2), (6, 5))
    assert not packing.contained((3, 3, 3), (8, 1)) and not packing.contained((4, 4), (7, 2))


def test_lazy_fillings_save_sequences():
    counts = dict(skewed(2))
    assert sum(t for _, t in packing.complete_bins(counts, 2048)) <= 769
