from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from revmill.llm import merkle, queries


def H(*inputs):
    return hashlib.sha256("".join(inputs).encode()).hexdigest()


def leaf_of(row, names, **instead):
    values = [instead.get(n, row[n]) for n in names]
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes, fanout):
    """The top, and of each leaf the siblings before and after it on every level."""
    paths, own, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for i, o in enumerate(own):
            first = o // fanout * fanout
            run = level[first : first + fanout]
            paths[i].append((run[: o - first], run[o - first + 1 :]))
            own[i] = o // fanout
        level = [H(*level[i : i + fanout]) for i in range(0, len(level), fanout)]
    return level[0], paths


def brute(rows, names, group, order, fanout=3):
    """(order, leaf, subroot, root, siblings) of each row."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[group]].append(r)
    first = lambda v: (v is not None, v.encode() if isinstance(v, str) else v or 0)
    keys = sorted(groups, key=first)
    made = {}
    for k in keys:
        own = sorted(groups[k], key=lambda r: (first(r[order]), leaf_of(r, names)))
        made[k] = (own, *tree([leaf_of(r, names) for r in own], fanout))
    root, above = tree([made[k][1] for k in keys], fanout)
    out = []
    for k, up in zip(keys, above):
        own, top, paths = made[k]
        for r, path in zip(own, paths):
            out.append((r[order], leaf_of(r, names), top, root, [("".join(a), "".join(b)) for a, b in path + up]))
    return sorted(out, key=repr)


def own_rows(df, order="doc_id"):
    out = []
    for r in df.collect():
        path = [(s.before.hex(), s.after.hex()) for s in r.path]
        out.append((r[order], r.leaf.hex(), r.subroot.hex(), r.root.hex(), path))
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, g int, pos string").repartition(3)


def rows_of(n, sources):
    return [(i * 7 % 1009, f"a{i}\nb" if i % 3 else None, None if i % 5 == 0 else "en", sources[i * i % len(sources)], i, i, "x") for i in range(n)]


@pytest.mark.parametrize("n,fanout", [(1, 3), (4, 3), (200, 3), (30, 2), (40, 5)])
def test_trees_equal_brute_force(spark, n, fanout):
    docs = table(spark, rows_of(n, [None, "", "é", "z", "Z", "same", "same", "same", "same"]))
    want = brute([r.asDict() for r in docs.collect()], merkle.FIELDS, "source", "doc_id", fanout)
    assert own_rows(merkle.manifest(docs, fanout=fanout)) == want


def test_odd_rows_and_columns_of_the_same_names(odd, none):
    want = brute([r.asDict() for r in odd.collect()], merkle.FIELDS, "source", "doc_id")
    assert own_rows(merkle.manifest(odd)) == want
    assert merkle.manifest(none).collect() == []


def test_any_columns_can_be_group_and_order(spark):
    docs = table(spark, rows_of(40, ["s", "t"]))
    want = brute([r.asDict() for r in docs.collect()], ["text", "g"], "lang", "g")
    assert own_rows(merkle.manifest(docs, ["text", "g"], "lang", "g"), "g") == want


def test_repeated_rows_are_leaves_of_their_own(spark):
    docs = table(spark, [(1, "x", "en", "s", 1, 1, "p")] * 50 + [(1, "y", "en", "s", 1, 1, "p")] * 3)
    want = brute([r.asDict() for r in docs.collect()], merkle.FIELDS, "source", "doc_id")
    got = own_rows(merkle.manifest(docs))
    assert got == want and len(got) == 53


def test_paths_lead_to_the_root_until_a_row_changes(spark):
    docs = table(spark, rows_of(120, ["s", "t", None]))
    found = {"text": F.when(F.col("doc_id") % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))}
    rows = merkle.manifest(docs, audited=found)
    folded = rows.select("doc_id", "leaf", "audited_leaf", "root", merkle.fold(F.col("audited_leaf"), F.col("path")).alias("top"))
    texts = {r.doc_id: r for r in docs.collect()}
    for r in folded.collect():
        text = texts[r.doc_id].text
        changed = r.doc_id % 2 == 0 and text is not None and "\n" in text
        assert (r.top == r.root) is not changed
        seen = text.replace("\n", "") if changed else text
        assert r.audited_leaf.hex() == leaf_of(texts[r.doc_id].asDict(), merkle.FIELDS, text=seen)


@pytest.fixture
def many_tasks(spark):
    """Each range in a task of its own, however small."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_trees_over_several_tasks(spark, many_tasks):
    docs = table(spark, rows_of(300, [None, "", "z", "same", "same"]) + rows_of(40, ["same"]))
    want = brute([r.asDict() for r in docs.collect()], merkle.FIELDS, "source", "doc_id")
    assert own_rows(merkle.manifest(docs)) == want


def test_positions_are_gapless(spark, many_tasks):
    rows = [(None if i % 4 == 0 else f"k{i % 3}", i * 37 % 1000) for i in range(1000)] + [("k1", 5)] * 300
    df = spark.createDataFrame(rows, "k string, v int").repartition(5)
    got = defaultdict(list)
    ranked = merkle.ranked(df, ["k"], ["v"])
    assert len(ranked.inputFiles()) > 4
    for r in ranked.collect():
        got[r.k].append((r["__pos"], r.v, r["__size"]))
    for own in got.values():
        own.sort()
        assert [p for p, _, _ in own] == list(range(len(own))) and {s for _, _, s in own} == {len(own)}
        assert [v for _, v, _ in own] == sorted(v for _, v, _ in own)


def test_query_equals_brute_force(spark, sf_dir):
    df = queries.QUERIES["op13_merkle"](spark, sf_dir).cache()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    want = {r[0]: r[1:] for r in brute([r.asDict() for r in docs], merkle.FIELDS, "source", "doc_id")}
    for r in df.collect():
        leaf, subroot, root, path = want[r.doc_id]
        assert (r.leaf, r.subroot, r.root) == (leaf, subroot, root)
        assert r.proof_sha256 == H(*[x for step in path for x in step])
        assert r.verified == (r.folded_root == root)
    cut = [d for d in docs if zlib.crc32(str(d.doc_id).encode()) % 2 == 0 and "\n" in (d.text or "")]
    assert df.filter("NOT verified").count() == len(cut) > 0
