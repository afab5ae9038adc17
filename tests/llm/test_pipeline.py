from __future__ import annotations

import random

import corpus_pipeline
import pytest
from revmill.llm import common, line_dedup, queries, simhash
from revmill.session import scratch


@pytest.fixture(scope="module")
def corpus(spark):
    """A folder with planted toxic, repeated, copied and leaked documents, and the ids that
    must go or stay."""
    rnd = random.Random(11)

    def words(n):
        return " ".join(f"w{rnd.randint(0, 10**5)}" for _ in range(n))

    rows, labels = [], []
    for i in range(600):
        text = ". ".join(words(12) for _ in range(8))
        if i % 10 == 0:
            text += ". you horrid thing"
        rows.append((i, text))
        labels.append((i, 0, int(i % 10 == 0)))
    item = words(30)
    rows.append((1000, f"{words(40)}.\n{item} {words(20)}."))
    near = words(300).split()
    rows.append((1001, " ".join(near)))
    rows.append((1002, " ".join(near) + "!"))
    rows.append((1003, rows[1][1]))
    rows += [(1004, None), (1005, "")]
    path = scratch(spark, "corpus")
    full = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    spark.createDataFrame(full, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(5, item)], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_keep_the_columns_and_the_clean(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    columns = docs.columns
    ids = {}
    for name, stage in corpus_pipeline.STAGES:
        path = scratch(spark, name)
        stage(spark, docs, corpus).write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "packing":
            assert docs.columns == columns
        ids[name] = {r.doc_id for r in docs.select("doc_id").collect()}
    toxic = {i for i in range(0, 600, 10)}
    clean = set(range(600)) - toxic
    assert not ids["toxicity"] & toxic and clean <= ids["toxicity"]
    assert 1003 not in ids["line_dedup"] and clean <= ids["line_dedup"]
    assert ids["simhash"] == ids["line_dedup"] - {1002, 1005}
    assert ids["decontamination"] == ids["simhash"] - {1000}
    assert ids["packing"] == ids["decontamination"]


def test_run_is_the_stages(spark, corpus):
    rows = corpus_pipeline.run(spark, corpus).collect()
    assert {r.doc_id for r in rows} >= {i for i in range(600) if i % 10}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash", "decontamination", "packing"]


def test_line_dedup_stage_agrees_with_the_operator(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.line_dedup_stage(spark, docs, sf_dir).collect()}
    cut = {r.doc_id: r for r in line_dedup.drop_common_blocks(docs).collect()}
    assert set(cut) - set(got) == {i for i, r in cut.items() if r.removed_lines and not r.text.strip()}
    assert all(t == cut[i].text and (n == len(t) or not cut[i].removed_lines) for i, (t, n) in got.items())


def test_simhash_query_is_whole(spark, sf_dir):
    got = queries.op3_simhash(spark, sf_dir)
    assert got.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert simhash.keep_one(spark.read.parquet(f"{sf_dir}/documents.parquet")).count() == got.select("component_id").distinct().count()


def test_empty_tables(spark, corpus):
    path = scratch(spark, "empty")
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{corpus}/{name}.parquet").limit(0).write.parquet(f"{path}/{name}.parquet")
    assert corpus_pipeline.run(spark, path).collect() == []


def test_batches_are_bounded_by_bytes(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    for given, want in (("64m", "4194304b"), ("1k", "1k")):
        spark.conf.set(name, given)
        common.bound_batches(spark)
        assert spark.conf.get(name) == want
    spark.conf.set(name, before)
