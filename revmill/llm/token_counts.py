"""Token counts through a cache keyed by content and tokenizer version.

The content key is the SHA-256 of the text with null as empty; the text is normalised no
further, as any change could change its count. The version is the SHA-256 of the tokenizer's
file. Only distinct texts that the cache lacks are encoded, and then appended to it.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revmill.llm.bpe import encoder
from revmill.llm.common import if_small, ship, text_of
from revmill.session import cut_lineage

CACHE = "digest string, version string, n_tokens long"


def version_of(tokenizer: str) -> str:
    with open(tokenizer, "rb") as f:
        return hashlib.sha256(f.read() + os.path.basename(tokenizer).encode()).hexdigest()


def read_cache(spark, cache: str, version: str) -> DataFrame:
    """digest, n_tokens of one version; no rows if the folder does not exist yet. A digest
    that two runs appended at once counts once."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], CACHE).select("digest", "n_tokens")
    stored = spark.read.schema(CACHE).parquet(cache).filter(F.col("version") == version)
    return stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def _counter(tokenizer: str):
    special = tokenizer.endswith(".model")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if special:
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=tokenizer)
        else:
            enc = encoder(tokenizer)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            if special:
                n = np.fromiter((len(i) for i in model.encode(texts, num_threads=1)), np.int64, len(texts))
            else:
                n = np.concatenate([np.zeros(0, np.int64), *(c for _, c, _ in enc.encode(texts, want_ids=False))])
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(n, pa.int64())], ["digest", "n_tokens"])

    return count


def fill_cache(texts: DataFrame, digests: DataFrame, tokenizer: str, cache: str) -> None:
    """Encodes what the cache lacks. texts: digest, text; digests: the same digests, as a
    written table. Texts leave their partition only if they are missing, and once for each
    distinct text and partition."""
    spark = texts.sparkSession
    version = version_of(tokenizer)
    known = read_cache(spark, cache, version)
    wanted = digests.select("digest").distinct().join(known, "digest", "left_anti")
    wanted = cut_lineage(wanted)
    n = wanted.count()
    if not n:
        return
    missing = texts.join(if_small(wanted, n, 96), "digest", "left_semi")
    distinct = missing.groupBy("digest").agg(F.first("text").alias("text"))
    counted = distinct.mapInArrow(_counter(tokenizer), "digest string, n_tokens long")
    counted.select("digest", F.lit(version).alias("version"), "n_tokens").write.mode("append").parquet(cache)


def count_tokens(docs: DataFrame, tokenizer: str, cache: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens of every row of docs; special strings count as the library
    counts them by default.

    Rows with a null text count as empty (no bytes, no tokens); repeated rows stay repeated;
    ids may be null. Other columns are left out.
    """
    spark = docs.sparkSession
    ship(spark)
    keyed = docs.select("doc_id", F.sha2(text_of().cast("binary"), 256).alias("digest"), text_of().alias("text"))
    rows = cut_lineage(keyed.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")))
    fill_cache(keyed.select("digest", "text"), rows, tokenizer, cache)
    # Written, so that the join deals both sides out and can split a text that many rows share.
    counts = read_cache(spark, cache, version_of(tokenizer)).join(rows.select("digest").distinct(), "digest")
    counts = cut_lineage(counts)
    return rows.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens")
