"""The corpus pipeline: documents, stage by stage, to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's documents. All but the last return the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revmill.llm import bpe, decontam, line_dedup, packing, simhash, toxicity
from revmill.llm.common import bound_batches, fold
from revmill.session import cut_lineage

SEQUENCE = 2048
END_ID = 0


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go."""
    bound_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, labels, fold(5) != 0)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks that an earlier document holds are cut from the later one. A document of which
    nothing is left by that goes; n_chars follows the text."""
    bound_batches(spark)
    cut = line_dedup.drop_common_blocks(docs, prefix="__cut_")
    lost = F.col("__cut_removed_lines") > 0
    left = cut.filter(~lost | (F.trim("text") != ""))
    changed = F.when(lost, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", changed).select(docs.columns)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that with the smallest id."""
    bound_batches(spark)
    return simhash.keep_one(docs, size=3, max_bits=2)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the packed sequences."""
    bound_batches(spark)
    return packing.pack_documents(docs, bpe.default_tokenizer(), SEQUENCE, END_ID)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("simhash", simhash_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# No stage but the last is a plain SQL query: a fitted model, an alignment, components.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
