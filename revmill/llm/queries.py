"""The registered query of each operator, over whole tables with production parameters.

Each query reads its table, applies the operator and derives the digest columns from its
rows. ORACLES holds SQL for those that SQL can express on whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revmill.llm import bpe, collocations, decontam, exact_dedup, kd_shards, kneser_ney, line_dedup, marked_words, merkle, packing, simhash, token_counts, toxicity, warc
from revmill.llm.common import fold
from revmill.session import scratch

SEQUENCE = 2048
END_ID = 0
TOKEN_LIMIT = 512
SHARDS = 24


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"), fold(5) != 0)
    return toxicity.score(docs, model).select(
        "doc_id",
        (fold(5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "sentences",
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), size=3, max_bits=2)


def op4_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = kneser_ney.train(docs, fold(10) != 0)
    return kneser_ney.score(docs, model).select(
        "doc_id",
        (fold(10) == 0).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        "perplexity",
    )


def op5_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards.kd_shards(_table(spark, sf_dir, "documents"), SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    counts = token_counts.count_tokens(docs, bpe.default_tokenizer(), scratch(spark, "token-cache"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text that is left of each document, and the ranges cut from the old one."""
    cut = line_dedup.drop_common_blocks(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "text", "removed", "removed_lines", "removed_words")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, bpe.default_tokenizer(), SEQUENCE, END_ID)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(_table(spark, sf_dir, "pages"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"), min_count=100, max_words=5, top=2000)


def op12_marked_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    codec = marked_words.build(docs, marked_words.default_model())
    return marked_words.encode(docs, codec).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the rows, by crc32 of the id, come to the audit without their line feeds."""
    cut = F.when(fold(2) == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    rows = merkle.manifest(_table(spark, sf_dir, "documents"), audited={"text": cut})
    folded = merkle.fold(F.col("audited_leaf"), F.col("path"))
    return rows.select(
        "doc_id",
        *[merkle.as_text(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
        F.sha2(merkle.proof(F.col("path")), 256).alias("proof_sha256"),
        merkle.as_text(folded).alias("folded_root"),
        (folded == F.col("root")).alias("verified"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_decontamination": op2_decontamination,
    "op3_simhash": op3_simhash,
    "op4_kneser_ney": op4_kneser_ney,
    "op5_kd_shards": op5_kd_shards,
    "op6_token_counts": op6_token_counts,
    "op7_line_dedup": op7_line_dedup,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_warc": op9_warc,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_collocations": op11_collocations,
    "op12_marked_words": op12_marked_words,
    "op13_merkle": op13_merkle,
}

ORACLES: dict[str, str] = {
    "op2_decontamination": r"""
        WITH words AS (
            SELECT 'd' AS side, doc_id AS id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w
            FROM documents
            UNION ALL
            SELECT 'i', item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '')
            FROM benchmark
        ), shingles AS (
            SELECT DISTINCT side, id, unnest(list_transform(range(greatest(len(w) - 4, 1)), lambda i: array_to_string(w[i + 1:i + 5], ' '))) AS s
            FROM words WHERE len(w) > 0
        ), sizes AS (SELECT id, count(*) AS n FROM shingles WHERE side = 'i' GROUP BY id)
        SELECT d.id AS doc_id, i.id AS item_id, any_value(n)::INT AS item_shingles, count(*)::INT AS shared_shingles,
               count(*) / any_value(n) AS containment
        FROM shingles d JOIN shingles i ON d.s = i.s AND d.side = 'd' AND i.side = 'i' JOIN sizes ON sizes.id = i.id
        GROUP BY d.id, i.id HAVING count(*) >= 0.8 * any_value(n)
    """,
    "op9_warc": """
        WITH hashed AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex,
                   max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
            FROM pages
        ), bits AS (
            SELECT *, array_to_string(list_transform(string_split(hex, ''),
                   lambda c: lpad(bin(instr('0123456789abcdef', c) - 1), 4, '0')), '') AS b
            FROM hashed
        )
        SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + list_sum(list_transform(range(5), lambda k: (substr(b, 5 * i::INT + k::INT + 1, 1) = '1')::INT * (16 >> k::INT)))::INT, 1)), '')
                   AS payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
        FROM bits
    """,
    "op10_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op13_merkle": r"""
        WITH RECURSIVE cut AS (
            -- crc32 of the id, bit by bit: the first of each byte's eight steps takes the byte in.
            SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
                       lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
                       lambda crc, b: xor(xor(crc, b) >> 1, (xor(crc, b) & 1) * 3988292384::BIGINT)), 4294967295) % 2 = 0 AS odd
            FROM documents
        ), fields AS (
            SELECT doc_id, source, text, odd, replace(text, chr(10), '') AS cut_text,
                   coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head
            FROM cut
        ), leaves AS (
            SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                   sha256(head || CASE WHEN odd THEN coalesce(strlen(cut_text) || ':' || cut_text, '-')
                                       ELSE coalesce(strlen(text) || ':' || text, '-') END) AS seen,
                   row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos
            FROM fields
        ), low AS (
            SELECT source, 0 AS depth, list(leaf ORDER BY pos) AS nodes FROM leaves GROUP BY source
            UNION ALL
            SELECT source, depth + 1, list_transform(range(0, len(nodes), 3), lambda i: sha256(array_to_string(nodes[i + 1:i + 3], '')))
            FROM low WHERE len(nodes) > 1
        ), subroots AS (
            SELECT source, nodes[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos FROM low WHERE len(nodes) = 1
        ), high AS (
            SELECT 0 AS depth, list(subroot ORDER BY pos) AS nodes FROM subroots
            UNION ALL
            SELECT depth + 1, list_transform(range(0, len(nodes), 3), lambda i: sha256(array_to_string(nodes[i + 1:i + 3], '')))
            FROM high WHERE len(nodes) > 1
        ), roots AS (SELECT nodes[1] AS root FROM high WHERE len(nodes) = 1),
        steps AS (
            SELECT doc_id, depth, nodes, (l.pos // (3 ** depth)::BIGINT) AS own
            FROM leaves l JOIN low ON l.source IS NOT DISTINCT FROM low.source WHERE len(nodes) > 1
            UNION ALL
            SELECT doc_id, 1000 + depth, nodes, s.pos // (3 ** depth)::BIGINT
            FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source, high WHERE len(nodes) > 1
        ), sides AS (
            SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY depth) AS step,
                   array_to_string(nodes[own // 3 * 3 + 1:own], '') AS before, array_to_string(nodes[own + 2:own // 3 * 3 + 3], '') AS after
            FROM steps
        ), folds AS (
            SELECT doc_id, 0::BIGINT AS step, seen AS h FROM leaves
            UNION ALL
            SELECT f.doc_id, f.step + 1, sha256(before || h || after) FROM folds f JOIN sides s ON f.doc_id = s.doc_id AND s.step = f.step + 1
        ), proofs AS (SELECT doc_id, string_agg(before || after, '' ORDER BY step) AS proof FROM sides GROUP BY doc_id),
        ends AS (SELECT doc_id, arg_max(h, step) AS folded_root FROM folds GROUP BY doc_id)
        SELECT l.doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = root AS verified
        FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source JOIN ends USING (doc_id) LEFT JOIN proofs USING (doc_id), roots
    """,
    "op11_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), split AS (
            SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces
        ), totals AS (SELECT lang, sum(len(w)) AS n FROM split GROUP BY lang),
        sizes AS (SELECT unnest(range(1, 6)) AS size),
        frequent AS (
            SELECT lang, size, phrase, count(*) AS a
            FROM (SELECT lang, size, unnest(list_transform(range(len(w) - size + 1), lambda i: array_to_string(w[i + 1:i + size], ' '))) AS phrase
                  FROM split, sizes WHERE len(w) >= size)
            GROUP BY lang, size, phrase HAVING count(*) >= 100
        ), candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM frequent WHERE size >= 2),
        cuts AS (
            SELECT lang, w, size, phrase, a, unnest(range(1, size)) AS k FROM candidates
        ), scored AS (
            SELECT c.lang, c.phrase, c.a, k, x.a AS l, y.a AS r, n, (1000::HUGEINT * c.a * n) // (x.a::HUGEINT * y.a) AS score
            FROM cuts c JOIN frequent x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:k], ' ')
            JOIN frequent y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:], ' ') JOIN totals ON totals.lang = c.lang
        ), weakest AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ), inner_phrases AS (
            SELECT lang, array_to_string(w[s.at:s.at + s.m - 1], ' ') AS phrase, a
            FROM candidates JOIN (SELECT m.size AS m, unnest(range(1, 5)) AS at FROM sizes m WHERE m.size >= 2) s
              ON s.m < candidates.size AND s.at + s.m - 1 <= candidates.size
        ), longest AS (SELECT lang, phrase, max(a) AS longer FROM inner_phrases GROUP BY lang, phrase)
        SELECT w.lang, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank, w.phrase,
               a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
        FROM weakest w LEFT JOIN longest USING (lang, phrase)
        WHERE longer IS NULL OR 100 * longer < 100 * a
        QUALIFY rank <= 2000
    """,
}
