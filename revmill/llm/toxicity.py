"""Toxicity by multiple-instance learning: only documents are labelled, sentences are scored.

Each sentence has a logistic score; a document is toxic unless none of its sentences is, so
its score is the noisy-or of theirs. The weights are fitted to document labels through that
noisy-or, and the sentences with high scores show where a document offends.

A sentence's features are its words and the beginnings of its words, by 64-bit hash. Id,
language, source and labels are never features.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmill.llm.bpe import DIGIT, LETTER, _classes
from revmill.llm.common import if_small, ship, text_of
from revmill.llm.vectext import Chars, mix64, runs, small_batches
from revmill.session import cut_lineage

# Beginnings of so many characters are features of the longer words that start with them.
PREFIXES = (3, 4, 5, 6, 7, 8)
# Where a feature's low bits aren't marked here, it has no weight; the rest is looked up.
_MARKS = 1 << 20


@dataclass(frozen=True)
class Fit:
    """max_rows and max_bytes bound the sample of labelled documents that the model is fitted
    on (about; documents are drawn by a hash of their id, evenly), and so its size. A feature
    gets a weight if so many sampled documents hold it, and toxic ones clearly more often (by
    the factor exp(least_odds))."""

    max_rows: int = 10_000
    max_bytes: int = 32_000_000
    least_documents: int = 4
    least_odds: float = 1.5
    epochs: int = 300
    rate: float = 0.1
    decay: float = 3e-5


@dataclass(frozen=True)
class Model:
    """Weights by sorted feature hash; a sentence's logit is the bias and its weights' sum."""

    features: np.ndarray
    weights: np.ndarray
    bias: float

    def marks(self) -> np.ndarray:
        out = np.zeros(_MARKS, bool)
        out[(self.features & np.uint64(_MARKS - 1)).astype(np.int64)] = True
        return out


_lower: np.ndarray | None = None


def _lower_table() -> np.ndarray:
    """Lower case of each code point where that is a single one, so that positions hold."""
    global _lower
    if _lower is None:
        table = np.arange(0x110000, dtype=np.uint32)
        for c in range(0x20000):
            low = chr(c).lower()
            if len(low) == 1:
                table[c] = ord(low)
        _lower = table
    return _lower


def _features(texts: list[str]):
    """Sentences (text, begin, end) of the batch, and the sentence and slot of each feature."""
    chars = Chars(texts, separator=10)
    raw = chars.codes
    chars.codes = _lower_table()[raw]
    ends = (raw == 10) | (raw == 33) | (raw == 46) | (raw == 63)
    s_begin, s_end = runs(~ends)
    kind = _classes()[chars.codes]
    w_begin, w_end = runs((kind == LETTER) | (kind == DIGIT))
    sentence = np.searchsorted(s_begin, w_begin, side="right") - 1
    sentences, features = [sentence], [chars.hashes(w_begin, w_end)]
    for n in PREFIXES:
        longer = w_end - w_begin > n
        begin = w_begin[longer]
        sentences.append(sentence[longer])
        features.append(mix64(chars.hashes(begin, begin + n) + np.uint64(n)))
    owner = chars.owners(s_begin)
    offset = chars.starts[owner]
    return owner, s_begin - offset, s_end - offset, np.concatenate(sentences), np.concatenate(features)


def _known(model_features: np.ndarray, marks: np.ndarray, sentence: np.ndarray, feature: np.ndarray):
    """Distinct pairs of sentence and index of a feature that has a weight."""
    maybe = marks[(feature & np.uint64(_MARKS - 1)).astype(np.int64)]
    sentence, feature = sentence[maybe], feature[maybe]
    n = len(model_features)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(model_features, feature), n - 1)
    hit = model_features[at] == feature
    pair = np.unique(sentence[hit] * n + at[hit])
    return pair // n, pair % n


def _select(texts: list[str], y: np.ndarray, fit: Fit) -> tuple[np.ndarray, np.ndarray]:
    """Features that toxic documents hold clearly more often, and the log of how much more."""
    known = np.zeros(0, np.uint64)
    counts = np.zeros((0, 2))
    for a, b in small_batches(texts):
        owner, _, _, sentence, feature = _features(texts[a:b])
        order = np.lexsort((owner[sentence], feature))
        f, d = feature[order], owner[sentence][order]
        first = np.ones(len(f), bool)
        first[1:] = (f[1:] != f[:-1]) | (d[1:] != d[:-1])
        f, d = f[first], d[first]
        label = y[a + d]
        both = np.concatenate([known, f])
        known, back = np.unique(both, return_inverse=True)
        old, counts_new = back[: len(counts)], np.zeros((len(known), 2))
        counts_new[old] = counts
        new = back[len(old) :]
        counts_new[:, 0] += np.bincount(new, minlength=len(known))
        counts_new[:, 1] += np.bincount(new, weights=label, minlength=len(known))
        counts = counts_new
    enough = counts[:, 0] >= fit.least_documents
    known, counts = known[enough], counts[enough]
    toxic, rest = counts[:, 1], counts[:, 0] - counts[:, 1]
    odds = np.log((toxic + 0.1) / (y.sum() + 1)) - np.log((rest + 0.1) / (len(y) - y.sum() + 1))
    clear = odds >= fit.least_odds
    return known[clear], odds[clear]


def fit_model(texts: list[str], labels: np.ndarray, fit: Fit = Fit()) -> Model:
    """Full passes of Adam over the noisy-or likelihood of the labels (0 or 1)."""
    none = np.zeros(0, np.uint64), np.zeros(0)
    if not len(texts) or labels.min() == labels.max():
        return Model(*none, 30.0 if len(texts) and labels[0] else -30.0)
    y = labels.astype(np.float64)
    features, odds = _select(texts, y, fit)
    marks = Model(features, odds, 0.0).marks()
    owners, sentences, slots, offset, at = [], [], [], 0, 0
    for a, b in small_batches(texts):
        owner, _, _, sentence, feature = _features(texts[a:b])
        where, slot = _known(features, marks, sentence, feature)
        owners.append(owner + a)
        sentences.append(where + offset)
        slots.append(slot)
        offset += len(owner)
    owner, sentence, slot = map(np.concatenate, (owners, sentences, slots))
    n, docs, size = len(owner), len(texts), len(features)
    w, bias = 2 * odds, -8.0
    m, v, mb, vb = np.zeros(size), np.zeros(size), 0.0, 0.0
    for epoch in range(1, fit.epochs + 1):
        z = np.clip(np.bincount(sentence, weights=w[slot], minlength=n) + bias, -30, 30)
        s = 1 / (1 + np.exp(-z))
        clean = np.exp(-np.bincount(owner, weights=np.logaddexp(0, z), minlength=docs))
        pull = np.where(y == 1, clean / np.maximum(1 - clean, 1e-9), -1.0)
        step = s * pull[owner] / docs
        grad = np.bincount(slot, weights=step[sentence], minlength=size) - fit.decay * w
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        w = w + fit.rate * m / (1 - 0.9**epoch) / (np.sqrt(v / (1 - 0.99**epoch)) + 1e-6)
        g = step.sum()
        mb, vb = 0.9 * mb + 0.1 * g, 0.99 * vb + 0.01 * g**2
        bias += fit.rate * mb / (1 - 0.9**epoch) / (np.sqrt(vb / (1 - 0.99**epoch)) + 1e-6)
    return Model(features, w, float(bias))


def train(docs: DataFrame, labels: DataFrame, may_learn: Column, fit: Fit = Fit()) -> Model:
    """A model from the documents that have a label (columns doc_id, toxic) and for which
    may_learn holds.

    Null labels are left out; of several labels of one id the largest counts; a null text is
    empty. Without any label, or with one label only, every document gets that label (none: 0).
    The sample's bound, not the table, sets the size of the one task that fits the weights.
    """
    ship(docs.sparkSession)
    known = labels.filter(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("__toxic"))
    rows = docs.filter(may_learn).select("doc_id", text_of().alias("text"))
    sizes = docs.filter(may_learn).select("doc_id", F.octet_length(text_of()).alias("b")).join(known, "doc_id")
    total = sizes.agg(F.count("*").alias("n"), F.sum("b").alias("b")).first()
    share = min(1.0, fit.max_rows / max(1, total["n"]), fit.max_bytes / max(1, total["b"] or 1))
    grid = 1 << 20
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(grid)) < int(share * grid)
    # The drawn labels are as few as the sample; sent to the texts, they spare moving those of
    # documents without a label.
    few = cut_lineage(known.filter(drawn))
    sample = rows.filter(drawn).join(if_small(few, few.count(), 16), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        rows.sort()  # the order of arrival must not change the weights
        model = fit_model([t for t, _ in rows], np.array([int(x > 0) for _, x in rows]), fit)
        columns = [[model.features.tobytes()], [model.weights.tobytes()], [model.bias]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["features", "weights", "bias"])

    fitted = sample.select("text", "__toxic").repartition(1).mapInArrow(run, "features binary, weights binary, bias double")
    row = fitted.first()
    if row is None:  # no partition at all
        return fit_model([], np.zeros(0))
    return Model(np.frombuffer(row["features"], np.uint64), np.frombuffer(row["weights"]), row["bias"])


def sentence_scores(texts: list[str], model: Model, marks: np.ndarray):
    """owner, begin, end and score of the sentences, and the noisy-or of each text."""
    owner, begin, end, sentence, feature = _features(texts)
    where, slot = _known(model.features, marks, sentence, feature)
    z = np.clip(np.bincount(where, weights=model.weights[slot], minlength=len(owner)) + model.bias, -30, 30)
    clean = np.bincount(owner, weights=np.logaddexp(0, z), minlength=len(texts))
    return owner, begin, end, 1 / (1 + np.exp(-z)), -np.expm1(-clean)


def score(docs: DataFrame, model: Model, offending: float = 0.5) -> DataFrame:
    """doc_id, score, sentences (begin, end and score of each that reaches `offending`) of
    every whole text. A text without a sentence, empty or null, scores 0."""
    spark = docs.sparkSession
    ship(spark)
    # Bounded by the sample that the model was fitted on, whatever the size of the tables.
    sent = spark.sparkContext.broadcast(model)
    spans = T.ArrayType(
        T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())])
    )
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("score", T.DoubleType()), T.StructField("sentences", spans)]
    )
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        marks = model.marks()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            scores, found = np.zeros(len(texts)), [[] for _ in texts]
            for first, last in small_batches(texts):
                owner, begin, end, s, scores[first:last] = sentence_scores(texts[first:last], model, marks)
                for i in np.flatnonzero(s >= offending):
                    found[first + owner[i]].append({"begin": int(begin[i]), "end": int(end[i]), "score": float(s[i])})
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores), pa.array(found, kind)], ["doc_id", "score", "sentences"]
            )

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, labels: DataFrame, may_learn: Column, threshold: float = 0.5, fit: Fit = Fit()) -> DataFrame:
    """The rows of docs that score below the threshold; every column stays as it is."""
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, labels, may_learn, fit))
    text_at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        marks = model.marks()
        for batch in batches:
            texts = [t or "" for t in batch.column(text_at).to_pylist()]
            stays = np.ones(len(texts), bool)
            for first, last in small_batches(texts):
                stays[first:last] = sentence_scores(texts[first:last], model, marks)[-1] < threshold
            yield batch.filter(pa.array(stays))

    return docs.mapInArrow(run, docs.schema)
