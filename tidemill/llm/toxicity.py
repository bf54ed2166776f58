"""Toxicity by multiple-instance learning: a document is toxic if at least one of its sentences is.

Labels are on documents. A sentence with evidence gets a score from its words, and the scores are
combined by noisy-or: P(document) = 1 - (1 - leak) * product(1 - P(sentence)). The weights are fitted
through that product, so sentences are scored, and the offending ones found, without a label of their own.
Features of a word are itself and its beginnings. Only features that the labels of the sample single
out enter the model.

The model is fitted on a bounded sample (`SAMPLE_DOCS`, `SAMPLE_CHARS`), chosen by a hash of the id;
scoring reads every whole text.

Defined results: NULL and empty texts have no sentence and score `leak`; labels that are NULL are left
out, of several labels of one document the highest counts, of several texts with one id the least is learned from;
without any label everything scores 0.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import pieces

# Bounds of the sample that the model is fitted on.
SAMPLE_DOCS = 6000
SAMPLE_CHARS = 24_000_000
# A feature is kept if it is in this many documents at least and this far from chance (standard deviations).
LEAST_DOCS, LEAST_Z, MOST_FEATURES = 4, 4.0, 4000
BEGINNINGS = (4, 5, 6, 7)
THRESHOLD = 0.3
OFFENDING = 0.5
ROUNDS = 400
WORD_CACHE = 100_000

WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[^.!?\n]+")


def word_features(word: str) -> list[str]:
    return [word, *("^" + word[:k] for k in BEGINNINGS if len(word) > k)]


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = 0.0
    leak: float = 0.0

    def values(self) -> tuple[dict[str, float], float, float]:
        """Built-in types only: a broadcast of them needs no package on the executors."""
        return self.weights, self.bias, self.leak


class _WordWeights(dict):
    """Sum of the weights of a word's features, None for a word without evidence; bounded."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word: str):
        found = [self.model.weights[f] for f in word_features(word) if f in self.model.weights]
        value = self[word] = sum(found) if found else None
        return value


def document_score(text: str | None, words: _WordWeights) -> tuple[float, list[tuple[int, int, float]]]:
    """Score of a text, and start, end and score of its offending sentences."""
    model = words.model
    clean, spans = 1 - model.leak, []
    if text and any(words[w] is not None for w in set(WORD.findall(text.lower()))):
        for sentence in SENTENCE.finditer(text):
            found = [v for w in WORD.findall(sentence.group().lower()) if (v := words[w]) is not None]
            if found:
                p = 1 / (1 + np.exp(-np.clip(model.bias + sum(found), -30, 30)))
                clean *= 1 - p
                if p >= OFFENDING:
                    spans.append((sentence.start(), sentence.end(), float(p)))
    return float(min(1.0, max(0.0, 1 - clean))), spans


# -- fit ---------------------------------------------------------------------------------------


def select_features(docs: list[tuple[str, int]]) -> list[str]:
    """Features that are more frequent in toxic documents than chance explains."""
    counts: tuple[Counter, Counter] = Counter(), Counter()
    for text, toxic in docs:
        words = set(WORD.findall((text or "").lower()))
        counts[toxic].update({f for w in words for f in word_features(w)})
    share = sum(t for _, t in docs) / max(1, len(docs))
    scored = []
    for f, a in counts[1].items():
        n = a + counts[0][f]
        z = (a - n * share) / max(1e-9, (n * share * (1 - share)) ** 0.5)
        if n >= LEAST_DOCS and z >= LEAST_Z:
            scored.append((-z, f))
    return [f for _, f in sorted(scored)[:MOST_FEATURES]]


def fit(docs: list[tuple[str, int]]) -> Model:
    """Noisy-or of sentence logits by gradient descent on the document labels."""
    toxic = np.array([t for _, t in docs], float)
    names = select_features(docs)
    if not len(docs) or not names:
        return Model(leak=float(toxic.mean()) if len(docs) else 0.0)
    at = {f: i for i, f in enumerate(names)}
    doc_of, sentence_of, feature_of = [], [], []
    known: dict[str, list[int]] = {}
    for d, (text, _) in enumerate(docs):
        for sentence in SENTENCE.findall(text or ""):
            found = []
            for w in WORD.findall(sentence.lower()):
                if w not in known:
                    known[w] = [at[f] for f in word_features(w) if f in at]
                found += known[w]
            if found:
                sentence_of += [len(doc_of)] * len(found)
                feature_of += found
                doc_of.append(d)
    doc_of, sentence_of, feature_of = (np.array(x, np.int64) for x in (doc_of, sentence_of, feature_of))
    # Parameters: feature weights, bias, logit of the leak.
    theta = np.concatenate((np.full(len(names), 0.5), [-2.0, -4.0]))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -30, 30)))
    for step in range(1, ROUNDS + 1):
        z = np.bincount(sentence_of, theta[feature_of], minlength=len(doc_of)) + theta[-2]
        p, leak = sigmoid(z), sigmoid(theta[-1])
        log_clean = np.bincount(doc_of, np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=len(docs)) + np.log1p(-leak)
        clean = np.exp(log_clean)
        # d loss / d log_clean: the product is told from its label
        push = np.where(toxic > 0, clean / np.maximum(1 - clean, 1e-6), -1.0)
        slope = -p * push[doc_of]
        grad = np.concatenate(
            (np.bincount(feature_of, slope[sentence_of], minlength=len(names)), [slope.sum(), -leak * push.sum()])
        ) / len(docs)
        grad[: len(names)] += 2e-4 * theta[: len(names)]
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Model(dict(zip(names, theta.tolist())), float(theta[-2]), float(sigmoid(theta[-1])))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels no model may see."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fits on labelled documents outside the held-out fold; at most the bounded sample reaches the driver."""
    sample = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(SAMPLE_DOCS)
    )
    # The sample has SAMPLE_DOCS rows at most, whatever the table, and one text for each, however often an id repeats.
    joined = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    sizes = sorted(joined.select(F.xxhash64("doc_id"), "doc_id", F.coalesce(F.length("text"), F.lit(0))).collect())
    total, ids = 0, []
    for _, doc_id, chars in sizes:
        total += chars
        if total > SAMPLE_CHARS:
            break
        ids.append((doc_id,))
    if not ids:
        return Model()
    chosen = docs.sparkSession.createDataFrame(ids, "doc_id bigint")
    rows = joined.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic").collect()
    return fit([(r.text, int(r.toxic > 0)) for r in sorted(rows)])


# -- scores ------------------------------------------------------------------------------------

SPANS = "array<struct<start:int,end:int,score:double>>"


def _scores(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    words = _WordWeights(Model(*model.value))
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
    for batch in pieces(batches):
        if len(words) > WORD_CACHE:
            words.clear()
        got = [document_score(t, words) for t in batch.column("text").to_pylist()]
        spans = [[{"start": a, "end": b, "score": p} for a, b, p in s] for _, s in got]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([s for s, _ in got], pa.float64()), pa.array(spans, kind)],
            names=["doc_id", "score", "offending"],
        )


def score(docs: DataFrame, model: Model) -> DataFrame:
    """`doc_id, score, offending` for every row: the sentences with a score of OFFENDING or more, by place."""
    sent = docs.sparkSession.sparkContext.broadcast(model.values())
    return docs.select("doc_id", "text").mapInArrow(partial(_scores, model=sent), f"doc_id bigint, score double, offending {SPANS}")


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The documents whose score is below THRESHOLD, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(model.values())

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = _WordWeights(Model(*sent.value))
        for batch in texts:
            if len(words) > WORD_CACHE:
                words.clear()
            yield pd.Series([document_score(t, words)[0] for t in batch], dtype="float64")

    return docs.where(scored("text") < THRESHOLD)
