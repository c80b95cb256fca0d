"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Character n-grams (bytes of the lower-cased text, white space as one kind of space) are hashed to
``BUCKETS``.  On a labelled sample, every bucket gets the log ratio of its smoothed document
frequencies in toxic and other documents; a logistic regression learns weights for the
``FEATURES`` most telling buckets, each feature being presence times ratio.  All documents are
then scored in one pass without a shuffle.

Definitions: only text is read for a score; a null text is an empty one and gets the score of no
feature.  Rows with a null id are scored but not learned from.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloop.llm.learning import fit_sparse, labelled_sample, sigmoid, vector_sum
from keyloop.llm.text import Shared, ddl, raw_bytes, slices, without

#: Labelled rows that are learned from at most: the stated bound of the sample.
SAMPLE = 20_000
SIZES = (4, 6, 8)
BUCKETS = 1 << 20
FEATURES = 1024
#: Toxic or other documents that must hold a bucket for it to become a feature.
SUPPORT = 5
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))


def ngram_buckets(col: pa.Array):
    """(offsets, [bucket of the n bytes from each position on, for n in SIZES]); the last n - 1
    positions of a text belong to no n-gram of it."""
    offsets, data = raw_bytes(col)
    b = np.frombuffer(bytes(data).translate(_PLAIN), np.uint8).astype(np.uint64)
    out, acc = [], b
    for n in range(2, max(SIZES) + 1):
        acc = (acc[:-1] << np.uint64(8)) | b[n - 1:] if len(b) >= n else b[:0]
        if n in SIZES:
            key = (acc + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            out.append((key >> np.uint64(44)).astype(np.int32))
    return offsets, out


def _present(col: pa.Array):
    """Distinct buckets of each text."""
    offsets, grams = ngram_buckets(col)
    for a, b in zip(offsets[:-1], offsets[1:]):
        yield np.unique(np.concatenate([g[a:max(a, b - n + 1)] for n, g in zip(SIZES, grams)]))


def _count(batches):
    """Documents of each bucket: toxic ones, then others; and the numbers of documents."""
    total = np.zeros(2 * BUCKETS + 2)
    for part in slices(batches):
        for toxic, own in zip(part.column("label").to_pylist(), _present(part.column("text"))):
            total[own + (0 if toxic else BUCKETS)] += 1
            total[-2 if toxic else -1] += 1
    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["v"])


def _hits(col: pa.Array, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of the features present, each pair once."""
    offsets, grams = ngram_buckets(col)
    text, feature = [], []
    for n, g in zip(SIZES, grams):
        at = np.flatnonzero(slot[g] >= 0)
        own = np.searchsorted(offsets, at, "right") - 1
        ok = at + n <= offsets[own + 1]
        text.append(own[ok])
        feature.append(slot[g[at[ok]]])
    both = np.unique(np.concatenate(text).astype(np.int64) * FEATURES + np.concatenate(feature))
    return both // FEATURES, both % FEATURES


def _sample_hits(slot):
    def run(batches):
        for part in slices(batches):
            text, feature = _hits(part.column("text"), slot.value)
            ends = np.searchsorted(text, np.arange(part.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column("label").cast(pa.int32()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(feature.astype(np.int32)))],
                names=["label", "features"])
    return run


class ToxicityModel:
    """Feature slot of each bucket (-1: none), weights of the slots, constant."""

    def __init__(self, slot, weights, constant):
        self.slot, self.weights, self.constant = slot, weights, constant

    def score(self, col: pa.Array) -> np.ndarray:
        text, feature = _hits(col, self.slot)
        return sigmoid(np.bincount(text, self.weights[feature], len(col)) + self.constant)


def fit(docs: DataFrame, labels: DataFrame, learn=None, sample: int = SAMPLE) -> ToxicityModel:
    """Learns from at most ``sample`` labelled documents (``learn``: a condition on ``id``).

    Without rows of both labels the score is constant: 0.5, or near the only label."""
    spark = docs.sparkSession
    rows = labelled_sample(docs, labels, "toxic", sample, learn).select("label", "text").repartition(8)
    total = vector_sum(rows.mapInArrow(_count, "v binary"), 1)
    slot, weights = np.full(BUCKETS, -1, np.int16), np.zeros(FEATURES)
    toxic, other = total[:BUCKETS], total[BUCKETS:2 * BUCKETS]
    n_toxic, n_other = total[-2:]
    if not n_toxic or not n_other:
        return ToxicityModel(slot, weights, 0.0 if n_toxic == n_other else 4.0 if n_toxic else -4.0)
    ratio = np.log((toxic + 1) / (n_toxic + 2)) - np.log((other + 1) / (n_other + 2))
    expected = (toxic + other) * n_toxic / (n_toxic + n_other)
    telling = (toxic - expected) ** 2 / (expected + 1)
    telling[np.maximum(toxic, other) < SUPPORT] = -1
    best = np.argsort(-telling, kind="stable")[:FEATURES]
    best = best[telling[best] > 0]
    slot[best] = np.arange(len(best))
    shared = Shared(spark, slot)
    got = rows.mapInArrow(_sample_hits(shared), "label int, features array<int>").toArrow()
    features = got.column("features").combine_chunks()
    cols = features.flatten().to_numpy().astype(np.int64)
    own = np.repeat(np.arange(len(features)), np.diff(features.offsets.to_numpy()))
    y = got.column("label").to_numpy().astype(float)
    w = fit_sparse(own, cols, ratio[best][cols], y, len(best), steps=150)
    weights[:len(best)] = w[:-1] * ratio[best]
    return ToxicityModel(slot, weights, w[-1])


def score_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text",
                   threshold: float = 0.7) -> DataFrame:
    """``docs`` plus score (double, 0 to 1) and predicted (int); columns of these names are
    replaced, others pass through."""
    docs = without(docs, "score", "predicted")
    shared = Shared(docs.sparkSession, model)

    def run(batches):
        for part in slices(batches, text):
            score = shared.value.score(part.column(text))
            yield part.append_column("score", pa.array(score)).append_column(
                "predicted", pa.array((score >= threshold).astype(np.int32)))

    return docs.mapInArrow(run, ddl(docs) + ", score double, predicted int")


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What op9 returns."""
    def held(c):
        return F.coalesce(F.crc32(F.col(c).cast("string")) % 3 == 1, F.lit(False))
    model = fit(docs, labels, ~held("id"))
    scored = score_toxicity(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held("doc_id").alias("held_out"), "score", "predicted")
