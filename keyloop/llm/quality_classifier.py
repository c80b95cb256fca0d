"""Quality classifier by co-training of two views.

View one reads a text's content: shares of byte pairs (hashed), of symbols, capitals, repeated and distinct
words.  View two reads what is known about the page: language, source (hashed), length and the layout
of its lines.  Each view has a logistic regression.  In each of ``ROUNDS`` rounds both score all
unlabelled documents, and each labels those it is surest of for the other, in the proportion of the labels.
Then each view's score is calibrated on labelled rows that training never saw, and a logistic regression
over the two calibrated log-odds, fitted there as well, combines them for all documents.

The labelled sample is bounded and reaches the driver as feature vectors.  The unlabelled documents' vectors
are stored once; a round counts their log-odds in bins, whose cuts give the surest share, then fits by Newton
steps whose gradients and Hessians the tasks sum.  The driver gets vectors of a fixed size only; nothing but
the vectors and the ids of labelled documents is joined.  Scoring is one pass without a shuffle.

Definitions: null texts are empty, null languages and sources one more value; documents with a
null id are scored, not learned from; every row of an unlabelled id counts.  Without rows of both labels every score is constant.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloop.llm.learning import fit_dense, labelled_sample, sigmoid, vector_sum
from keyloop.llm.text import (Shared, ascii_lower_table, back, beside, ddl, owners, raw_bytes, release,
                              slices, split_words, stored, without, word_hashes)

#: Rows of the labelled sample at most.
SAMPLE = 8_000
ROUNDS = 4
#: Share of the unlabelled rows that a view labels for the other, more by it in every round.
SURE = 0.05
#: Weight of such a row; all of them together count at most as much as the labelled rows.
GIVEN = 0.5
L2 = 1e-2
STEPS = 8
#: Bins of the log-odds from -30 to 30.
BINS = 1 << 14
THRESHOLD = 0.5
#: Columns that ``score_quality`` adds.
ADDED = ("quality", "content_score", "page_score", "kept")
#: Bytes of text whose features are computed at once: the temporary arrays are some 70 times as large.
SLICE = 1 << 20
_PAIRS = 256
_LANGS, _SOURCES = 8, 16
_LOWER = ascii_lower_table()
_RAW = np.frombuffer(bytes(range(256)), np.uint8)
_UPPER = (_RAW >= 65) & (_RAW <= 90)
_ALPHA = _UPPER | ((_RAW >= 97) & (_RAW <= 122)) | (_RAW >= 128)
_SPACE = (_RAW == 32) | ((_RAW >= 9) & (_RAW <= 13))
_SIGN = ~_ALPHA & ~_SPACE & ~((_RAW >= 48) & (_RAW <= 57))
_ODD_SIGN = _SIGN & ~np.isin(_RAW, np.frombuffer(b".,;:'\"()-?", np.uint8))


def _sums(flags: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int32)])[ends])


def features(part: pa.RecordBatch, text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """(content view, page view) of a slice's rows."""
    n = part.num_rows
    ends, data = raw_bytes(part.column(text))
    b = np.frombuffer(bytes(data), np.uint8)
    size = np.maximum(1, np.diff(ends)).astype(float)
    words, offsets = split_words(part.column(text), _LOWER)
    count = np.maximum(1, np.diff(offsets)).astype(float)
    h = word_hashes(words)
    own = owners(offsets)

    pair = np.zeros((n, _PAIRS))
    if len(b) > 1:
        key = ((b[:-1].astype(np.uint32) * np.uint32(769) + b[1:]) * np.uint32(0x9E3779B1)) >> np.uint32(24)
        rows = np.repeat(np.arange(n), np.diff(ends))[:-1]
        pair = np.bincount(rows * _PAIRS + key, minlength=n * _PAIRS).reshape(n, _PAIRS) / size[:, None]
    order = np.lexsort((h, own))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (own[order][1:] != own[order][:-1])
    distinct = np.bincount(own[order][new], minlength=n)
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (own[1:] == own[:-1])
    letters = np.maximum(1, _sums(_ALPHA[b], ends))
    shares = np.stack([
        _sums(_UPPER[b], ends) / letters, _sums(_SIGN[b], ends) / size, _sums(_ODD_SIGN[b], ends) / size,
        np.bincount(own[again], minlength=n) / count, distinct / count ** 0.9, size / count / 10], axis=1)

    lines = _sums(b == 10, ends) + 1
    log = np.log1p(np.stack([size, count, lines, size / lines], axis=1)) / 5
    lang, source = np.zeros((n, _LANGS)), np.zeros((n, _SOURCES))
    for name, table, width in (("lang", lang, _LANGS), ("source", source, _SOURCES)):
        if name in part.schema.names:
            keys = [zlib.crc32(str(v).encode()) % width for v in part.column(name).to_pylist()]
            table[np.arange(n), keys] = 1
    return np.hstack([np.sqrt(pair), shares]), np.hstack([log, lang, source])


class QualityModel:
    """Per view: centre, scale, weights, calibration (slope, shift); then the combination, and the number of
    unlabelled rows met."""

    def __init__(self, views, combine, met=0):
        self.views, self.combine, self.met = views, combine, met

    def score(self, part: pa.RecordBatch, text: str = "text"):
        """(probability that the label is 1, of content alone, of the page alone)."""
        odds = np.stack([_odds(x, v) for x, v in zip(features(part, text), self.views)], axis=1)
        both = sigmoid(np.hstack([odds, np.ones((len(odds), 1))]) @ self.combine)
        return both, sigmoid(odds[:, 0]), sigmoid(odds[:, 1])


def _margin(x, centre, scale, w):
    return np.hstack([(x - centre) / scale, np.ones((len(x), 1))]) @ w


def _odds(x, view):
    centre, scale, w, (slope, shift) = view
    return np.clip(slope * np.clip(_margin(x, centre, scale, w), -30, 30) + shift, -12, 12)


def _vectors(rows: DataFrame) -> DataFrame:
    """id, label and both views of each row."""
    def run(batches):
        for part in slices(batches, most=SLICE):
            a, b = features(part)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("label").cast(pa.int32()),
                 pa.array([x.astype("<f4").tobytes() for x in a], pa.binary()),
                 pa.array([x.astype("<f4").tobytes() for x in b], pa.binary())],
                names=["id", "label", "a", "b"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, label int, a binary, b binary")


def _collected(rows: DataFrame):
    """Feature matrices and labels of a bounded sample."""
    got = _vectors(rows.repartition(8)).orderBy(F.xxhash64("id"), "id").toArrow()
    mats = [np.frombuffer(raw_bytes(got.column(c).combine_chunks())[1], "<f4").reshape(got.num_rows, -1)
            if got.num_rows else np.zeros((0, 0), "<f4") for c in ("a", "b")]
    return mats, got.column("label").to_numpy().astype(float)


def _matrices(batch: pa.RecordBatch, views):
    """Both views' scaled features of stored vectors, with the constant."""
    for name, (centre, scale) in zip(("a", "b"), views):
        x = np.frombuffer(raw_bytes(batch.column(name))[1], "<f4").reshape(batch.num_rows, len(centre))
        yield np.hstack([(x - centre) / scale, np.ones((len(x), 1))])


def _bins(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return ((np.clip(x @ w, -30, 30) + 30) * ((BINS - 1) / 60)).astype(np.int64)


def _summed(rows: DataFrame, shared, add) -> np.ndarray:
    """Sum over all batches of the vector that ``add(batch, state)`` gives."""
    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                v = add(batch, shared.value)
                total = v if total is None else total + v
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["v"])
    return vector_sum(rows.select("a", "b").mapInArrow(run, "v binary"), 4)


def _histogram(batch, state):
    views, weights = state
    return np.concatenate([np.bincount(_bins(x, w), minlength=BINS).astype(float)
                           for x, w in zip(_matrices(batch, views), weights)])


def shares(counts: np.ndarray, n_low: int, n_high: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each bin the share of rows labelled 0 and 1: the ``n_low`` of least and the ``n_high`` of most
    log-odds, as far as they are sure.  A bin at the cut counts by a share of all its rows, so rows of equal
    features count equally."""
    odds = np.arange(BINS) * (60 / (BINS - 1)) - 30
    sure = np.log(9)  # 0.1 and 0.9
    many = np.maximum(counts, 1)
    low = np.clip((n_low - (np.cumsum(counts) - counts)) / many, 0, 1) * (odds < -sure)
    back = counts[::-1]
    high = np.clip((n_high - (np.cumsum(back) - back)) / many[::-1], 0, 1)[::-1] * (odds > sure)
    return low, high


def _newton(x, y, weight, w) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, gradient and Hessian of a logistic regression's rows."""
    m = np.clip(x @ w, -30, 30)
    p = sigmoid(m)
    s = np.maximum(weight * p * (1 - p), 1e-9)
    return (weight * (np.logaddexp(0, m) - y * m)).sum(), x.T @ (weight * (p - y)), (x * s[:, None]).T @ x


def _slopes(batch, state):
    """Of each view: loss, gradient and Hessian over the rows that the other view has labelled."""
    views, labelling, given, weights = state
    mats = list(_matrices(batch, views))
    out = []
    for view in (0, 1):
        low, high = (table[_bins(mats[1 - view], labelling[1 - view])] for table in given[1 - view])
        own = (low > 0) | (high > 0)
        loss, grad, hess = _newton(mats[view][own], (high > 0)[own].astype(float), (low + high)[own], weights[view])
        out += [np.array([loss]), grad, hess[np.triu_indices(len(grad))]]
    return np.concatenate(out)


def refit(rows: DataFrame, views, labelled, labelling, given, factor, weights, steps: int = STEPS):
    """Weights of both views by Newton steps over the labelled rows and the given labels; a step that does
    not lower the loss is halved."""
    context = rows.sparkSession.sparkContext
    weights, best, step = list(weights), [None, None], [None, None]
    for _ in range(steps):
        shared = context.broadcast((views, labelling, given, weights))
        total, at = _summed(rows, shared, _slopes), 0
        shared.unpersist()
        moved = 0.0
        for view, (x, y) in enumerate(labelled):
            d = x.shape[1]
            part = total[at:at + 1 + d + d * (d + 1) // 2]
            at += len(part)
            given_hess = np.zeros((d, d))
            given_hess[np.triu_indices(d)] = part[1 + d:]
            given_hess += np.triu(given_hess, 1).T
            w = weights[view]
            ridge = np.full(d, L2 * (len(y) + factor[view][1]))
            ridge[-1] = 1e-9
            loss, grad, hess = _newton(x, y, np.ones(len(y)), w)
            f = factor[view][0]
            loss += f * part[0] + (ridge * w * w).sum() / 2
            if best[view] is not None and loss > best[view] + 1e-9 * abs(best[view]):
                step[view] = step[view] / 2
                weights[view] = w + step[view]  # half the way back
            else:
                best[view] = loss
                step[view] = np.linalg.solve(hess + f * given_hess + np.diag(ridge),
                                             grad + f * part[1:1 + d] + ridge * w)
                weights[view] = w - step[view]
            moved = max(moved, np.abs(step[view]).max())
        if moved < 1e-2:  # the next step would be near its square
            break
    return weights


def fit(docs: DataFrame, labels: DataFrame, learn=None, sample: int = SAMPLE) -> QualityModel:
    """Co-training on at most ``sample`` labelled rows (a fifth only to calibrate), those of least id
    hash, and all unlabelled ones.  ``learn``: a condition on ``id``."""
    own = tuple(c for c in ("text", "lang", "source") if c in docs.columns)
    known = labelled_sample(docs, labels, "quality", sample, learn, columns=own)
    mats, y = _collected(known.select("id", "label", *own))
    if not len(y) or y.min() == y.max():
        zero = [(0.0, 1.0, np.zeros(1), (0.0, 0.0))] * 2
        return _Constant(zero, 0.5 if not len(y) else float(y[0]))
    # the vectors are smaller than the texts, so they are what is dealt by id; labels may be as many as documents
    every = _vectors(docs.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("id"), F.lit(0).alias("label"), *own))
    ids = labels.select(F.col("doc_id").alias("id")).distinct().hint("merge")
    rows = stored(every.join(ids, "id", "left_anti").select("a", "b"), "pool")

    test = np.arange(len(y)) % 5 == 0
    train = ~test
    views = [(x.mean(axis=0), x.std(axis=0) + 1e-3) for x in mats]
    scaled = [(x - centre) / scale for x, (centre, scale) in zip(mats, views)]
    weights = [fit_dense(x[train], y[train], L2) for x in scaled]
    labelled = [(np.hstack([x[train], np.ones((train.sum(), 1))]), y[train]) for x in scaled]
    # the rounds below need no more of the sample than this: the driver's memory is small
    mats, scaled = [x[test] for x in mats], [x[test] for x in scaled]
    release()
    met = 0
    for turn in range(ROUNDS):
        shared = Shared(docs.sparkSession, (views, weights))
        counts = _summed(rows, shared, _histogram)
        shared.unpersist()
        if not len(counts):
            break
        counts = counts.reshape(2, BINS)
        met = int(counts[0].sum())
        n = int(SURE * (turn + 1) * met)
        n_ones = int(round(n * y.mean()))
        given = [shares(c, n - n_ones, n_ones) for c in counts]
        # (weight of a given label, weight of all) for the view that receives them
        mass = [float(((low + high) * c).sum()) for c, (low, high) in zip(counts, given)][::-1]
        factor = [(f, f * m) for m in mass for f in (min(GIVEN, train.sum() / max(m, 1)),)]
        weights = refit(rows, views, labelled, list(weights), given, factor, weights)
    done = []
    for (centre, scale), x, w in zip(views, scaled, weights):
        margin = np.clip(np.hstack([x, np.ones((len(x), 1))]) @ w, -30, 30)
        done.append((centre, scale, w, fit_dense(margin[:, None], y[test], 1e-3)))
    odds = np.stack([_odds(x, v) for x, v in zip(mats, done)], axis=1)
    del labelled
    release()
    return QualityModel(done, fit_dense(odds, y[test], 1e-3), met)


class _Constant(QualityModel):
    """Without two labels: the only label for all, or one half."""

    def score(self, part, text="text"):
        same = np.full(part.num_rows, self.combine)
        return same, same, same


def score_quality(docs: DataFrame, model: QualityModel, text: str = "text",
                  threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` plus quality, content_score, page_score (double, 0 to 1) and kept (quality at
    least the threshold); columns of these names are replaced, others pass through."""
    docs = without(docs, *ADDED)
    shared = Shared(docs.sparkSession, model)

    def run(batches):
        for part in slices(batches, text, SLICE):
            both, a, b = shared.value.score(part, text)
            for name, values in (("quality", both), ("content_score", a), ("page_score", b),
                                 ("kept", both >= threshold)):
                part = part.append_column(name, pa.array(values))
            yield part

    return docs.mapInArrow(
        run, ddl(docs) + ", quality double, content_score double, page_score double, kept boolean")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` less the rows that the classifier, fitted on them, rejects; columns unchanged."""
    scored = score_quality(beside(docs, *ADDED), fit(docs, labels))
    return back(scored.where("kept"), docs.columns, *ADDED)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What op7 returns; as in op9, a third of the ids is never learned from (held_out)."""
    def held(c):
        return F.coalesce(F.crc32(F.col(c).cast("string")) % 3 == 1, F.lit(False))
    model = fit(docs, labels, ~held("id"))
    scored = score_quality(docs.select("doc_id", "text", "lang", "source"), model)
    return scored.select("doc_id", held("doc_id").alias("held_out"), "quality", "content_score",
                         "page_score", "kept")
