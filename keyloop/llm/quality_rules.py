"""Quality rules: base counts of each text, and a hashed n-gram log-likelihood ratio.

Words and word pairs are hashed into ``BUCKETS`` buckets.  One multinomial over the buckets comes from a
trusted target (documents labelled as good), one from all documents.  A document's verdict is the
log-likelihood ratio of its n-grams under the two, divided by their number, held against a
fixed threshold: every document gets the same verdict in every run.  The raw counts cover all
documents, the target and the threshold all labelled rows.

A word has two features, its letters and digits (lower-cased ASCII) and the other ASCII characters it carries;
pairs are of the former.  The threshold separates the labelled rows best (half the sum of the
shares judged right), but never rejects more than ``TARGET_LOSS`` of the trusted ones.

Definitions: words are runs of bytes other than 20, 09-0D (hex); a null text has none, fails
the base rules (under 10 words) and has the ratio 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloop.llm.learning import labelled, vector_sum
from keyloop.llm.ordering import dealt, running
from keyloop.llm.text import (Shared, ddl, inside, mix, ngram_hashes, owners, raw_bytes, slices,
                              split_words, stored, without)

BUCKETS = 10_000
TARGET_LOSS = 0.002
SMOOTHING = 1.0
REPEAT_WINDOW = 5
_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_LETTER = bytes(b for b in range(256) if 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)
_OTHER = bytes(b for b in range(256) if b not in _LETTER)


def _distinct(words: pa.Array) -> tuple[list[bytes], np.ndarray]:
    coded = words.cast(pa.large_binary()).dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy()


def _buckets(words: pa.Array, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of all n-grams."""
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    vocabulary, index = _distinct(words)
    core = np.fromiter((xxhash.xxh3_64_intdigest(w.translate(None, _OTHER).lower()) for w in vocabulary),
                       np.uint64, len(vocabulary))
    rest = [w.translate(None, _LETTER) for w in vocabulary]
    extra = np.fromiter((xxhash.xxh3_64_intdigest(w, 1) if w else 0 for w in rest), np.uint64, len(rest))
    own, n = owners(offsets), np.uint64(BUCKETS)
    pairs = ngram_hashes(core[index], 2)
    ok = inside(offsets, 2, len(pairs))
    marked = extra[index] != 0
    return (np.concatenate([core[index] % n, extra[index][marked] % n, mix(pairs[ok]) % n]).astype(np.int64),
            np.concatenate([own, own[marked], own[:len(pairs)][ok]]))


def _count(target: bool):
    """Bucket counts; with ``target`` of the rows labelled 1 only."""
    def run(batches):
        total = np.zeros(BUCKETS)
        for part in slices(batches):
            if target:
                part = part.filter(pc.equal(part.column("label"), 1))
            words, offsets = split_words(part.column("text"))
            total += np.bincount(_buckets(words, offsets)[0], minlength=BUCKETS)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["v"])
    return run


def ratios(words: pa.Array, offsets: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Length-normalised log-likelihood ratio of each text, 0 for none."""
    bucket, text = _buckets(words, offsets)
    n = len(offsets) - 1
    return np.bincount(text, weights[bucket], n) / np.maximum(1, np.bincount(text, minlength=n))


class RatioModel:
    def __init__(self, weights: np.ndarray, threshold: float):
        self.weights, self.threshold = weights, threshold


def _threshold(rows: DataFrame) -> float:
    """The documented threshold from all ``rows(label, ratio)``.

    The distinct ratios are sorted in ranges over the tasks and carry how many rows of either kind lie
    below; only single rows reach the driver."""
    one = F.when(F.col("label") == 1, 1).otherwise(0)
    counts = rows.groupBy("ratio").agg(F.sum(one).alias("good"), F.sum(1 - one).alias("bad"))
    order = [F.col("ratio")]
    tries = dealt(counts, order, "ratios")
    good, bad = (x or 0 for x in tries.agg(F.sum("good"), F.sum("bad")).first())
    if not good:
        return -np.inf
    tries = running(tries, [], order, F.col("good"), "good_below")
    lost = int(TARGET_LOSS * good)
    most = tries.where((F.col("good_below") <= lost) & (F.col("good_below") + F.col("good") > lost)).first().ratio
    if not bad:
        return float(most)
    tries = running(tries, [], order, F.col("bad"), "bad_below")
    share = lambda c, n: F.col(c).cast("decimal(19,0)") * F.lit(n).cast("decimal(18,0)")
    best = (tries.orderBy((share("bad_below", good) - share("good_below", bad)).desc(), "ratio")
            .select("ratio").first().ratio)
    # halfway to the next value below, so that the verdict does not hang on rounding
    below = counts.where(F.col("ratio") < best).agg(F.max("ratio")).first()[0]
    return float(min((best + (best if below is None else below)) / 2, most))


def fit(docs: DataFrame, labels: DataFrame) -> RatioModel:
    """Raw counts over all of ``docs``; target and threshold from all labelled rows.  Without
    trusted rows every ratio is 0 and every document passes."""
    spark = docs.sparkSession
    known = labelled(docs, labels, "quality").select("label", "text")
    raw = vector_sum(docs.select("text").mapInArrow(_count(False), "v binary"))
    target = vector_sum(known.mapInArrow(_count(True), "v binary"))
    if not len(target) or not target.sum():
        return RatioModel(np.zeros(BUCKETS), -np.inf)
    share = [np.log((c + SMOOTHING) / (c.sum() + SMOOTHING * BUCKETS)) for c in (target, raw)]
    weights = Shared(spark, share[0] - share[1])

    def scored(batches):
        for part in slices(batches):
            words, offsets = split_words(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [part.column("label").cast(pa.int32()), pa.array(ratios(words, offsets, weights.value))],
                names=["label", "ratio"])

    rows = stored(known.mapInArrow(scored, "label int, ratio double"), "ratios-of-labelled")
    return RatioModel(weights.value, _threshold(rows))


def _base(col: pa.Array, words: pa.Array, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The base counts of each text."""
    n = len(offsets) - 1
    ends, data = raw_bytes(col)
    raw = bytes(data)
    symbols = np.concatenate([[0], np.cumsum(_SYMBOLS[np.frombuffer(raw, np.uint8)])])
    chars = np.concatenate([[0], np.cumsum(pc.utf8_length(words).to_numpy(zero_copy_only=False))])
    dup = np.zeros(n, np.int64)
    for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
        lines = [x for x in raw[a:b].split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
        dup[i] = len(lines) - len(set(lines))
    repeated = np.zeros(len(words), bool)
    if len(words):
        vocabulary, index = _distinct(words)
        codes = np.fromiter(map(xxhash.xxh3_64_intdigest, vocabulary), np.uint64, len(vocabulary))[index]
        wins = ngram_hashes(codes, REPEAT_WINDOW)
        at = np.flatnonzero(inside(offsets, REPEAT_WINDOW, len(wins)))
        own = owners(offsets)[at]
        order = np.lexsort((wins[at], own))
        w, t = wins[at][order], own[order]
        same = np.zeros(len(order) + 1, bool)
        same[1:-1] = (w[1:] == w[:-1]) & (t[1:] == t[:-1])
        starts = at[order][same[1:] | same[:-1]]
        step = np.bincount(starts, minlength=len(words) + REPEAT_WINDOW)
        step = step - np.concatenate([np.zeros(REPEAT_WINDOW, np.int64), step[:-REPEAT_WINDOW]])
        repeated = np.cumsum(step)[:len(words)] > 0
    return {"n_words": np.diff(offsets), "word_chars": np.diff(chars[offsets]).astype(np.int64),
            "n_symbols": np.diff(symbols[ends]), "n_dup_lines": dup,
            "n_repeat_words": np.diff(np.concatenate([[0], np.cumsum(repeated)])[offsets])}


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(docs: DataFrame, model: RatioModel, text: str = "text") -> DataFrame:
    """``docs`` plus the base counts, base_failed, ratio and kept; columns of these names are
    replaced, others pass through."""
    docs = without(docs, *COUNTS, "base_failed", "ratio", "kept")
    shared = Shared(docs.sparkSession, model)

    def run(batches):
        for part in slices(batches, text):
            words, offsets = split_words(part.column(text))
            base = _base(part.column(text), words, offsets)
            ratio = ratios(words, offsets, shared.value.weights)
            failed = (base["n_words"] < 10) | (100 * base["n_repeat_words"] > 20 * base["n_words"])
            added = base | {"base_failed": failed, "ratio": ratio,
                            "kept": ~failed & (ratio >= shared.value.threshold)}
            for name, values in added.items():
                part = part.append_column(name, pa.array(values))
            yield part

    added = ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, ratio double, kept boolean"
    return docs.mapInArrow(run, f"{ddl(docs)}, {added}")


def rules_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What op5 returns."""
    judged = judge(docs.select("doc_id", "text"), fit(docs, labels))
    return judged.select("doc_id", *COUNTS, "base_failed", "kept", "ratio")
