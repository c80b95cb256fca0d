"""LM scoring: a log-bilinear model, trained in numpy with noise-contrastive estimation.

Output classes: the end, the ``SHORT`` most frequent words, and ``GROUPS`` groups of all other
words by their last two bytes.  A word of a group has the class's probability times its share of
the group's smoothed count, so the probabilities of all words, unseen ones included, add up to one.
The class score is ``r_class . (sum of c_i * q_word(i) over CONTEXT words before) + bias``.

1. Counts of all training words, by a shuffle of word counts.  The ``HEAD`` most frequent words
   are broadcast with their counts: a fixed number, whatever the vocabulary.
2. Every task trains on all its training tokens from the same start: per batch the classes of
   the tokens are told from noise classes, drawn by unigram frequency and shared by the batch,
   in matrix products.  The tasks' parameters are averaged by tokens (fixed size).
3. Scoring: batched products give every token's scores of all classes; their softmax is exact.
   Counts of words beyond the head join by the word; the rest of a text's sum stays in its task.

Definitions: tokens are runs of bytes other than 20, 09-0D (hex), A-Z lower-cased, then one end
a text, counted as a token.  A null text is empty: one end.  Rows with a null id are scored, not
learned from.  Rows of equal id and text get equal scores.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloop.llm.learning import vector_sum
from keyloop.llm.text import Shared, ascii_lower_table, slices, split_words, stored

SHORT, GROUPS = 319, 64
CLASSES = 1 + SHORT + GROUPS
#: Words whose counts are broadcast.
HEAD = 1 << 18
CONTEXT, WIDTH = 4, 16
#: Context words: classes, then hashes of the words that are in groups, then the start.
HASHED = 2048
INPUTS = CLASSES + HASHED + 1
BATCH, NOISE, RATE = 2048, 64, 0.08
#: Tokens that are scored at once: their scores of all classes stay in a core's cache.
SCORED = 512
ALPHA = 0.1  # added to each count
_LOWER = ascii_lower_table()


class Head:
    """The broadcast words in order of frequency: log10(count + ALPHA), class and input ids."""

    def __init__(self, words: list[bytes], counts: list[int]):
        self.words = pa.array(words, pa.large_binary())
        self.log_count = np.log10(np.array(counts, float) + ALPHA)
        short = min(SHORT, len(words))
        rest = [spelling(w) for w in words[short:]]
        self.classes = np.array([*range(1, short + 1), *(g for g, _ in rest)], np.int32)
        self.inputs = np.array([*range(1, short + 1), *(i for _, i in rest)], np.int32)


def spelling(word: bytes) -> tuple[int, int]:
    """(class, input id) of a word that is not on the short list."""
    return 1 + SHORT + zlib.crc32(word[-2:]) % GROUPS, CLASSES + zlib.crc32(word) % HASHED


def _coded(col: pa.Array, head: Head):
    """Flat (class, input, log count, is tail) of all words, offsets, words."""
    words, offsets = split_words(col, _LOWER)
    coded = words.cast(pa.large_binary()).dictionary_encode()
    own, index = coded.dictionary, coded.indices.to_numpy()
    at = pc.fill_null(pc.index_in(own, value_set=head.words), -1).to_numpy(zero_copy_only=False)
    classes = np.zeros(len(own), np.int32)
    inputs, logs = np.zeros(len(own), np.int32), np.zeros(len(own))
    known = at >= 0
    classes[known], inputs[known] = head.classes[at[known]], head.inputs[at[known]]
    logs[known] = head.log_count[at[known]]
    tail = np.flatnonzero(~known)
    if len(tail):
        spelled = np.array([spelling(w) for w in own.take(pa.array(tail)).to_pylist()], np.int32)
        classes[tail], inputs[tail] = spelled[:, 0], spelled[:, 1]
    if not len(own):
        return classes, inputs, logs, known, offsets, words
    return classes[index], inputs[index], logs[index], ~known[index], offsets, words


def _tokens(classes, inputs, offsets):
    """(class of each token with ends, inputs of its CONTEXT words), texts one after another."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    total = len(classes) + n
    text = np.repeat(np.arange(n), size)
    out = np.zeros(total, np.int32)
    out[np.arange(len(classes)) + text] = classes
    # the inputs with CONTEXT starts before each text
    line = np.full(len(inputs) + CONTEXT * n, INPUTS - 1, np.int32)
    line[np.arange(len(inputs)) + CONTEXT * (text + 1)] = inputs
    own = np.repeat(np.arange(n), size + 1)
    at = np.arange(total) - own + CONTEXT * (own + 1)
    return out, np.stack([line[at - j] for j in range(1, CONTEXT + 1)], axis=1)


class Parameters:
    """Output rows r and bias, input rows q, position weights c; one float64 vector when stored."""

    SHAPES = (("r", (CLASSES, WIDTH)), ("bias", (CLASSES,)), ("q", (INPUTS, WIDTH)), ("c", (CONTEXT, WIDTH)))

    def __init__(self, flat: np.ndarray):
        at = 0
        for name, shape in self.SHAPES:
            n = int(np.prod(shape))
            setattr(self, name, flat[at:at + n].reshape(shape).astype(np.float32))
            at += n

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n, _ in self.SHAPES]).astype(np.float64)

    @staticmethod
    def start(share: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(7)
        return np.concatenate([
            rng.normal(0, 0.1, CLASSES * WIDTH), np.log(share), rng.normal(0, 0.1, INPUTS * WIDTH),
            np.full(CONTEXT * WIDTH, 0.5)])

    def gathered(self, inputs: np.ndarray) -> list[np.ndarray]:
        """The input rows of each place of the context."""
        return [self.q.take(inputs[:, j], axis=0) for j in range(CONTEXT)]

    def context(self, rows: list[np.ndarray]) -> np.ndarray:
        out = rows[0] * self.c[0]
        for j in range(1, CONTEXT):
            out += rows[j] * self.c[j]
        return out


def _logistic(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-x))


def _equal_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct rows, an order that brings equal ones together, where each begins in it)."""
    order = np.argsort(rows.astype(np.uint16), kind="stable")
    rows = rows[order]
    first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    return rows[first], order, first


def _train(share: np.ndarray, start: np.ndarray):
    """Task code: (class, inputs) of slices to this task's parameters times its tokens."""
    log_noise = np.log(NOISE * share).astype(np.float32)
    cdf = np.cumsum(share)

    def run(token_slices):
        p, rng, seen = Parameters(start), np.random.default_rng(11), 0
        sq = {n: np.full(s, 1.0, np.float32) for n, s in Parameters.SHAPES}  # Adagrad

        def step(name, rows, grad):
            acc = sq[name]
            if rows is None:
                acc += grad * grad
                getattr(p, name)[...] -= RATE * grad / np.sqrt(acc)
            else:
                rows, order, first = rows
                grad = np.add.reduceat(grad.take(order, axis=0), first, axis=0)
                own = acc[rows] + grad * grad
                acc[rows] = own
                getattr(p, name)[rows] -= RATE * grad / np.sqrt(own)

        for classes, inputs in token_slices:
            for a in range(0, len(classes), BATCH):
                y, x = classes[a:a + BATCH], inputs[a:a + BATCH]
                noise = np.minimum(np.searchsorted(cdf, rng.random(NOISE)), CLASSES - 1)
                q, r_y, r_noise = p.gathered(x), p.r.take(y, axis=0), p.r[noise]
                h = p.context(q)
                true = (h * r_y).sum(axis=1) + p.bias[y] - log_noise[y]
                false = h @ r_noise.T + (p.bias[noise] - log_noise[noise])
                g_true = _logistic(true) - 1
                g_false = _logistic(false)
                g_h = g_true[:, None] * r_y + g_false @ r_noise
                rows = _equal_rows(np.concatenate([y, noise]))
                step("r", rows, np.concatenate([g_true[:, None] * h, g_false.T @ h]))
                step("bias", rows, np.concatenate([g_true, g_false.sum(axis=0)]))
                g_c = np.stack([(g_h * q[j]).sum(axis=0) for j in range(CONTEXT)])
                step("q", _equal_rows(x.T.ravel()), np.concatenate([g_h * p.c[j] for j in range(CONTEXT)]))
                step("c", None, g_c)
                seen += len(y)
        return p.flat() * seen, seen

    return run


class LanguageModel:
    def __init__(self, flat, head: Head, group_log: np.ndarray, total: int, distinct: int):
        self.p, self.head, self.group_log = Parameters(flat), head, group_log
        self.total, self.distinct = total, distinct
        #: log10 of the denominator of the base probability
        self.base = np.log10(max(total, 1) + ALPHA * (distinct + 1)) if total else np.log10(ALPHA)

    def class_logs(self, classes: np.ndarray, inputs: np.ndarray) -> np.ndarray:
        """Exact log10 probabilities of the classes."""
        out, one = np.empty(len(classes)), np.ones(CLASSES, np.float32)
        rows = np.ascontiguousarray(np.hstack([self.p.r, self.p.bias[:, None]]).T)
        longest = float(np.sqrt((rows.astype(float) ** 2).sum(axis=0).max()))
        for a in range(0, len(classes), SCORED):
            y = classes[a:a + SCORED]
            h = np.ones((len(y), WIDTH + 1), np.float32)
            h[:, :WIDTH] = self.p.context(self.p.gathered(inputs[a:a + SCORED]))
            s = h @ rows
            # exp may leave the range of float32 (no score is over the product of the lengths)
            if longest * float(np.sqrt(np.einsum("ij,ij->i", h, h).max())) > 60 and s.max() > 60:
                s -= s.max(axis=1, keepdims=True)
            own = s[np.arange(len(y)), y].astype(float)
            np.exp(s, out=s)
            out[a:a + SCORED] = (own - np.log((s @ one).astype(float))) / np.log(10)
        return out


def _remainder():
    return F.crc32(F.col("doc_id").cast("string")) % 10


def _word_counts(batches):
    """Counts of the words of each slice, and of ends under the null word."""
    for part in slices(batches):
        words, _ = split_words(part.column("text"), _LOWER)
        c = words.cast(pa.large_binary()).value_counts()
        yield pa.RecordBatch.from_arrays(
            [pa.concat_arrays([c.field("values").cast(pa.binary()), pa.array([None], pa.binary())]),
             pa.concat_arrays([c.field("counts"), pa.array([part.num_rows], pa.int64())])],
            names=["word", "n"])


def _group_column(word):
    """The class of a word beyond the short list, as ``spelling`` has it."""
    return 1 + SHORT + F.crc32(F.expr(f"substring({word}, -2, 2)")) % GROUPS


def fit(docs: DataFrame):
    """(model, counts table) from all documents whose ``doc_id`` is learned from.

    ``docs`` has doc_id and text.  Without training documents all classes are equally likely."""
    spark = docs.sparkSession
    train = docs.where(_remainder() != 0).select("text")
    counted = stored(train.mapInArrow(_word_counts, "word binary, n long")
                     .groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    sums = counted.agg(F.sum("n"), F.count("*"), F.sum(F.when(F.col("word").isNull(), F.col("n")))).first()
    total, distinct, ends = sums[0] or 0, sums[1], sums[2] or 0
    words = counted.where("word IS NOT NULL")
    top = words.orderBy(F.desc("n"), "word").limit(HEAD).toArrow()
    names, counts = top.column("word").to_pylist(), top.column("n").to_pylist()
    head = Head(names, counts)
    short = spark.createDataFrame([(bytearray(w),) for w in names[:SHORT]], "word binary")
    grouped = (words.join(F.broadcast(short), "word", "left_anti").groupBy(_group_column("word").alias("g"))
               .agg(F.sum(F.col("n") + F.lit(ALPHA)).alias("m")).collect())
    # a group also holds what falls to its unseen words
    mass = np.full(CLASSES, ALPHA)
    mass[0] = ends + ALPHA
    mass[1:1 + len(counts[:SHORT])] = np.array(counts[:SHORT], float) + ALPHA
    for g, m in grouped:
        mass[g] += m
    share = mass / mass.sum()
    start = Parameters.start(share)
    shared = Shared(spark, (head, share, start))

    def learn(batches):
        head, share, start = shared.value

        def tokens():
            for part in slices(batches):
                classes, inputs, _, _, offsets, _ = _coded(part.column("text"), head)
                yield _tokens(classes, inputs, offsets)

        flat, seen = _train(share, start)(tokens())
        if seen:
            v = np.append(flat, seen)
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary())], names=["v"])

    total_vector = vector_sum(train.mapInArrow(learn, "v binary"), 4)
    flat = total_vector[:-1] / total_vector[-1] if len(total_vector) else start
    group_log = np.log10(mass)
    return LanguageModel(flat, head, group_log, int(total), int(distinct)), words


def score_texts(docs: DataFrame, model: LanguageModel, counts: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of each row; log10 of probabilities."""
    spark = docs.sparkSession
    shared = Shared(spark, model)
    kind = docs.schema["doc_id"].dataType.simpleString()
    end_known = int(model.total > 0)

    def run(batches):
        m = shared.value
        for part in slices(batches):
            classes, inputs, logs, tail, offsets, words = _coded(part.column("text"), m.head)
            out, context = _tokens(classes, inputs, offsets)
            n = part.num_rows
            own = np.repeat(np.arange(n), np.diff(offsets) + 1)
            neural = np.bincount(own, m.class_logs(out, context), n)
            text = np.repeat(np.arange(n), np.diff(offsets))
            grouped = classes > SHORT
            # a word's share of its group needs its count: here if in the head, else after the join
            neural -= np.bincount(text[grouped], m.group_log[classes[grouped]], n)
            neural += np.bincount(text[grouped], logs[grouped], n)
            base = np.bincount(text, logs, n)
            cut = np.concatenate([[0], np.cumsum(tail)])[offsets].astype(np.int32)
            rest = words.filter(pa.array(tail)).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("fp"), pa.array(np.diff(offsets) + 1),
                 pa.array(np.bincount(text[~tail], minlength=n).astype(np.int64)), pa.array(base),
                 pa.array(neural), pa.ListArray.from_arrays(pa.array(cut), rest)],
                names=["doc_id", "fp", "n_tokens", "n_head", "base", "neural", "tail"])

    rows = stored(docs.select("doc_id", "text", F.xxhash64("text").alias("fp")).mapInArrow(
        run, f"doc_id {kind}, fp long, n_tokens long, n_head long, base double, neural double, "
             "tail array<binary>"), "scored")
    # a word beyond the head is rare, so no word is hot in this join
    tails = (rows.where(F.size("tail") > 0).dropDuplicates(["doc_id", "fp"])
             .select("doc_id", "fp", F.explode("tail").alias("word")))
    sums = (tails.join(counts, "word", "left").groupBy("doc_id", "fp")
            .agg(F.sum(F.log10(F.coalesce("n", F.lit(0)) + F.lit(ALPHA))).alias("logs"),
                 F.count("n").alias("found")).toDF("__id", "__fp", "logs", "found"))
    logs = F.coalesce("logs", F.lit(0.0))
    end = float(np.log10((10 ** model.group_log[0] if model.total else ALPHA)))
    return (rows.drop("tail").join(
        sums, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("fp") == F.col("__fp")), "left")
        .select("doc_id", "n_tokens",
                (F.col("n_head") + F.coalesce("found", F.lit(0)) + end_known).alias("n_known"),
                (F.col("base") + logs + F.lit(end) - F.col("n_tokens") * F.lit(float(model.base))).alias("base_score"),
                (F.col("neural") + logs).alias("score")))


def lm_scores(docs: DataFrame) -> DataFrame:
    """What op8 returns."""
    docs = docs.select("doc_id", "text")
    model, counts = fit(docs)
    held = F.coalesce(_remainder() == 0, F.lit(False))
    scored = score_texts(docs, model, counts)
    return scored.select("doc_id", held.alias("held_out"), "n_tokens", "n_known",
                         F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score")
