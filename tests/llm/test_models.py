"""Quality rules, quality classifier, language model and toxicity: exact parts by brute force, learned
parts by accuracy on rows that were not learned from."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_data import LOWER, docs, empty, words
from pyspark.sql import functions as F

from keyloop.llm import lm_scoring as lm
from keyloop.llm import quality_classifier as qc
from keyloop.llm import quality_rules as rules
from keyloop.llm import toxicity as tox
from keyloop.llm.learning import _added, vector_sum
from keyloop.llm.queries import QUERIES
from keyloop.llm.text import tables

SF = "/root/testdata/sf0.01"


def _labels(spark, df, column):
    """Every second id 0; null and repeated labels too."""
    return (df.select("doc_id", (F.col("doc_id") % 2).cast("int").alias(column)).where("doc_id > 3")
            .union(spark.createDataFrame([(5, None), (None, 1), (10, 1), (10, 0)], f"doc_id long, {column} int")))


def _base(text):
    w, seen, dup = words(text), set(), 0
    for x in (text or "").split("\n"):
        if words(x):
            dup += x in seen
            seen.add(x)
    wins = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    hit = {p for i in range(len(w) - 4) if wins[tuple(w[i:i + 5])] > 1 for p in range(i, i + 5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit)


def test_rules_base_counts(spark):
    df = docs(spark).union(docs(spark, odd_ids=False).withColumn("text", F.concat("text", F.lit("\n# "), "text")))
    judged = rules.judge(df, rules.RatioModel(np.zeros(rules.BUCKETS), -np.inf))
    for r in judged.collect():
        want = _base(r.text)
        assert tuple(r[c] for c in rules.COUNTS) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert r.kept == (not r.base_failed) and r.ratio == 0


def test_rules_ratio(spark):
    """The ratio is the mean weight of the hashed n-grams, the model's counts cover all rows."""
    df = docs(spark)
    model = rules.fit(df, _labels(spark, df, "quality"))
    for r in rules.judge(df, model).collect():
        from keyloop.llm.text import split_words
        bucket, _ = rules._buckets(*split_words(pa.array([r.text], pa.string())))
        want = model.weights[bucket].mean() if len(bucket) else 0.0
        assert r.ratio == pytest.approx(want) and r.kept == (not r.base_failed and r.ratio >= model.threshold)


def _threshold(good, bad):
    """The documented threshold, by all ratios in one place."""
    most = np.sort(good)[int(rules.TARGET_LOSS * len(good))]
    if not len(bad):
        return most
    tries = np.unique(np.concatenate([good, bad]))
    right = [int((bad < t).sum()) * len(good) - int((good < t).sum()) * len(bad) for t in tries]
    best = int(np.argmax(right))
    return min((tries[best] + tries[max(0, best - 1)]) / 2, most)


@pytest.mark.parametrize("most_bad", [9, 0])
def test_rules_learn_from_all_labelled_rows(spark, most_bad):
    """More labelled rows than any sample held: the target counts and the threshold come from every one."""
    from keyloop.llm.text import split_words
    df = spark.range(24_000).selectExpr(
        "id AS doc_id", "concat('w', id % 7, ' x', id % 11, IF(id % 10 < 3, ' buy | now', ' and more')) AS text")
    labels = df.selectExpr("doc_id", f"int(NOT (doc_id % 10 < 4 AND doc_id % 10 < {most_bad})) AS quality")
    model = rules.fit(df, labels)
    got = df.join(labels, "doc_id").toPandas()

    def buckets(texts):
        return rules._buckets(*split_words(pa.array(texts, pa.string())))[0]
    counts = [np.bincount(buckets(t), minlength=rules.BUCKETS) for t in (got.text[got.quality == 1], got.text)]
    share = [np.log((c + rules.SMOOTHING) / (c.sum() + rules.SMOOTHING * rules.BUCKETS)) for c in counts]
    assert model.weights == pytest.approx(share[0] - share[1], abs=1e-12)
    ratio = rules.ratios(*split_words(pa.array(got.text, pa.string())), model.weights)
    good = (got.quality == 1).to_numpy()
    assert model.threshold == pytest.approx(_threshold(ratio[good], ratio[~good]), abs=1e-12)


@pytest.mark.parametrize("kind", ["long", "int", "string"])
def test_labelled_moves_few_other_texts(spark, kind, monkeypatch):
    """All labelled rows, of repeated ids one, whatever the type of the ids; other texts mostly stay where they are."""
    from keyloop.llm import learning
    df = spark.range(20_000).selectExpr(f"CAST(IF(id % 1000 = 7, NULL, id) AS {kind}) AS doc_id", "concat('t', id) AS text")
    df = df.union(df.where("doc_id < 100").selectExpr("doc_id", "concat('u', text)"))
    labels = spark.range(0, 20_100, 5).selectExpr("id AS doc_id", "IF(id % 3 = 0, NULL, int(id % 2)) AS quality")
    want = {i: (i % 2, f"t{i}") for i in range(0, 20_000, 5) if i % 3 and i % 1000 != 7}
    got = [(int(r.id), (r.label, r.text)) for r in learning.labelled(df, labels, "quality").collect()]
    assert len(got) == len(want) and dict(got) == want
    moved = []
    among = learning.among
    monkeypatch.setattr(learning, "among", lambda *a: moved.append(among(*a)) or moved[-1])
    learning.labelled(df, labels, "quality")
    if kind == "long":  # hashes of ids of other types are not comparable
        assert len(want) <= moved[0].count() < 8_000
    else:
        assert not moved


def test_rules_separate(spark):
    got = QUERIES["op5_quality_rules"](spark, SF).join(tables(spark, SF, "labels"), "doc_id").toPandas()
    good = got[(got.quality == 1) & ~got.base_failed]
    assert good.kept.mean() > 0.98 and got[got.quality == 0].kept.mean() < 0.05


def test_classifier_meets_all_unlabelled_rows(spark):
    df = (spark.range(9_000).select(F.col("id").alias("doc_id"), F.when(
        F.col("id") % 2 == 0, F.concat(F.lit("plain words of text "), "id")).otherwise(
        F.concat(F.lit("#$% || BUY "), "id")).alias("text"), F.lit("en").alias("lang"), F.lit("web").alias("source")))
    labels = df.where("doc_id < 400").select("doc_id", (1 - F.col("doc_id") % 2).cast("int").alias("quality"))
    assert qc.fit(df, labels).met == 8_600


def test_classifier_summed_steps(spark):
    """Steps over tasks' sums end where the fit in one place ends; a bin at the cut counts by a share."""
    rng = np.random.default_rng(3)
    xs = [rng.normal(size=(300, d)).astype("<f4") for d in (3, 2)]
    y = (xs[0][:, 0] + xs[1][:, 0] + rng.normal(size=300) > 0).astype(float)
    rows = spark.createDataFrame([(bytearray(a.tobytes()), bytearray(b.tobytes())) for a, b in zip(*xs)],
                                 "a binary, b binary").repartition(3)
    views = [(np.zeros(d), np.ones(d)) for d in (3, 2)]
    labelled = [(np.hstack([x[:100], np.ones((100, 1))]), y[:100]) for x in xs]
    labelling = [np.array([2.0, 0.5, 0, 0]), np.array([1.5, 0, 0.1])]
    ones = [np.hstack([x, np.ones((300, 1))]) for x in xs]
    counts = [np.bincount(qc._bins(x, w), minlength=qc.BINS).astype(float) for x, w in zip(ones, labelling)]
    given = [qc.shares(c, 30, 20) for c in counts]
    got = qc.refit(rows, views, labelled, labelling, given, [(0.5, 10.0)] * 2, [np.zeros(4), np.zeros(3)], 30)
    for view in (0, 1):
        low, high = (t[qc._bins(ones[1 - view], labelling[1 - view])] for t in given[1 - view])
        own = low + high > 0
        want = qc.fit_dense(np.vstack([xs[view][:100], xs[view][own]]), np.append(y[:100], high[own] > 0),
                            qc.L2 * 110 / (100 + own.sum()), weight=np.append(np.ones(100), 0.5 * (low + high)[own]))
        assert got[view] == pytest.approx(want, abs=1e-3)
    low, high = qc.shares(np.bincount([0, 0, 0, 0, 5, qc.BINS - 1], minlength=qc.BINS), 2, 3)
    assert low[0] == 0.5 and not low[1:5].any() and high[-1] == 1 and not high[5]


def test_classifier_on_held_out_rows(spark):
    got = QUERIES["op7_quality_classifier"](spark, SF).join(
        tables(spark, SF, "labels").withColumnRenamed("quality", "label"), "doc_id").toPandas()
    held = got[got.held_out]
    assert held[held.label == 1].kept.mean() > 0.97 and held[held.label == 0].kept.mean() < 0.1
    assert got[["quality", "content_score", "page_score"]].stack().between(0, 1).all()


def test_classifier_odd_rows(spark):
    df = docs(spark)
    labels = _labels(spark, df, "quality")
    got = qc.score_quality(df, qc.fit(df, labels))
    assert got.count() == df.count() and "Kept" not in got.columns
    assert qc.keep_good(df, labels).columns == df.columns
    one = labels.withColumn("quality", F.lit(1))
    assert qc.keep_good(df, one).count() == df.count()  # a single label: constant
    assert qc.score_quality(empty(spark), qc.fit(empty(spark), labels)).count() == 0


def test_lm_counts_and_sum_to_one(spark):
    df = docs(spark)
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    learned = [(i, t) for i, t in rows if i is not None and zlib.crc32(str(i).encode()) % 10]
    counts = Counter(x for _, t in learned for x in words(t, lower=True))
    total, distinct = sum(counts.values()) + len(learned), len(counts) + 1
    below = math.log10(total + 0.1 * (distinct + 1))
    for r in lm.lm_scores(df).collect():
        assert r.train_tokens == total and r.score < 0
    by_id = {}
    for r in lm.lm_scores(df).collect():
        by_id.setdefault(r.doc_id, []).append(r)
    for ident, text in rows:
        w = words(text, lower=True)
        want = sum(math.log10(counts[x] + 0.1) for x in w) + math.log10(len(learned) + 0.1) - below * (len(w) + 1)
        known = sum(counts[x] > 0 for x in w) + 1
        assert any(r.n_tokens == len(w) + 1 and r.n_known == known
                   and r.base_score == pytest.approx(want) for r in by_id[ident])


def test_lm_probabilities_add_up(spark):
    """Over the whole vocabulary and one unseen word a group, after any context."""
    df = docs(spark, odd_ids=False).select("doc_id", "text")
    model, counts = lm.fit(df)
    table = {bytes(r.word): r.n for r in counts.collect()}
    context = np.array([[5, 9, lm.CLASSES + 3, lm.INPUTS - 1]], np.int32)
    by_class = 10 ** model.class_logs(np.arange(lm.CLASSES), np.repeat(context, lm.CLASSES, axis=0))
    short = set(model.head.words[:lm.SHORT].to_pylist())
    mass = 10 ** model.group_log
    total = by_class[0] + by_class[1:1 + len(short)].sum()
    share = np.zeros(lm.CLASSES)
    for w, n in table.items():
        if w not in short:
            g, _ = lm.spelling(w)
            share[g] += (n + lm.ALPHA) / mass[g]
    groups = np.arange(1 + lm.SHORT, lm.CLASSES)
    total += (by_class[groups] * (share[groups] + lm.ALPHA / mass[groups])).sum()
    total += by_class[1 + len(short):1 + lm.SHORT].sum()  # classes without a word yet
    assert total == pytest.approx(1, abs=1e-5)


def test_lm_beats_unigrams_on_held_out_rows(spark):
    got = QUERIES["op8_lm_scoring"](spark, "/root/testdata/sf0.01").where("held_out").agg(
        F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


def test_lm_without_training_rows(spark):
    df = docs(spark).where("doc_id IS NULL")
    assert lm.lm_scores(df).where("score < 0 AND train_tokens = 0").count() == df.count()
    assert lm.lm_scores(empty(spark)).count() == 0


def test_toxicity_on_held_out_rows(spark):
    got = QUERIES["op9_toxicity"](spark, "/root/testdata/sf0.1").join(
        tables(spark, "/root/testdata/sf0.1", "labels"), "doc_id").where("held_out").toPandas()
    caught = got[got.toxic == 1].predicted.mean()
    assert caught > 0.8 and got[got.toxic == 0].predicted.mean() < 0.01
    assert got.score.between(0, 1).all()


def test_toxicity_odd_rows(spark):
    df = docs(spark)
    labels = _labels(spark, df, "toxic")
    got = tox.score_toxicity(df, tox.fit(df, labels))
    assert got.count() == df.count() and dict(got.dtypes)["score"] == "double"
    none = tox.fit(df, labels.limit(0))
    assert {r.score for r in tox.score_toxicity(df, none).collect()} == {0.5}
    assert tox.score_toxicity(empty(spark), none).count() == 0


def test_toxicity_counts_presence_only(spark):
    slot = np.full(tox.BUCKETS, -1, np.int16)
    bucket = tox.ngram_buckets(pa.array(["idio"]))[1][0][0]
    slot[bucket] = 3
    text, feature = tox._hits(pa.array(["an IDIOT idiot", "id", None, "x", "idiocy"]), slot)
    assert list(text) == [0, 4] and list(feature) == [3, 3]


def test_vectors_are_summed_by_other_tasks_than_make_them(spark):
    """One Python worker a task: no stage has two Python steps."""
    def made(batches):
        total = np.zeros(3)
        for batch in batches:
            for i in batch.column("id").to_pylist():
                total += [1, i, 0.5]
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["v"])

    rows = spark.range(0, 100, 1, 7).mapInArrow(made, "v binary")
    assert vector_sum(rows, 2).tolist() == [100, 4950, 50]
    assert vector_sum(rows.where("v IS NULL"), 2).tolist() == []
    stages = _added(rows, 2)._jdf.queryExecution().sparkPlan().toString().split("Exchange")
    assert [s.count("MapInArrow") for s in stages] == [1, 1]
