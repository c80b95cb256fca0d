"""The pipeline's stages on the given tables, and the queries with SQL against it."""

import os
import time

import corpus_pipeline
import pytest
from llm_data import brute_components, brute_hits, brute_lines
from oracle_harness import compare
from pyspark.sql import functions as F

from keyloop.llm.byte_bpe import decode, encode, load_ranks
from keyloop.llm.queries import ORACLE, QUERIES
from keyloop.llm.text import stored, tables

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_equal_their_sql(spark, name):
    assert name in QUERIES
    res = compare(spark, SF, [name], verbose=False)[name]
    assert res["ok"], res


def test_stages(spark):
    docs = tables(spark, SF, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, SF), "stage")
        kept[name] = (before, docs)
    for name, (before, after) in list(kept.items())[:-1]:
        assert after.columns == before.columns and after.dtypes == before.dtypes
    def rows(df):
        return sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())

    before, after = map(rows, kept["quality classifier"])
    assert set(after) < set(before)
    good = {r.doc_id for r in tables(spark, SF, "labels").where("quality = 1").collect()}
    assert sum(i in good for i, _ in after) > 0.95 * sum(i in good for i, _ in before)
    before, after = map(rows, kept["line dedup"])
    assert after == sorted((i, w[0]) for (i, _), w in zip(before, brute_lines(before, 10, False)))
    before, after = map(rows, kept["n-gram Jaccard join"])
    groups = brute_components(before, 5, 80, 100)
    assert after == [r for r, g in zip(before, groups) if g[1] == r[0]]
    before, after = map(rows, kept["benchmark decontamination"])
    items = [(r.item_id, r.text) for r in tables(spark, SF, "benchmark").collect()]
    assert after == [r for r in before if not brute_hits(r[1], items, 10)[1]]
    final = kept["byte-level BPE"][1]
    assert sorted(r.doc_id for r in final.collect()) == [i for i, _ in after]


def test_run_is_the_stages_in_order(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "byte-level BPE"]


def test_stages_hand_python_small_batches(spark):
    """Whole batches are held on both sides; a session's own smaller number stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    docs = tables(spark, SF, "documents").limit(5)
    before = spark.conf.get(key)
    try:
        for own, want in (("10000", corpus_pipeline.BATCH_ROWS), ("0", corpus_pipeline.BATCH_ROWS), ("7", 7)):
            spark.conf.set(key, own)
            corpus_pipeline.clean_of_benchmarks(spark, docs, SF)
            assert int(spark.conf.get(key)) == want
    finally:
        spark.conf.set(key, before)


def test_tokenise_needs_one_python_worker_a_task(spark):
    """Encoding and decoding are stages of their own; ids and hashes are those of both in one."""
    import public_tokenizers

    rows = [(1, "en", "a", "one two  three"), (2, None, None, None), (2, "de", "b", "Grüße " * 9000), (None, "x", "c", "")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")
    out = corpus_pipeline.tokenise(spark, docs, SF)
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    ranks = load_ranks(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    both = decode(encode(docs, ranks, public_tokenizers.PATTERN), ranks)
    want = both.selectExpr("doc_id", "lang", "source", "cast(size(ids) as long) n_tokens", "ids", "sha2(decoded, 256)")
    assert sorted(map(str, out.collect())) == sorted(map(str, want.toDF(*out.columns).collect()))


def test_stages_leave_no_shuffle_files(spark):
    """What an execution shuffled goes when it ends, not with the driver's garbage; a frame can run again."""
    jvm = spark.sparkContext._jvm
    dirs = [d.getPath() for d in jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def files():
        return {f for d in dirs for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    try:
        corpus_pipeline.clean_of_benchmarks(spark, tables(spark, SF, "documents").limit(5), SF)
        old = files()
        counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
        kept = stored(counts, "counts")
        rows = sorted(map(tuple, kept.collect()))
        assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, counts.collect())) == rows
        end = time.time() + 20
        while files() - old and time.time() < end:
            time.sleep(0.2)
        assert not files() - old
    finally:
        spark.conf.set(key, before)
