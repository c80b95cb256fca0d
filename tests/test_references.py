"""References to other tables, checked by a filter of the orphans and an exact join."""

import pytest
from pyspark.sql import functions as F

from keyloop.operators import writes as W


@pytest.mark.parametrize("bits", [1 << 25, 1 << 16, 1])
def test_orphans_against_brute_force(spark, bits):
    """A third of the rows holds one orphan; a filter of one bit suspects every row."""
    rows = spark.range(5_000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(-7)).when(F.col("id") % 11 == 0, F.lit(None))
        .otherwise(F.col("id") % 400).cast("int").alias("a"), (F.col("id") % 2).cast("string").alias("b"))
    table = spark.range(0, 400, 2).select(F.col("id").alias("a"), F.lit("0").alias("b")).union(
        spark.createDataFrame([(None, "1"), (5, None), (7, "1"), (7, "1")], "a long, b string"))
    there = {(r.a, r.b) for r in table.collect()}
    got = W.mark_orphans(rows, table, ["a", "b"], "orphan", bits=bits)
    assert got.columns == ["id", "a", "b", "orphan"]
    got = {r.id: r.orphan for r in got.collect()}
    assert len(got) == 5_000
    for r in rows.collect():
        assert got[r.id] == (r.a is not None and (r.a, r.b) not in there)


def test_repeated_rows_and_empty_tables(spark):
    rows = spark.createDataFrame([(1, "x"), (1, "x"), (None, "x"), (2, "")], "k int, v string")
    none = spark.createDataFrame([], "k int")
    ok, bad = W.validate_rows(rows, ["v"], references={"parents": (none, ["k"])})
    assert sorted(r.reasons for r in bad.collect()) == ["k not in parents", "k not in parents",
                                                        "v is required; k not in parents"]
    assert [tuple(r) for r in ok.collect()] == [(None, "x")] and ok.columns == ["k", "v"]
    ok, bad = W.validate_rows(rows.limit(0), ["v"], references={"parents": (none, ["k"])})
    assert ok.count() == bad.count() == 0


def test_only_suspects_are_shuffled(spark):
    """Whole rows go through one exchange, below the filter's test."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(1_000).select("id", (F.col("id") % 50).alias("k"),
                                         F.concat(F.lit("long"), F.col("id")).alias("payload"))
        marked = W.mark_orphans(rows, spark.range(40).toDF("k"), ["k"], "orphan")
        assert marked.filter(~F.col("orphan")).count() == 800
        plan = marked._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        wide = [part for part in plan.split("\n\n")
                if part.lstrip().startswith("(") and ") Exchange" in part.split("\n")[0] and "payload#" in part]
        assert len(wide) == 1, plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
