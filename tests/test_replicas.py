"""Replicas: checksums, buckets, snapshots."""

import os
import random
import tempfile

from pyspark.sql import functions as F

from keyloop.operators import history as H
from keyloop.plans import replicas as R
from keyloop.plans import sync

LOG = "k long, v string, _change_type string, _commit_version long, _commit_timestamp timestamp_ntz"


def folder(name):
    return tempfile.mkdtemp(prefix=f"keyloop-{name}-")


def some_log(spark, n=300, keys=40, seed=1):
    rng = random.Random(seed)
    return spark.createDataFrame([(rng.choice([None, *range(keys)]), str(v), rng.choice(
        ["insert", "update_postimage", "update_preimage", "delete"]), v, None) for v in range(n)], LOG)


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


def test_sums_find_what_a_full_join_finds(spark):
    rng = random.Random(3)
    base = [(i, f"x{i}", rng.random()) for i in range(2000)]
    other = [(i, "changed" if i in (5, 77) else x, y) for i, x, y in base if i not in (9, 1500)] + [(5000, "extra", 1.0), (None, "n", 2.0)]
    a = spark.createDataFrame(base, "k long, x string, y double")
    b = spark.createDataFrame(other, "k long, x string, y double")
    empty = a.limit(0)
    pairs = {"ab": (a, b, ["k"]), "aa": (a, a.orderBy(F.desc("x")), ["k"]), "none": (empty, empty, ["k"]), "gone": (a, empty, ["k"])}
    got = {r.table_name: tuple(r)[1:] for r in R.reconcile_by_sums(pairs).collect()}
    for name, (s, r, pk) in pairs.items():
        # (a full join of two empty tables sums up to nulls)
        assert got[name] == tuple(x or 0 for x in sync.reconcile(s, r, pk).first()), name
    assert got["ab"] == (2000, 2000, 2, 2, 2) and got["aa"] == (2000, 2000, 0, 0, 0)


def test_equal_replicas_are_not_joined_and_few_rows_are(spark):
    a = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("x"))
    same = R.reconcile_by_sums({"a": (a, a, ["k"])})
    assert "Join" not in same._jdf.queryExecution().executedPlan().toString()
    found = R.differing_nodes({"a": (a, a.withColumn("x", F.when(F.col("k") == 17, -1).otherwise(F.col("x"))), ["k"])}, 2)
    assert found.filter("differs").count() == 1
    # one aggregate for both sides of all tables
    plan = R.differing_nodes({"a": (a, a, ["k"]), "b": (a, a, ["k"])}, 1)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_refresh_leaves_other_buckets_alone(spark):
    log = some_log(spark)
    old = H.as_of(log, ["k"], version=150)
    replica = R.BucketReplica(spark, folder("buckets"), ["k"], buckets=8)
    assert replica.read(old.schema).count() == 0
    replica.write(old)
    assert rows(replica.read(old.schema), "k", "v") == rows(old, "k", "v")
    few = log.filter("_commit_version <= 150 or k in (3, 4)")
    hit = replica.refresh(few, 150, old.schema)
    assert 0 < len(hit) <= 2
    assert {d for d in os.listdir(f"{replica.root}/data/number=1") if "=" in d} <= {f"__bucket={b}" for b in hit}
    want = H.current_state(few, ["k"])
    assert rows(replica.read(old.schema), "k", "v") == rows(want, "k", "v")
    assert replica.refresh(few, 1000, old.schema) == []
    # all rows of a bucket deleted: the bucket is empty, not as it was
    gone = log.filter("k is not null").select("k").distinct().select(
        "k", F.lit(None).cast("string").alias("v"), F.lit("delete").alias("_change_type"),
        F.lit(999).cast("long").alias("_commit_version"), F.lit(None).cast("timestamp_ntz").alias("_commit_timestamp"))
    replica.refresh(gone, 300, old.schema)
    assert replica.read(old.schema).count() == 0


def test_as_of_reads_the_nearest_snapshot_and_the_log_after_it(spark):
    log = some_log(spark, 400)
    kept = R.SnapshotLog(spark, folder("snapshots"), ["k"], width=50)
    kept.append(log.filter("_commit_version < 200"))
    kept.append(log.filter("_commit_version >= 200 and _commit_version < 320"))
    want = lambda v, frame=log: rows(H.as_of(frame, ["k"], version=v), "k", "v")
    assert rows(kept.as_of(120), "k", "v") == want(120)
    kept.record(120)
    kept.record(249)
    for v in (119, 120, 121, 200, 249, 250, 310):
        assert rows(kept.as_of(v), "k", "v") == want(v), v
    plan = kept.as_of(310)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(__part" in plan and "(__part" in plan and ">= 5)" in plan
    # a late change strikes out the snapshots that it makes wrong
    late = spark.createDataFrame([(1, "late", "update_postimage", 130, None)], LOG)
    kept.append(late)
    assert sorted(kept.snapshots()) == [120]
    assert rows(kept.as_of(140), "k", "v") == want(140, log.union(late))
    kept.record(249)
    assert sorted(kept.snapshots()) == [120, 249]
    # with the earlier ranges gone, a read above the snapshot still works
    for part in range(0, 4):
        os.rename(f"{kept.root}/log/__part={part}", f"{kept.root}/away-{part}")
    assert rows(kept.as_of(310), "k", "v") == want(310, log.union(late))


def test_replica_pointer_does_not_follow_the_clock(spark):
    target = folder("pointer")
    for i in range(3):
        sync.snapshot_sync(spark.createDataFrame([(1, i)], "k long, x long"), ["k"], target)
    assert sync.read_replica(spark, target).first().x == 2
    assert "at" not in spark.read.parquet(f"{target}/_current").columns
