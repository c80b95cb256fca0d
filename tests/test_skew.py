"""A key holding a third of all rows: results stay exact and the work is spread."""

from pyspark.sql import functions as F

from keyloop.operators import history as H
from keyloop.operators import keyed as K


def _hot_log(spark, n=30_000):
    # key 0 owns every third version; the other rows spread over 1000 keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1).alias("k"),
        (F.col("id") % 7).cast("string").alias("v"),
        F.when(F.col("id") % 11 == 0, "delete").otherwise("update_postimage").alias("_change_type"),
        F.col("id").alias("_commit_version"),
        F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("_commit_timestamp"))


def test_hot_key_results_exact(spark):
    log = _hot_log(spark)
    iv = H.validity_intervals(log, ["k"], bucket_width=256)
    ref = H.validity_intervals(log, ["k"], bucket_width=1 << 40)
    assert iv.exceptAll(ref).count() == 0 and ref.exceptAll(iv).count() == 0
    latest = K.latest_per_key(log, "k", "_commit_version")
    assert latest.filter("k = 0").first()._commit_version == 29_997


def test_hot_key_spread_over_tasks(spark):
    # AQE off: otherwise its skew-join split of the following join hides the window's layout
    conf = "spark.sql.adaptive.enabled"
    old = spark.conf.get(conf)
    spark.conf.set(conf, "false")
    try:
        log = _hot_log(spark)
        out = H.next_in_key(log, ["k"], ["_commit_version"], ["_commit_timestamp"], "n_",
                            bucket_width=256)
        # the partition id is taken after the window (its output column is consumed, so the
        # window cannot be pruned away)
        sizes = [r["n"] for r in out.withColumn("p", F.spark_partition_id()).groupBy("p")
                 .agg(F.count(F.lit(1)).alias("n"),
                      F.sum(F.unix_timestamp("n__commit_timestamp")).alias("s")).collect()]
        # without buckets the hot key alone puts >= 1/3 of the rows into one task
        assert max(sizes) < 0.30 * sum(sizes)
        plain = H.next_in_key(log, ["k"], ["_commit_version"], ["_commit_timestamp"], "n_",
                              bucket_width=1 << 40)
        psizes = [r["n"] for r in plain.withColumn("p", F.spark_partition_id()).groupBy("p")
                  .agg(F.count(F.lit(1)).alias("n"),
                       F.sum(F.unix_timestamp("n__commit_timestamp")).alias("s"))
                  .collect()]
        assert max(psizes) >= sum(psizes) / 3
    finally:
        spark.conf.set(conf, old)


def test_hot_ticket_is_split(spark):
    """A ticket with a third of all actions: the join of time-to-fix is split by adaptive
    execution, and the net state is cut down before its shuffle."""
    from keyloop.plans import metrics as M
    n = 60_000
    actions = spark.range(n, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5000 + 1).alias("ticket_id"),
        F.col("id").alias("line_no"), F.lit("t").alias("performed_by"), F.lit("r").alias("action_type"),
        F.sha2(F.col("id").cast("string"), 256).alias("description"), F.lit("completed").alias("status"),
        F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("completed_at"),
        F.lit("insert").alias("_change_type"), F.col("id").alias("_commit_version"),
        F.lit(None).cast("timestamp_ntz").alias("_commit_timestamp"))
    tickets = spark.range(5001).select(F.col("id").alias("ticket_id"), (F.col("id") % 50).alias("machine_id"),
                                       F.lit("2020-01-01").cast("timestamp_ntz").alias("opened_at"))
    machines = spark.range(50).select(F.col("id").alias("machine_id"), F.lit("m").alias("model"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "20",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        fixes = M.time_to_fix(actions, machines, tickets, ordered=False, machine_from_ticket=True)
        assert fixes.count() == n
        rows = fixes.collect()
        assert len(rows) == n
        plan = fixes._jdf.queryExecution().executedPlan().toString()
        assert "skew" in plan.lower()
        net = M.time_to_fix_net(actions, machines, tickets, ["ticket_id"], ["_commit_version"],
                                ordered=False, machine_from_ticket=True)
        assert net.count() == 5001
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_history_rows_are_shuffled_once(spark):
    """The payload goes through one exchange and no join; only edge rows take further ones."""
    log = _hot_log(spark).withColumn("payload", F.concat("v", F.lit("-payload")))
    frames = {
        "intervals": H.validity_intervals(log, ["k"], bucket_width=256),
        "next": H.next_in_key(log, ["k"], ["_commit_version"], ["_commit_timestamp"], "n_", bucket_width=256),
    }
    for name, df in frames.items():
        plan = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        assert "Join" not in plan, name
        wide = [part for part in plan.split("\n\n")
                if part.lstrip().startswith("(") and ") Exchange" in part.split("\n")[0] and "payload#" in part]
        assert len(wide) == 1, (name, plan)


def test_audit_trail_does_not_depend_on_buckets(spark):
    """Preimages, deletes, null versions and buckets of preimages alone, at any width."""
    log = _hot_log(spark, 6_000).withColumn(
        "_change_type", F.when(F.col("_commit_version") % 5 == 0, "update_preimage")
        .when(F.col("_commit_version") % 13 == 0, F.lit(None)).otherwise(F.col("_change_type")))
    trails = [H.audit_trail(log, ["k"], ["v"], bucket_width=w) for w in (1, 64, 1 << 40)]
    for t in trails[:-1]:
        assert t.exceptAll(trails[-1]).count() == 0 and trails[-1].exceptAll(t).count() == 0
    assert "Join" not in trails[0]._jdf.queryExecution().toString()
