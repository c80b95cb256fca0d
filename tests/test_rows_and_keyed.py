"""Row rules, null and tie rules, keyed operators on tiny frames."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from keyloop.functions import rows as R
from keyloop.operators import keyed as K
from keyloop.plans import queues as Q


def test_severity_presets(spark):
    df = spark.createDataFrame([("critical",), ("high",), ("medium",), ("low",), (None,)],
                               "p string")
    got = {r.p: (r.q, r.w) for r in df.select(
        "p", R.severity_rank("p").alias("q"),
        R.severity_rank("p", R.WORK_ORDER_SEVERITY, R.WORK_ORDER_SEVERITY_DEFAULT).alias("w"))
        .collect()}
    # the queue ranks critical with low; work orders put it first
    assert got == {"critical": (2, 0), "high": (0, 1), "medium": (1, 2), "low": (2, 3),
                   None: (2, 3)}


def test_status_null_semantics(spark):
    df = spark.createDataFrame([("closed",), ("open",), (None,)], "s string")
    assert df.filter(R.status_not("s", "closed")).count() == 1          # null dropped
    assert df.filter(R.not_in_state("s", "closed")).count() == 2        # null kept
    assert df.filter(R.status_is("s", "open")).count() == 1


def test_empty_to_null_and_default_status(spark):
    df = spark.createDataFrame([("",), ("  ",), ("bob",), (None,)], "a string")
    rows = df.select(R.empty_to_null("a").alias("x"), R.default_status("a").alias("s")).collect()
    assert [r.x for r in rows] == [None, "  ", "bob", None]
    assert [r.s for r in rows] == ["open", "assigned", "assigned", "open"]


def test_completed_at_rule_and_default_now(spark):
    now = F.lit(datetime(2026, 7, 15)).cast("timestamp")
    df = spark.createDataFrame([("completed", None), ("in_progress", None), (None, None)],
                               "s string, t timestamp")
    rows = df.select(R.completed_at_rule("s", now).alias("c"),
                     R.default_now("t", now).alias("d")).collect()
    assert rows[0].c is not None and rows[1].c is None and rows[2].c is None
    assert all(r.d is not None for r in rows)


def test_label_slug_short_name(spark):
    df = spark.createDataFrame([(7, "Press", "Line-A", "Jane.Doe+x@ex.com"),
                                (8, None, None, "@only"), (9, "Lathe", "L", "plain")],
                               "id long, model string, line string, e string")
    rows = df.select(R.machine_label("id", "model", "line").alias("l"),
                     R.user_slug("e").alias("slug"), R.short_name("e").alias("me")).collect()
    assert rows[0].l == "#7 · Press (Line-A)" and rows[1].l == "#8"
    assert rows[0].slug == "janedoex" and rows[0].me == "Jane.Doe+x"
    assert rows[1].me == "@only" and rows[2].me == "plain"


def test_priority_filter_critical_is_no_filter(spark):
    df = spark.createDataFrame([("critical",), ("high",)], "priority string")
    assert Q.priority_filter(df, "critical").count() == 2
    assert Q.priority_filter(df, "high").count() == 1
    with pytest.raises(ValueError):
        Q.priority_filter(df, "critical", strict=True)


def test_latest_per_key_null_wins_and_tie(spark):
    df = spark.createDataFrame([
        (1, datetime(2026, 1, 1), 1, "a"), (1, None, 0, "null-wins"),
        (2, datetime(2026, 1, 2), 1, "tie-low"), (2, datetime(2026, 1, 2), 2, "tie-high"),
        (None, datetime(2026, 1, 3), 1, "null-key")], "k long, t timestamp, n int, v string")
    got = {r.k: r.v for r in K.latest_per_key(df, "k", "t", "n").collect()}
    assert got == {1: "null-wins", 2: "tie-high"}     # null key dropped
    got2 = {r.k: r.v for r in K.latest_per_key(df, "k", "t", "n", nulls_first=False).collect()}
    assert got2[1] == "a"


def test_latest_per_key_plan_limits_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = K.latest_per_key(df, "k", "v")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_compare_keys_and_anti(spark):
    a = spark.createDataFrame([(1,), (2,), (2,)], "k long")
    b = spark.createDataFrame([(2,), (3,)], "k long")
    got = {r.k: r.side for r in K.compare_keys(a, b, "k").collect()}
    assert got == {1: "left_only", 2: "both", 3: "right_only"}
    assert [r.k for r in K.without_match(a, b, "k").collect()] == [1]


def test_overwrite_first_k(spark):
    t = spark.createDataFrame([(i, 100 + i, "low") for i in range(1, 8)],
                              "ticket_id long, machine_id long, priority string")
    repl = spark.createDataFrame([(1, 55), (2, 66)], "pos int, machine_id long")
    out = K.overwrite_first_k(t, "ticket_id", "ticket_id", repl,
                              {"machine_id": F.col("machine_id"), "priority": F.lit("high")}, 2)
    got = {r.ticket_id: (r.machine_id, r.priority) for r in out.collect()}
    assert len(got) == 7 and got[1] == (55, "high") and got[2] == (66, "high")
    assert got[3] == (103, "low")


def test_broadcast_only_when_small(spark):
    small = spark.range(10)
    assert K.estimated_bytes(small) is not None
    hinted = K.join_dim(spark.range(100), small, "id")._jdf.queryExecution() \
        .optimizedPlan().toString()
    assert "broadcast" in hinted.lower()
    plain = K.join_dim(spark.range(100), small, "id", max_broadcast_bytes=1)._jdf \
        .queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plain.lower()


def test_queue_counters_all_values_present(spark):
    q = spark.createDataFrame([("high",), ("critical",)], "priority string")
    got = {r.priority: r.n for r in Q.queue_counters(q).collect()}
    assert got == {"high": 1, "medium": 0, "low": 0, "total": 2}


def test_history_names_and_like_escape(spark):
    from keyloop.functions import naming as N
    df = spark.createDataFrame([("lb_work_orders_history",), ("lbXwork_orders_history",),
                                ("machines",)], "t string")
    strict = [r.t for r in df.filter(N.is_history_name("t")).collect()]
    loose = [r.t for r in df.filter(N.is_history_name("t", literal_underscores=False)).collect()]
    assert strict == ["lb_work_orders_history"]
    assert sorted(loose) == ["lbXwork_orders_history", "lb_work_orders_history"]
    assert N.history_table_name("quality_checks") == "lb_quality_checks_history"
    slug = spark.range(1).select(N.current_user_slug().alias("s")).first().s
    assert slug and slug == slug.lower()


def test_seed_tables_shapes(spark):
    from keyloop.sources.seed import seed_tables
    t = seed_tables(spark, scale=1.0, seed=42)
    counts = {k: v.count() for k, v in t.items()}
    assert counts == {"machines": 50, "sensor_readings": 10000, "production_orders": 200,
                      "maintenance_tickets": 120}
    r = t["sensor_readings"].agg(F.min("temperature_c"), F.max("temperature_c"),
                                 F.min("ts"), F.max("ts")).first()
    assert 50 <= r[0] and r[1] <= 90
    assert str(r[2]) == "2026-06-15 00:00:00" and str(r[3]).startswith("2026-07-19")
    assert {x.priority for x in t["maintenance_tickets"].select("priority").distinct()
            .collect()} <= {"low", "medium", "high", "critical"}
    assert t["production_orders"].agg(F.min("order_id")).first()[0] == 1001


def test_alert_order_fallback(spark):
    a = [str(c) for c in Q.alert_order("nonsense")]
    b = [str(c) for c in Q.alert_order("priority")]
    assert a == b and len(Q.alert_order("machine")) == 2


def test_top_k_through_joins_exact_with_fallback(spark):
    fact = spark.range(100).select(F.col("id").alias("k"), F.col("id").alias("ts"))

    def joins_factory(dim):
        return lambda df: df.join(dim, "k")

    def brute(dim, k):
        return [r.k for r in K.top_k(fact.join(dim, "k"), k, "ts", ["k"]).collect()]

    # fast path: every third key has a dimension row, plenty survive among the candidates
    dim = spark.range(0, 100, 3).select(F.col("id").alias("k"), F.lit("d").alias("v"))
    got = [r.k for r in K.top_k_through_joins(fact, 5, "ts", ["k"], joins_factory(dim),
                                              oversample=4).collect()]
    assert got == brute(dim, 5)
    # fallback: the newest 60 rows are all orphans, the candidates cannot fill k
    dim2 = spark.range(0, 40).select(F.col("id").alias("k"), F.lit("d").alias("v"))
    got2 = [r.k for r in K.top_k_through_joins(fact, 5, "ts", ["k"], joins_factory(dim2),
                                               oversample=4).collect()]
    assert got2 == brute(dim2, 5) == [39, 38, 37, 36, 35]
