"""Writers, change history algebra and its properties."""

from datetime import datetime

from pyspark.sql import functions as F

from keyloop.functions import rows as R
from keyloop.operators import history as H
from keyloop.operators import writes as W
from keyloop.plans import metrics as M
from keyloop.plans import queues as Q
from keyloop.plans import sync as S
from keyloop.sources import tables as V

NOW = datetime(2026, 7, 15, 9, 0)
ACTIONS = ("action_id long, machine_id long, ticket_id long, action_type string, "
           "description string, performed_by string, performed_at timestamp, status string, "
           "completed_at timestamp")
WORK_ORDERS = ("work_order_id long, machine_id long, priority string, title string, "
               "assigned_to string, status string")


def _write_script(spark):
    """The reference's simulated writes, on empty tables."""
    now = F.lit(NOW).cast("timestamp")
    new_actions = spark.createDataFrame([
        (1, 1, 7, "corrective", "replaced filter", "ana", NOW, "completed", None),
        (2, 2, 9, "inspection", "checked belt", "ben", NOW, "completed", None),
        (3, 3, 205, "preventive", "greased", "cy", NOW, "in_progress", None),
        (4, 4, 11, "corrective", "", "dee", NOW, "completed", None)], ACTIONS)
    acts, h1 = W.insert_rows(None, new_actions,
                             {"description": R.empty_to_null("description")}, version=1,
                             timestamp=NOW)
    acts, h2 = W.update_where(acts, F.col("machine_id") == 3,
                              {"status": F.lit("completed"), "completed_at": now}, version=2,
                              timestamp=NOW)
    new_wo = spark.createDataFrame([
        (1, 1, "high", "spindle", "ana", None), (2, 2, "high", "belt", "", None),
        (3, 5, "low", "paint", None, None)], WORK_ORDERS)
    wo, w1 = W.insert_rows(None, new_wo, {"status": R.default_status("assigned_to"),
                                          "assigned_to": R.empty_to_null("assigned_to")},
                           version=1, timestamp=NOW)
    wo, w2 = W.update_where(wo, (F.col("machine_id") == 2) & (F.col("priority") == "high"),
                            {"status": F.lit("closed")}, version=2, timestamp=NOW)
    wo, w3 = W.delete_where(wo, (F.col("priority") == "low") & (F.col("status") == "open"),
                            version=3, timestamp=NOW)
    return acts, h1.unionByName(h2), wo, w1.unionByName(w2).unionByName(w3)


def test_write_script_counts(spark):
    acts, ah, wo, wh = _write_script(spark)
    assert ah.count() == 6 and H.not_preimage(ah).count() == 5 and acts.count() == 4
    assert wh.count() == 6 and H.not_preimage(wh).count() == 5 and wo.count() == 2
    assert {r.status for r in wo.collect()} == {"assigned", "closed"}
    # the current table equals the net state of its history
    cur = H.current_state(wh, ["work_order_id"]).select(*wo.columns)
    assert sorted(cur.collect()) == sorted(wo.collect())
    cur_a = H.current_state(ah, ["action_id"]).select(*acts.columns)
    assert sorted(cur_a.collect()) == sorted(acts.collect())


def test_time_to_fix_traps(spark):
    """Faithful Q7 counts preimages; missing tickets and completed_at give null hours."""
    _, ah, _, _ = _write_script(spark)
    machines = spark.createDataFrame([(i, f"M{i}", "L") for i in range(1, 6)],
                                     "machine_id long, model string, line string")
    tickets = spark.createDataFrame([(7, datetime(2026, 7, 14, 9)), (9, datetime(2026, 7, 15, 8)),
                                     (11, datetime(2026, 7, 16))],
                                    "ticket_id long, opened_at timestamp")
    ttf = M.time_to_fix(ah, machines, tickets, keys=("action_id",), ordered=False)
    rows = ttf.collect()
    # 3 completed inserts + the update postimage (preimage says in_progress)
    assert len(rows) == 4
    # completed_at was never set on the three inserts, and ticket 205 of the updated action
    # does not exist: every value of the reference's own script is null
    assert all(r.hours_to_fix is None for r in rows)
    fixed = spark.createDataFrame([(7, datetime(2026, 7, 15, 10, 30))],
                                  "ticket_id long, c timestamp")
    hist = ah.join(fixed, "ticket_id", "left").withColumn(
        "completed_at", F.coalesce("completed_at", "c")).drop("c")
    got = {r.action_id: r.hours_to_fix
           for r in M.time_to_fix(hist, machines, tickets, ("action_id",), False).collect()}
    assert got[1] == 25.5


def test_diff_apply_roundtrip_with_nulls(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", 1.0), (3, None, 2.0), (4, "d", 4.0)],
                                "k long, s string, x double")
    new = spark.createDataFrame([(1, "a", None), (2, "b", 9.0), (3, None, 2.0), (5, "e", 5.0)],
                                "k long, s string, x double")
    d = H.diff_snapshots(old, new, "k", version=1, timestamp=NOW)
    types = sorted((r.k, r._change_type) for r in d.collect())
    assert types == [(2, "update_postimage"), (2, "update_preimage"), (4, "delete"),
                     (5, "insert")]
    back = H.apply_changes(old, d, "k", since_version=0)
    assert sorted(back.collect()) == sorted(new.collect())
    # applying the same changes twice changes nothing
    again = H.apply_changes(back.select(*old.columns), d, "k", since_version=0)
    assert sorted(again.collect()) == sorted(new.collect())


def test_history_properties(spark, sf_small):
    log = V.change_log(spark, sf_small)
    cur = H.current_state(log, ["entity_id"])
    assert cur.count() == 12   # FIXTURES: 12 of 15 keys at sf0.001
    latest_v = log.agg(F.max("_commit_version")).first()[0]
    assert sorted(H.as_of(log, ["entity_id"], version=latest_v).collect()) == sorted(cur.collect())
    iv = H.validity_intervals(log, ["entity_id"], bucket_width=64)   # many buckets per key
    # exactly one current interval per live key, none for deleted keys
    cur_iv = iv.filter("is_current").groupBy("entity_id").count()
    assert cur_iv.filter("count <> 1").count() == 0
    assert cur_iv.count() == cur.count()
    # intervals of a key do not overlap: each valid_to is the next valid_from or a delete
    w = iv.filter("valid_to IS NOT NULL AND valid_to < valid_from").count()
    assert w == 0
    # bucketed lead equals a plain lead
    ref = H.validity_intervals(log, ["entity_id"], bucket_width=1 << 40)
    assert sorted(iv.collect()) == sorted(ref.collect())
    a1 = H.audit_trail(log, ["entity_id"], ["value"], bucket_width=50)
    a2 = H.audit_trail(log, ["entity_id"], ["value"], bucket_width=1 << 40)
    assert sorted(a1.collect()) == sorted(a2.collect())


def test_triggered_sync_equals_current_state(spark, sf_small):
    log = V.change_log(spark, sf_small)
    replica = H.as_of(log, ["entity_id"], version=400)
    synced = S.triggered_sync(replica, log, ["entity_id"], 400)
    assert sorted(synced.collect()) == sorted(H.current_state(log, ["entity_id"]).collect())


def test_snapshot_sync_rejects_bad_key(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k long, v string")
    import pytest
    with pytest.raises(S.PrimaryKeyError):
        S.snapshot_sync(df, ["k"], str(tmp_path / "x"))
    with pytest.raises(S.PrimaryKeyError):
        S.snapshot_sync(df, [], str(tmp_path / "y"))
    ok = S.snapshot_sync(df.filter("v = 'a'"), ["k"], str(tmp_path / "z"))
    assert ok.count() == 1


def test_table_counts_reports_missing(spark, sf_small):
    got = {r.table_name: (r.n_rows, r.status) for r in S.table_counts(
        spark, {"region": f"{sf_small}/region.parquet", "nope": "/tmp/keyloop-missing-x"})
        .collect()}
    assert got["region"] == (5, "ok") and got["nope"] == (None, "missing")


def test_queue_properties(spark, sf_small):
    t, m = V.tickets(spark, sf_small), V.machines(spark, sf_small)
    a = V.actions(spark, sf_small)
    q1 = Q.open_alerts(t, m, a, ordered=False)
    q9 = Q.open_alert_tickets_no_completion(t, m, a)
    assert q9.join(q1, "ticket_id", "left_anti").count() == 0        # Q9 is a subset of Q1
    assert q9.count() == 75                                           # FIXTURES at sf0.001
    counts = {r.priority: r.n for r in Q.queue_counters(q1).collect()}
    crit = q1.filter("priority = 'critical'").count()
    assert counts["high"] + counts["medium"] + counts["low"] + crit == counts["total"]


def test_write_read_back(spark):
    """Q12: write one action, read it back by performer, newest first."""
    acts = spark.createDataFrame([(41, 1, 7, "corrective", "old", "tester", NOW, "completed",
                                   NOW)], ACTIONS)
    # the form does not send performed_at or an id: the defaults and the key fill them
    new = spark.createDataFrame([(1, 7, "inspection", "smoke test", "tester@x.io", "completed",
                                  None)], "machine_id long, ticket_id long, action_type string, "
                                "description string, performed_by string, status string, "
                                "completed_at timestamp")
    now = F.lit(datetime(2026, 7, 15, 10)).cast("timestamp")
    acts, changes = W.insert_rows(acts, new, {
        "performed_by": R.short_name("performed_by"),
        "completed_at": R.completed_at_rule("status", now)}, version=1, timestamp=NOW,
        defaults={"performed_at": now}, key="action_id", required=["description"])
    back = (acts.filter(F.col("performed_by") == "tester")
                .orderBy(F.desc_nulls_first("performed_at")).first())
    assert back.status == "completed" and back.description == "smoke test"
    assert back.completed_at == datetime(2026, 7, 15, 10) and back.action_id == 42
    assert changes.count() == 1


def test_default_keeps_explicit_null(spark):
    new = spark.createDataFrame([(1, None)], "k long, performed_at timestamp")
    now = F.lit(NOW).cast("timestamp")
    rows, _ = W.insert_rows(None, new, {}, version=1, defaults={"performed_at": now})
    assert rows.first().performed_at is None          # present but null: stays null
    rows2, _ = W.insert_rows(None, new.drop("performed_at"), {}, version=1,
                             defaults={"performed_at": now})
    assert rows2.first().performed_at == NOW          # absent: the default fills it


def test_audit_prefers_same_version_preimage(spark):
    rows = [(1, "a", "insert", 1), (1, "a", "update_preimage", 2), (1, "b", "update_postimage", 2),
            (1, "b", "update_preimage", 3), (1, "c", "update_postimage", 3), (1, "c", "delete", 4)]
    log = spark.createDataFrame([(*r, None) for r in rows], LOG)
    full = {r._commit_version: (r.old_v, r.new_v)
            for r in H.audit_trail(log, ["k"], ["v"]).collect()}
    assert full == {1: (None, "a"), 2: ("a", "b"), 3: ("b", "c"), 4: ("c", None)}
    # on a truncated range the preimage still gives the before image
    part = {r._commit_version: (r.old_v, r.new_v)
            for r in H.audit_trail(H.read_changes(log, 3), ["k"], ["v"]).collect()}
    assert part[3] == ("b", "c")


LOG = "k long, v string, _change_type string, _commit_version long, _commit_timestamp timestamp"


def test_assign_keys_unique_dense(spark):
    df = spark.range(0, 1000, numPartitions=7).withColumnRenamed("id", "x")
    out = W.assign_keys(df, "new_id", start_after=500)
    agg = out.agg(F.countDistinct("new_id").alias("d"), F.min("new_id").alias("lo"),
                  F.max("new_id").alias("hi")).first()
    assert (agg.d, agg.lo, agg.hi) == (1000, 501, 1500)


def test_validate_rows(spark):
    df = spark.createDataFrame([("x", "general"), ("", "observation"), (None, "alert")],
                               "content string, note_type string")
    ok, bad = W.validate_rows(df, ["content"], {"note_type": ["general", "alert"]})
    assert ok.count() == 1
    reasons = sorted(r.reasons for r in bad.collect())
    assert reasons == ["content is required", "content is required; note_type not in domain"]


def test_union_histories_with_json_payload(spark):
    a = spark.createDataFrame([(1, "x", "insert", 1, None)], LOG)
    b = spark.createDataFrame([(7, 2.5, "delete", 3, None)],
                              "order_id long, total double, _change_type string, "
                              "_commit_version long, _commit_timestamp timestamp")
    u = H.union_histories({"a": a, "b": b}, with_json=True)
    rows = {r.table_name: r for r in u.collect()}
    assert set(u.columns) >= {"k", "v", "order_id", "total", "table_name", "row_json"}
    assert rows["a"].row_json == '{"k":1,"v":"x"}' and rows["a"].order_id is None
    assert rows["b"].row_json == '{"order_id":7,"total":2.5}'
    counts = {(r.table_name, r._change_type): r.n_changes
              for r in H.change_counts(u, ["table_name", "_change_type"]).collect()}
    assert counts == {("a", "insert"): 1, ("b", "delete"): 1}


def test_hours_rounding_half_up_and_seconds(spark):
    df = spark.createDataFrame([(0, 180), (0, 5580), (0, -180), (0, 19620), (0, 179)],
                               "a long, b long").select(
        F.timestamp_seconds("a").alias("s"), F.timestamp_seconds("b").alias("e"))
    got = [r.h for r in df.select(M.hours_between("s", "e").alias("h")).collect()]
    assert got == [0.1, 1.6, -0.1, 5.5, 0.0]


def test_hours_double_path_equals_decimal_half_up(spark):
    from decimal import ROUND_HALF_UP, Decimal
    df = spark.range(-200_000, 200_000, 37).select(
        F.col("id").alias("n"), F.timestamp_seconds(F.lit(0)).alias("s"),
        F.timestamp_seconds("id").alias("e"))
    rows = df.select("n", M.hours_between("s", "e").alias("h")).collect()
    for r in rows:
        want = (Decimal(r.n) / Decimal("3600.0")).quantize(Decimal("0.1"), ROUND_HALF_UP)
        assert Decimal(str(r.h)) == want, (r.n, r.h, want)
