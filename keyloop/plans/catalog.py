"""Registry of the named queries (``queries()``) and their DuckDB oracles (``oracle_sql()``).

Every query reads the driver tables of ``sf_dir`` in full through the role views of
``keyloop.sources.tables``; none of them samples, caps or subsets rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyloop.functions import domains as D
from keyloop.functions import rows as R
from keyloop.operators import history as H
from keyloop.operators import writes as Wr
from keyloop.operators.keyed import compare_keys, estimated_bytes, join_dim
from keyloop.plans import metrics, queues, replicas, sync
from keyloop.plans import oracle as O
from keyloop.session import scratch_path
from keyloop.sources import tables as V
from keyloop.streaming import capture as SC
from keyloop.streaming import deltas as SD
from keyloop.streaming import history as SH
from keyloop.streaming import live as SL
from keyloop.streaming.state import KeyedState, continuous_sync, suggest_partitions

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query under ``name`` with its DuckDB oracle SQL (None: rows-only check)."""
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- Q1 open alerts
_Q1_BODY = """
SELECT t.ticket_id, t.machine_id, m.model, m.line, t.priority, t.description,
       newest.performed_by AS actioned_by, newest.status AS action_status
FROM m, t LEFT JOIN newest ON newest.ticket_id = t.ticket_id
WHERE m.machine_id = t.machine_id AND t.status = 'open'
  AND NOT EXISTS (SELECT 1 FROM newest d WHERE d.ticket_id = t.ticket_id AND d.status = 'completed')
"""
_Q1_CTES = (O.M, O.T, O.A, O.NEWEST)
_Q1_SQL = O.with_(*_Q1_CTES) + _Q1_BODY


def _queue_inputs(spark, sf):
    return V.tickets(spark, sf, status="open"), V.machines(spark, sf), V.actions(spark, sf)


@register("open_alerts", _Q1_SQL)
def q_open_alerts(spark, sf):
    return queues.open_alerts(*_queue_inputs(spark, sf))


@register("open_alerts_high", _Q1_SQL + "  AND t.priority = 'high'\n")
def q_open_alerts_high(spark, sf):
    return queues.open_alerts(*_queue_inputs(spark, sf), sort="oldest", priority="high")


@register("open_alerts_critical_unfiltered", _Q1_SQL)
def q_open_alerts_critical(spark, sf):
    # P6: 'critical' is not an accepted filter value, so the whole queue comes back
    return queues.open_alerts(*_queue_inputs(spark, sf), sort="machine", priority="critical")


@register("queue_counters", O.with_(*_Q1_CTES, "q AS (" + _Q1_BODY + ")") + """
SELECT v.priority, CAST(COALESCE(c.n, 0) AS BIGINT) AS n
FROM (VALUES ('high'), ('medium'), ('low')) v(priority)
LEFT JOIN (SELECT priority, count(*) AS n FROM q GROUP BY priority) c USING (priority)
UNION ALL
SELECT 'total' AS priority, count(*) AS n FROM q
""")
def q_queue_counters(spark, sf):
    queue = queues.open_alerts(V.tickets(spark, sf, status="open"), V.machines(spark, sf),
                               V.actions(spark, sf), ordered=False)
    return queues.queue_counters(queue)


@register("latest_action_per_ticket", O.with_(O.A) + """
SELECT ticket_id, line_no, amount, performed_by, performed_at, status FROM (
  SELECT a.*, row_number() OVER (PARTITION BY ticket_id
           ORDER BY performed_at DESC NULLS FIRST, line_no DESC, amount DESC) AS rn
  FROM a WHERE ticket_id IS NOT NULL) WHERE rn = 1
""")
def q_latest_action(spark, sf):
    a = V.actions(spark, sf).select("ticket_id", "line_no", "amount", "performed_by",
                                    "performed_at", "status")
    return queues.latest_actions(a)


_NO_COMPLETION = """
FROM t JOIN m ON m.machine_id = t.machine_id
WHERE t.status = 'open'
  AND NOT EXISTS (SELECT 1 FROM a WHERE a.ticket_id = t.ticket_id AND a.status = 'completed')
"""


@register("open_tickets_without_completion",
          O.with_(O.M, O.T, O.A) + "SELECT t.ticket_id, t.machine_id, t.priority" + _NO_COMPLETION)
def q_open_no_completion(spark, sf):
    return queues.open_alert_tickets_no_completion(
        V.tickets(spark, sf, status="open"), V.machines(spark, sf),
        V.actions(spark, sf, status_value="completed"))


@register("open_alert_count",
          O.with_(O.M, O.T, O.A) + "SELECT count(*) AS open_alerts" + _NO_COMPLETION)
def q_open_alert_count(spark, sf):
    return queues.open_alert_count(
        V.tickets(spark, sf, status="open"), V.machines(spark, sf),
        V.actions(spark, sf, status_value="completed"))


# ---------------------------------------------------------------- Q2-Q5 feeds
@register("recent_actions", O.with_(O.M, O.A, O.AM) + """
SELECT ticket_id, line_no, amount, machine_id, model, action_type, description, performed_by,
       status, performed_at, completed_at
FROM (SELECT *, row_number() OVER (ORDER BY performed_at DESC NULLS FIRST, ticket_id DESC,
                                            line_no DESC, amount DESC) AS pos
      FROM am NATURAL JOIN (SELECT machine_id, model FROM m))
WHERE pos BETWEEN 1 AND 15
""")
def q_recent_actions(spark, sf):
    return queues.recent_actions(V.actions(spark, sf), V.machines(spark, sf), 15,
                                 machine_of=V.ticket_machines(spark, sf))


@register("open_work_orders", O.with_(O.M, O.WO) + """
SELECT work_order_id, machine_id, model, priority, title, description, assigned_to, due_date,
       status, created_at
FROM wo NATURAL JOIN (SELECT machine_id, model FROM m)
WHERE status IN ('open', 'in_progress')
""")
def q_open_work_orders(spark, sf):
    return queues.open_work_orders(V.work_orders(spark, sf, exclude_status="closed"),
                                   V.machines(spark, sf))


@register("recent_quality_checks", O.with_(O.M, O.QC) + """
SELECT * EXCLUDE (pos)
FROM (SELECT check_id, order_id, machine_id, model, check_type, result, defect_code, notes,
             inspector, checked_at,
             row_number() OVER (ORDER BY checked_at DESC NULLS FIRST, check_id DESC) AS pos
      FROM qc NATURAL JOIN (SELECT machine_id, model FROM m))
WHERE pos BETWEEN 1 AND 15
""")
def q_recent_checks(spark, sf):
    return queues.recent_quality_checks(V.quality_checks(spark, sf), V.machines(spark, sf), 15)


@register("recent_notes", O.with_(O.M, O.N) + """,
few AS (SELECT * FROM n QUALIFY row_number() OVER (
          ORDER BY created_at DESC NULLS FIRST, order_id DESC, line_no DESC, amount DESC) <= 20)
SELECT order_id, line_no, amount, machine_id,
       (SELECT m.model FROM m WHERE m.machine_id = few.machine_id) AS model,
       note_type, content, created_by, created_at FROM few
""")
def q_recent_notes(spark, sf):
    return queues.recent_notes(V.operator_notes(spark, sf), V.machines(spark, sf), 20)


# ---------------------------------------------------------------- Q6 at-risk machines
RISK_BOUNDS = {"vibration": 80.0, "temperature": 60}
RISK_K = 4

_RISKY = """risky AS (
  SELECT machine_id, first_seen,
         CAST(row_number() OVER (ORDER BY first_seen, machine_id) AS INTEGER) AS pos
  FROM (SELECT machine_id, min(reading_id) AS first_seen FROM r
        WHERE vibration > 80 AND temperature > 60
        GROUP BY machine_id ORDER BY first_seen, machine_id LIMIT 4))"""


@register("readings_over_thresholds", O.with_(O.R) + """
SELECT reading_id, machine_id, ts, vibration, temperature FROM r
WHERE vibration > 80 AND temperature > 60
""")
def q_readings_over(spark, sf):
    return V.readings(spark, sf).filter(R.threshold_filter(RISK_BOUNDS))


@register("at_risk_machines", O.with_(O.R, _RISKY) + "SELECT * FROM risky")
def q_at_risk(spark, sf):
    return queues.at_risk_machines(V.readings(spark, sf), RISK_BOUNDS, RISK_K)


@register("open_risk_tickets", O.with_(O.R, _RISKY, O.T) + """,
firstk AS (SELECT ticket_id, CAST(row_number() OVER (ORDER BY ticket_id) AS INTEGER) AS pos
           FROM (SELECT ticket_id FROM t ORDER BY ticket_id LIMIT 4)),
patch AS (SELECT f.ticket_id, r.machine_id AS new_machine FROM firstk f JOIN risky r USING (pos))
SELECT t.ticket_id,
       CASE WHEN p.ticket_id IS NULL THEN t.machine_id ELSE p.new_machine END AS machine_id,
       t.opened_at,
       CASE WHEN p.ticket_id IS NULL THEN t.priority ELSE 'high' END AS priority,
       CASE WHEN p.ticket_id IS NULL THEN t.status ELSE 'open' END AS status,
       CASE WHEN p.ticket_id IS NULL THEN t.description
            ELSE 'High vibration + temperature — inspect before failure' END AS description
FROM t LEFT JOIN patch p ON p.ticket_id = t.ticket_id
""")
def q_open_risk_tickets(spark, sf):
    risky = queues.at_risk_machines(V.readings(spark, sf), RISK_BOUNDS, RISK_K)
    return queues.open_risk_tickets(V.tickets(spark, sf), risky, RISK_K)


# ---------------------------------------------------------------- projections / row rules
@register("dim_list", O.with_(O.M) + "SELECT machine_id, model, line, location FROM m "
          "ORDER BY machine_id")
def q_dim_list(spark, sf):
    return V.machines(spark, sf).select("machine_id", "model", "line", "location") \
        .orderBy("machine_id")


@register("note_machine_labels", O.with_(O.M, O.N) + """
SELECT n.order_id, n.line_no, n.amount, n.machine_id,
       COALESCE('#' || CAST(n.machine_id AS VARCHAR) || ' · ' || m.model || ' ('
                || CAST(m.line AS VARCHAR) || ')', '#' || CAST(n.machine_id AS VARCHAR))
         AS machine_label,
       upper(n.note_type) AS note_type_label
FROM n LEFT JOIN m ON m.machine_id = n.machine_id
""")
def q_note_labels(spark, sf):
    n = join_dim(V.operator_notes(spark, sf), V.machines(spark, sf), "machine_id", how="left")
    return n.select("order_id", "line_no", "amount", "machine_id",
                    R.machine_label("machine_id", "model", "line").alias("machine_label"),
                    F.upper("note_type").alias("note_type_label"))


@register("actor_slugs", """
SELECT c_custkey, regexp_replace(lower(split_part(c_name, '@', 1)), '[^a-z0-9]', '', 'g')
         AS slug,
       CASE WHEN split_part(c_name, '@', 1) = '' THEN c_name ELSE split_part(c_name, '@', 1) END
         AS short_name
FROM customer
""")
def q_actor_slugs(spark, sf):
    c = V.table(spark, sf, "customer")
    return c.select("c_custkey", R.user_slug("c_name").alias("slug"),
                    R.short_name("c_name").alias("short_name"))


# ================================================================ change history (H*, S6, S11)


LOG_PK = ["entity_id"]
AS_OF_TS = "2024-01-15 00:00:00"
SYNC_VERSION = 4999          # version the replica of the triggered-sync query was taken at
FIXED_TS = "2024-02-01 00:00:00"

_NR = """nr AS (SELECT * FROM log WHERE _change_type IS DISTINCT FROM 'update_preimage')"""
_CURRENT = """
SELECT entity_id, value, props FROM (
  SELECT nr.*, row_number() OVER (PARTITION BY entity_id ORDER BY _commit_version DESC) AS rn
  FROM nr WHERE entity_id IS NOT NULL) x
WHERE rn = 1 AND _change_type IS DISTINCT FROM 'delete'
"""


@register("current_state", O.with_(O.LOG, _NR) + _CURRENT)
def q_current_state(spark, sf):
    return H.current_state(V.change_log(spark, sf), LOG_PK)


@register("as_of_timestamp", O.with_(O.LOG, _NR.replace(
    "WHERE", f"WHERE _commit_timestamp <= TIMESTAMP '{AS_OF_TS}' AND")) + _CURRENT)
def q_as_of(spark, sf):
    return H.as_of(V.change_log(spark, sf), LOG_PK, timestamp=AS_OF_TS)


@register("as_of_version", O.with_(O.LOG, _NR.replace(
    "WHERE", f"WHERE _commit_version <= {SYNC_VERSION} AND")) + _CURRENT)
def q_as_of_version(spark, sf):
    return H.as_of(V.change_log(spark, sf), LOG_PK, version=SYNC_VERSION)


@register("triggered_sync", O.with_(O.LOG, _NR) + _CURRENT)
def q_triggered_sync(spark, sf):
    log = V.change_log(spark, sf)
    replica = H.as_of(log, LOG_PK, version=SYNC_VERSION)
    return sync.triggered_sync(replica, log, LOG_PK, SYNC_VERSION)


@register("read_changes", O.with_(O.LOG) + f"""
SELECT * FROM log WHERE _commit_version > {SYNC_VERSION}
""")
def q_read_changes(spark, sf):
    # the changes a replica taken at SYNC_VERSION still has to apply (open-ended range)
    return H.read_changes(V.change_log(spark, sf), from_version=SYNC_VERSION + 1)


@register("history_read", O.with_(O.LOG) + """
SELECT * FROM log ORDER BY _commit_timestamp DESC, _commit_version DESC
""")
def q_history_read(spark, sf):
    return H.history_read(V.change_log(spark, sf))


@register("validity_intervals", O.with_(O.LOG, _NR) + """,
x AS (SELECT nr.*, lead(_commit_timestamp) OVER (PARTITION BY entity_id
                                                  ORDER BY _commit_version) AS nxt FROM nr)
SELECT entity_id, value, props, _change_type, _commit_version, _commit_timestamp,
       _commit_timestamp AS valid_from, nxt AS valid_to, nxt IS NULL AS is_current
FROM x WHERE _change_type IS DISTINCT FROM 'delete'
""")
def q_validity(spark, sf):
    return H.validity_intervals(V.change_log(spark, sf), LOG_PK)


@register("audit_trail", O.with_(O.LOG, _NR) + """,
x AS (SELECT nr.*, lag(value) OVER w AS pv, lag(props) OVER w AS pp,
             lag(_change_type) OVER w AS pct
      FROM nr WINDOW w AS (PARTITION BY entity_id ORDER BY _commit_version))
SELECT entity_id, _commit_version, _commit_timestamp, _change_type,
       CASE WHEN pct IS NULL OR pct = 'delete' THEN NULL ELSE pv END AS old_value,
       CASE WHEN _change_type = 'delete' THEN NULL ELSE value END AS new_value,
       CASE WHEN pct IS NULL OR pct = 'delete' THEN NULL ELSE pp END AS old_props,
       CASE WHEN _change_type = 'delete' THEN NULL ELSE props END AS new_props
FROM x
""")
def q_audit(spark, sf):
    return H.audit_trail(V.change_log(spark, sf), LOG_PK, ["value", "props"])


def _two_histories(spark, sf):
    return H.union_histories({"entity_log": V.change_log(spark, sf),
                              "order_log": V.order_history(spark, sf)})


_UNION_SQL = """
SELECT entity_id, value, props, CAST(NULL AS BIGINT) AS order_id, CAST(NULL AS DOUBLE) AS total,
       _change_type, _commit_version, _commit_timestamp, 'entity_log' AS table_name FROM log
UNION ALL
SELECT NULL, NULL, NULL, order_id, total, _change_type, _commit_version, _commit_timestamp,
       'order_log' FROM oh
"""


@register("union_histories", O.with_(O.LOG, O.OH) + _UNION_SQL)
def q_union(spark, sf):
    return _two_histories(spark, sf)


@register("change_counts", O.with_(O.LOG, O.OH, "u AS (" + _UNION_SQL + ")") + """
SELECT table_name, _change_type, count(*) AS n_changes FROM u GROUP BY table_name, _change_type
""")
def q_change_counts(spark, sf):
    return H.change_counts(_two_histories(spark, sf), ["table_name", "_change_type"])


_DIFF_SQL = O.with_(O.SNAP) + f""",
j AS (SELECT COALESCE(o.o_orderkey, n.o_orderkey) AS o_orderkey, o.o_orderkey IS NOT NULL AS in_o,
             n.o_orderkey IS NOT NULL AS in_n,
             o.o_custkey AS oc, o.o_orderstatus AS os, o.o_totalprice AS op, o.o_orderdate AS od,
             o.o_orderpriority AS opr,
             n.o_custkey AS nc, n.o_orderstatus AS ns, n.o_totalprice AS np, n.o_orderdate AS nd,
             n.o_orderpriority AS npr
      FROM old_s o FULL OUTER JOIN new_s n ON o.o_orderkey = n.o_orderkey),
d AS (
  SELECT o_orderkey, nc AS o_custkey, ns AS o_orderstatus, np AS o_totalprice,
         nd AS o_orderdate, npr AS o_orderpriority, 'insert' AS _change_type FROM j WHERE NOT in_o
  UNION ALL
  SELECT o_orderkey, oc, os, op, od, opr, 'delete' FROM j WHERE NOT in_n
  UNION ALL
  SELECT o_orderkey, oc, os, op, od, opr, 'update_preimage' FROM j
  WHERE in_o AND in_n AND (oc IS DISTINCT FROM nc OR os IS DISTINCT FROM ns
        OR op IS DISTINCT FROM np OR od IS DISTINCT FROM nd OR opr IS DISTINCT FROM npr)
  UNION ALL
  SELECT o_orderkey, nc, ns, np, nd, npr, 'update_postimage' FROM j
  WHERE in_o AND in_n AND (oc IS DISTINCT FROM nc OR os IS DISTINCT FROM ns
        OR op IS DISTINCT FROM np OR od IS DISTINCT FROM nd OR opr IS DISTINCT FROM npr))
"""


def _diff(spark, sf):
    old, new = V.snapshot_pair(spark, sf)
    return H.diff_snapshots(old, new, ["o_orderkey"], version=1, timestamp=FIXED_TS)


@register("diff_snapshots", _DIFF_SQL + f"""
SELECT d.*, CAST(1 AS BIGINT) AS _commit_version,
       TIMESTAMP '{FIXED_TS}' AS _commit_timestamp FROM d
""")
def q_diff(spark, sf):
    return _diff(spark, sf)


@register("diff_then_apply", O.with_(O.SNAP) + "SELECT * FROM new_s")
def q_diff_apply(spark, sf):
    # property: applying diff(old, new) onto old gives new
    old, _ = V.snapshot_pair(spark, sf)
    return H.apply_changes(old, _diff(spark, sf), ["o_orderkey"], since_version=0)


@register("snapshot_sync", O.with_(O.SNAP) + "SELECT * FROM new_s")
def q_snapshot_sync(spark, sf):
    _, new = V.snapshot_pair(spark, sf)
    return sync.snapshot_sync(new, ["o_orderkey"], scratch_path(spark, "replicas", "orders"))


@register("reconcile", O.with_(O.SNAP) + """
SELECT CAST(count(o.o_orderkey) AS BIGINT) AS source_rows,
       CAST(count(n.o_orderkey) AS BIGINT) AS replica_rows,
       CAST(count(*) FILTER (WHERE n.o_orderkey IS NULL) AS BIGINT) AS missing_in_replica,
       CAST(count(*) FILTER (WHERE o.o_orderkey IS NULL) AS BIGINT) AS extra_in_replica,
       CAST(count(*) FILTER (WHERE o.o_orderkey IS NOT NULL AND n.o_orderkey IS NOT NULL AND (
            o.o_custkey IS DISTINCT FROM n.o_custkey OR o.o_orderstatus IS DISTINCT FROM
            n.o_orderstatus OR o.o_totalprice IS DISTINCT FROM n.o_totalprice OR
            o.o_orderdate IS DISTINCT FROM n.o_orderdate OR
            o.o_orderpriority IS DISTINCT FROM n.o_orderpriority)) AS BIGINT) AS changed_keys
FROM old_s o FULL OUTER JOIN new_s n ON o.o_orderkey = n.o_orderkey
""")
def q_reconcile(spark, sf):
    old, new = V.snapshot_pair(spark, sf)
    return sync.reconcile(old, new, ["o_orderkey"])


@register("reconcile_tables", O.with_(O.SNAP, O.LOG, _NR) + """,
cur AS (""" + _CURRENT + """)
SELECT 'orders' AS table_name,
       CAST(count(o.o_orderkey) AS BIGINT) AS source_rows,
       CAST(count(n.o_orderkey) AS BIGINT) AS replica_rows,
       CAST(count(*) FILTER (WHERE n.o_orderkey IS NULL) AS BIGINT) AS missing_in_replica,
       CAST(count(*) FILTER (WHERE o.o_orderkey IS NULL) AS BIGINT) AS extra_in_replica,
       CAST(count(*) FILTER (WHERE o.o_orderkey IS NOT NULL AND n.o_orderkey IS NOT NULL AND (
            o.o_custkey IS DISTINCT FROM n.o_custkey OR o.o_orderstatus IS DISTINCT FROM
            n.o_orderstatus OR o.o_totalprice IS DISTINCT FROM n.o_totalprice OR
            o.o_orderdate IS DISTINCT FROM n.o_orderdate OR
            o.o_orderpriority IS DISTINCT FROM n.o_orderpriority)) AS BIGINT) AS changed_keys
FROM old_s o FULL OUTER JOIN new_s n ON o.o_orderkey = n.o_orderkey
UNION ALL
SELECT 'entity_state', CAST(count(*) AS BIGINT), CAST(count(*) AS BIGINT), CAST(0 AS BIGINT),
       CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM cur
""")
def q_reconcile_tables(spark, sf):
    old, new = V.snapshot_pair(spark, sf)
    log = V.change_log(spark, sf)
    source = H.current_state(log, LOG_PK)
    replica = sync.triggered_sync(H.as_of(log, LOG_PK, version=SYNC_VERSION), log, LOG_PK,
                                  SYNC_VERSION)
    return replicas.reconcile_by_sums({"orders": (old, new, ["o_orderkey"]),
                                       "entity_state": (source, replica, LOG_PK)})


@register("as_of_from_snapshot", ORACLE["as_of_version"])
def q_as_of_from_snapshot(spark, sf):
    """The log in ranges, snapshots before and after the version asked for."""
    log = V.change_log(spark, sf)
    kept = replicas.SnapshotLog(spark, scratch_path(spark, "snapshots", "entity_log"), LOG_PK, width=SYNC_VERSION // 4)
    kept.append(log)
    kept.record(SYNC_VERSION // 2)
    kept.record(SYNC_VERSION * 2)
    return kept.as_of(SYNC_VERSION)


@register("bucket_sync", O.with_(O.LOG, _NR) + _CURRENT)
def q_bucket_sync(spark, sf):
    """A replica in buckets brought up to date; only the buckets that changes hit are written."""
    log = V.change_log(spark, sf)
    old = H.as_of(log, LOG_PK, version=SYNC_VERSION)
    replica = replicas.BucketReplica(spark, scratch_path(spark, "replicas", "entity_buckets"), LOG_PK, buckets=16)
    replica.write(old)
    replica.refresh(log, SYNC_VERSION, old.schema)
    return replica.read(old.schema)


@register("compare_keys", O.with_(O.SNAP) + """
SELECT o_orderkey, 'both' AS side FROM (SELECT o_orderkey FROM old_s INTERSECT
                                        SELECT o_orderkey FROM new_s)
UNION ALL
SELECT o_orderkey, 'left_only' FROM (SELECT o_orderkey FROM old_s EXCEPT
                                     SELECT o_orderkey FROM new_s)
UNION ALL
SELECT o_orderkey, 'right_only' FROM (SELECT o_orderkey FROM new_s EXCEPT
                                      SELECT o_orderkey FROM old_s)
""")
def q_compare_keys(spark, sf):
    old, new = V.snapshot_pair(spark, sf)
    return compare_keys(old, new, ["o_orderkey"])


@register("table_counts", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows, 'ok' AS status FROM {t}"
    for t in V.DRIVER_TABLES))
def q_table_counts(spark, sf):
    return sync.table_counts(spark, {t: V.table(spark, sf, t) for t in V.DRIVER_TABLES})


# ================================================================ metrics (Q7, Q8, Q10)
_TTF_COLS = """am.ticket_id, am.line_no, am.amount, am.machine_id, m.model, am.performed_by,
       am.action_type, am.description,
       CAST(round((floor(epoch(am.completed_at)) - floor(epoch(t.opened_at))) / 3600.0, 1)
            AS DOUBLE) AS hours_to_fix"""
_TTF_SQL = O.with_(O.M, O.T, O.A, O.AM) + f"""
SELECT {_TTF_COLS}
FROM am JOIN m ON m.machine_id = am.machine_id
LEFT JOIN t ON t.ticket_id = am.ticket_id
WHERE am.status = 'completed'
"""
_TTF_KEYS = ("ticket_id", "line_no", "amount")


def _ttf(spark, sf, ordered=True):
    # Q7 keeps only completed rows: that predicate is pushed to the lineitem scan
    return metrics.time_to_fix(V.actions(spark, sf, status_value="completed"),
                               V.machines(spark, sf), V.tickets(spark, sf), _TTF_KEYS, ordered,
                               machine_from_ticket=True)


@register("time_to_fix", _TTF_SQL + "ORDER BY am.completed_at DESC")
def q_ttf(spark, sf):
    return _ttf(spark, sf)


@register("time_to_fix_net", O.with_(O.M, O.T, O.A, O.AM) + f""",
latest AS (SELECT * FROM (SELECT am.*, row_number() OVER (PARTITION BY ticket_id
             ORDER BY performed_at DESC, line_no DESC, amount DESC) AS rn FROM am) WHERE rn = 1)
SELECT {_TTF_COLS.replace('am.', 'latest.')}
FROM latest JOIN m ON m.machine_id = latest.machine_id
LEFT JOIN t ON t.ticket_id = latest.ticket_id
WHERE latest.status = 'completed'
""")
def q_ttf_net(spark, sf):
    hist = H.with_meta(V.actions(spark, sf), H.INSERT, 0, FIXED_TS)
    return metrics.time_to_fix_net(hist, V.machines(spark, sf), V.tickets(spark, sf),
                                   pk=["ticket_id"], order=["performed_at"],
                                   tie=["line_no", "amount"], keys=_TTF_KEYS,
                                   machine_from_ticket=True)


# Q7 and Q8 on a change log with preimages, superseded rows and deletes: they differ
_TTF_LOG = """
SELECT x.action_id, x.ticket_id, x.machine_id, m.model, x.performed_by, x.action_type,
       x.description, CAST(round((floor(epoch(x.completed_at)) - floor(epoch(t.opened_at)))
                                 / 3600.0, 1) AS DOUBLE) AS hours_to_fix
FROM x JOIN m ON m.machine_id = x.machine_id LEFT JOIN t ON t.ticket_id = x.ticket_id
WHERE x.status = 'completed'
"""


@register("time_to_fix_log", O.with_(O.M, O.T, O.AH, "x AS (SELECT * FROM ah)") + _TTF_LOG)
def q_ttf_log(spark, sf):
    return metrics.time_to_fix(V.action_history(spark, sf), V.machines(spark, sf),
                               V.tickets(spark, sf), ("action_id", "ticket_id"))


@register("time_to_fix_log_net", O.with_(O.M, O.T, O.AH, """x AS (
  SELECT * FROM (SELECT * FROM ah WHERE _change_type IS DISTINCT FROM 'update_preimage'
                 QUALIFY row_number() OVER (PARTITION BY action_id ORDER BY _commit_version DESC) = 1)
  WHERE _change_type IS DISTINCT FROM 'delete')""") + _TTF_LOG)
def q_ttf_log_net(spark, sf):
    return metrics.time_to_fix_net(V.action_history(spark, sf), V.machines(spark, sf),
                                   V.tickets(spark, sf), pk=["action_id"], order=[H.VER],
                                   keys=("action_id", "ticket_id"))


@register("actions_per_day", O.with_(O.A) + """
SELECT date_trunc('day', completed_at) AS day, count(*) AS n_actions FROM a
WHERE completed_at IS NOT NULL GROUP BY 1
""")
def q_actions_per_day(spark, sf):
    return metrics.actions_per_day(V.actions(spark, sf))


@register("avg_fix_by_model", O.with_(O.M, O.T, O.A, O.AM, "f AS (" + _TTF_SQL + ")") + """
SELECT model, round(avg(hours_to_fix), 4) AS avg_hours_to_fix, count(hours_to_fix) AS n_fixes
FROM f GROUP BY model
""")
def q_avg_fix(spark, sf):
    return metrics.avg_fix_by_model(_ttf(spark, sf, ordered=False))


# ================================================================ writes


@register("insert_actions", O.with_(O.A) + f"""
SELECT ticket_id, line_no, amount, action_type, nullif(description, '') AS description,
       performed_by, performed_at, status,
       CASE WHEN status = 'completed' THEN TIMESTAMP '{FIXED_TS}' END AS completed_at,
       'insert' AS _change_type, CAST(1 AS BIGINT) AS _commit_version,
       TIMESTAMP '{FIXED_TS}' AS _commit_timestamp
FROM a
""")
def q_insert_actions(spark, sf):
    now = F.lit(FIXED_TS).cast("timestamp_ntz")
    _, changes = Wr.insert_rows(None, V.actions(spark, sf), {
        "description": R.empty_to_null("description"),
        "completed_at": R.completed_at_rule("status", now),
    }, version=1, timestamp=FIXED_TS, defaults={"performed_at": now})
    return changes


@register("insert_work_orders", O.with_(O.WO) + f"""
SELECT work_order_id, machine_id, priority, title, description,
       nullif(assigned_to, '') AS assigned_to, due_date,
       CASE WHEN COALESCE(assigned_to, '') <> '' THEN 'assigned' ELSE 'open' END AS status,
       created_at, 'insert' AS _change_type, CAST(1 AS BIGINT) AS _commit_version,
       TIMESTAMP '{FIXED_TS}' AS _commit_timestamp
FROM wo
""")
def q_insert_work_orders(spark, sf):
    _, changes = Wr.insert_rows(None, V.work_orders(spark, sf), {
        "status": R.default_status("assigned_to"),
        "assigned_to": R.empty_to_null("assigned_to"),
    }, version=1, timestamp=FIXED_TS)
    return changes


@register("assign_action_ids", O.with_(O.A) + """
SELECT count(*) AS n_rows, count(*) AS n_distinct_ids, CAST(1 AS BIGINT) AS min_id,
       CAST(count(*) AS BIGINT) AS max_id FROM a
""")
def q_assign_ids(spark, sf):
    # ids for every action row, identified by its natural key (what the checkpoint stores)
    rows = V.actions(spark, sf).select("ticket_id", "performed_at", "line_no", "amount")
    ids = Wr.assign_keys(rows, "action_id", start_after=0)
    return ids.agg(F.count(F.lit(1)).alias("n_rows"),
                   F.countDistinct("action_id").alias("n_distinct_ids"),
                   F.min("action_id").alias("min_id"), F.max("action_id").alias("max_id"))


_UPD_PRED = "priority = 'high' AND status = 'in_progress'"


@register("update_where", O.with_(O.T) + f"""
SELECT ticket_id, machine_id, opened_at, priority, status, description,
       'update_preimage' AS _change_type, CAST(2 AS BIGINT) AS _commit_version,
       TIMESTAMP '{FIXED_TS}' AS _commit_timestamp FROM t WHERE {_UPD_PRED}
UNION ALL
SELECT ticket_id, machine_id, opened_at, priority, 'resolved', description,
       'update_postimage', CAST(2 AS BIGINT), TIMESTAMP '{FIXED_TS}' FROM t WHERE {_UPD_PRED}
""")
def q_update_where(spark, sf):
    _, changes = Wr.update_where(V.tickets(spark, sf), F.expr(_UPD_PRED),
                                 {"status": F.lit("resolved")}, version=2, timestamp=FIXED_TS)
    return changes


_DEL_PRED = "priority = 'low' AND status = 'resolved'"


@register("delete_where", O.with_(O.T) + f"""
SELECT t.*, 'delete' AS _change_type, CAST(3 AS BIGINT) AS _commit_version,
       TIMESTAMP '{FIXED_TS}' AS _commit_timestamp FROM t WHERE {_DEL_PRED}
""")
def q_delete_where(spark, sf):
    _, changes = Wr.delete_where(V.tickets(spark, sf), F.expr(_DEL_PRED), version=3,
                                 timestamp=FIXED_TS)
    return changes



# the app's note types (the DDL comment lists 'observation' instead of 'general')
APP_NOTE_TYPES = D.APP["note_type"]


@register("validate_notes", O.with_(O.N) + """
SELECT n.*, concat_ws('; ',
         CASE WHEN content IS NULL OR content = '' THEN 'content is required' END,
         CASE WHEN note_type IS NOT NULL
               AND note_type NOT IN ('general', 'alert', 'handoff', 'resolution')
              THEN 'note_type not in domain' END) AS reasons
FROM n
WHERE (content IS NULL OR content = '')
   OR (note_type IS NOT NULL AND note_type NOT IN ('general', 'alert', 'handoff', 'resolution'))
""")
def q_validate_notes(spark, sf):
    _, rejected = Wr.validate_rows(V.operator_notes(spark, sf),
                                   required=D.APP_REQUIRED["operator_notes"],
                                   domains={"note_type": APP_NOTE_TYPES})
    return rejected


@register("validate_references", O.with_(O.N, O.M) + """
SELECT n.*, concat_ws('; ', CASE WHEN content IS NULL OR content = '' THEN 'content is required' END,
         CASE WHEN machine_id IS NOT NULL AND machine_id NOT IN (SELECT machine_id FROM m WHERE machine_id IS NOT NULL)
              THEN 'machine_id not in machines' END) AS reasons
FROM n
WHERE content IS NULL OR content = ''
   OR (machine_id IS NOT NULL AND machine_id NOT IN (SELECT machine_id FROM m WHERE machine_id IS NOT NULL))
""")
def q_validate_references(spark, sf):
    """Notes without content or of a machine that there is not."""
    _, rejected = Wr.validate_rows(
        V.operator_notes(spark, sf), required=["content"],
        references={"machines": (V.machines(spark, sf).select("machine_id"), ["machine_id"])})
    return rejected


@register("insert_quality_checks", O.with_(O.QC) + f"""
SELECT check_id, order_id, machine_id, check_type, result, defect_code, notes, inspector,
       TIMESTAMP '{FIXED_TS}' AS checked_at,
       'insert' AS _change_type, CAST(1 AS BIGINT) AS _commit_version,
       TIMESTAMP '{FIXED_TS}' AS _commit_timestamp
FROM qc
""")
def q_insert_checks(spark, sf):
    """As the form sends them: an empty defect code, no time of the check, the inspector's
    e-mail address."""
    sent = V.quality_checks(spark, sf).drop("checked_at").withColumns({
        "defect_code": F.coalesce("defect_code", F.lit("")),
        "email": F.concat("inspector", F.lit("@plant.example"))})
    sent = Wr.stamp_actor(sent, F.col("email"), "inspector").drop("email")
    _, changes = Wr.insert_rows(None, sent, {"defect_code": R.empty_to_null("defect_code")},
                                version=1, timestamp=FIXED_TS,
                                defaults={"checked_at": F.lit(FIXED_TS).cast("timestamp_ntz")})
    return changes


@register("insert_notes", O.with_(O.N) + f"""
SELECT note_type, count(*) AS n_rows, count(DISTINCT created_by) AS n_authors,
       TIMESTAMP '{FIXED_TS}' AS first_created, CAST(count(*) AS BIGINT) AS n_ids,
       CAST(sum(count(*)) OVER () AS BIGINT) AS all_ids, TRUE AS above_current
FROM n WHERE note_type IN ('general', 'alert', 'handoff', 'resolution') AND content <> ''
GROUP BY note_type
""")
def q_insert_notes(spark, sf):
    """Validation, a default for the absent column and fresh keys above the current ones."""
    notes = V.operator_notes(spark, sf).drop("created_at")
    current = spark.range(1, 8).select(F.col("id").cast("bigint").alias("note_id"))
    _, changes = Wr.insert_rows(
        current, notes, {}, version=1, timestamp=FIXED_TS, key="note_id",
        defaults={"created_at": F.lit(FIXED_TS).cast("timestamp_ntz")},
        required=D.APP_REQUIRED["operator_notes"], domains={"note_type": APP_NOTE_TYPES})
    changes = changes.select("note_id", "note_type", "created_by", "created_at")
    total = changes.agg(F.countDistinct("note_id").alias("all_ids"), F.min("note_id").alias("low"))
    return (changes.groupBy("note_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("created_by").alias("n_authors"),
        F.min("created_at").alias("first_created"), F.countDistinct("note_id").alias("n_ids"))
        .join(F.broadcast(total)).select(   # one row
            "note_type", "n_rows", "n_authors", "first_created", "n_ids", "all_ids",
            (F.col("low") > 7).alias("above_current")))


_OLD = "pct IS NOT NULL AND pct <> 'delete' AND (pp IS NOT NULL OR pv IS NOT NULL)"
_NEW = "_change_type <> 'delete' AND (props IS NOT NULL OR value IS NOT NULL)"


@register("audit_histories", O.with_(O.LOG, _NR, O.OH) + f""",
x AS (SELECT nr.*, lag(_change_type) OVER (PARTITION BY entity_id ORDER BY _commit_version) AS pct,
             lag(props) OVER (PARTITION BY entity_id ORDER BY _commit_version) AS pp,
             lag(value) OVER (PARTITION BY entity_id ORDER BY _commit_version) AS pv
      FROM nr WHERE entity_id IS NOT NULL)
SELECT 'entity_log' AS table_name, CAST(entity_id AS VARCHAR) AS row_key,
       'svc-' || _change_type AS actor, _commit_version, _commit_timestamp, _change_type,
       {_OLD} AS has_old, {_NEW} AS has_new,
       CASE WHEN {_OLD} THEN pv END AS old_value, CASE WHEN {_OLD} THEN pp END AS old_props,
       CASE WHEN {_NEW} THEN value END AS new_value, CASE WHEN {_NEW} THEN props END AS new_props
FROM x
UNION ALL
SELECT 'orders', CAST(order_id AS VARCHAR), NULL, _commit_version, _commit_timestamp, _change_type,
       FALSE, _change_type <> 'delete' AND total IS NOT NULL,
       NULL, NULL, CASE WHEN _change_type <> 'delete' THEN total END, NULL
FROM oh
""")
def q_audit_histories(spark, sf):
    """Every change with its images, read back from their JSON (``total`` as the value of orders)."""
    log = V.change_log(spark, sf)
    log = Wr.stamp_actor(log, F.concat(F.lit("svc-"), F.col(H.CT), F.lit("@plant.example")))
    # events carry no preimage of the same version, so the previous image is the old one
    trail = H.audit_histories({
        "entity_log": (log, LOG_PK, ["value", "props"], "changed_by"),
        "orders": (V.order_history(spark, sf), ["order_id"], ["total"], None)})
    image = {side: F.from_json(f"{side}_row", "value double, total double, props string") for side in ("old", "new")}
    return trail.select("table_name", "row_key", "actor", H.VER, H.TS, H.CT,
                        *[c for side, i in image.items() for c in (
                            F.col(f"{side}_row").isNotNull().alias(f"has_{side}"),
                            F.coalesce(i["value"], i["total"]).alias(f"{side}_value"),
                            i["props"].alias(f"{side}_props"))])


# ---- the orders themselves (O1, O2, O4): each row with its place in the sorted result


def _placed(ordered, key):
    """The place of each row of a sorted frame: sorting deals out ranges, so keys assigned
    partition by partition are places; no task sees all rows."""
    return Wr.assign_keys(ordered.select(*key), "place")


_PLACE = "SELECT {key}, CAST(row_number() OVER (ORDER BY {order}) AS BIGINT) AS place FROM q"
_SEVERITY = "CASE priority WHEN 'high' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END"
for _name, _order in (("priority", _SEVERITY + ", opened_at, ticket_id"),
                      ("oldest", "opened_at, ticket_id"),
                      ("machine", "machine_id, opened_at, ticket_id")):
    register(f"open_alerts_places_{_name}", O.with_(*_Q1_CTES, "q AS (SELECT z.*, t.opened_at FROM (" + _Q1_BODY
             + ") z JOIN t USING (ticket_id))") + _PLACE.format(key="ticket_id", order=_order))(
        lambda spark, sf, _name=_name: _placed(
            queues.open_alerts(*_queue_inputs(spark, sf), sort=_name), ["ticket_id"]))


@register("open_work_orders_places", O.with_(O.WO, O.M, """q AS (
  SELECT wo.* FROM wo JOIN m USING (machine_id) WHERE status IN ('open', 'in_progress'))""")
  + _PLACE.format(key="work_order_id", order="list_position(['critical', 'high', 'medium', 'low'], "
                  "priority), created_at, work_order_id"))
def q_work_order_places(spark, sf):
    return _placed(queues.open_work_orders(V.work_orders(spark, sf, exclude_status="closed"),
                                           V.machines(spark, sf)), ["work_order_id"])


@register("history_places", O.with_("q AS (SELECT event_id AS _commit_version, ts FROM events)")
          + _PLACE.format(key="_commit_version", order="ts DESC NULLS LAST, _commit_version DESC"))
def q_history_places(spark, sf):
    return _placed(H.history_read(V.change_log(spark, sf)), [H.VER])


# ================================================================ streaming (ST1-ST4)


@register("stream_capture", O.with_(O.LOG) + "SELECT * FROM log")
def q_stream_capture(spark, sf):
    root = scratch_path(spark, "capture")
    src = V.change_log_of(SC.file_stream(spark, sf, "events.parquet"))
    SC.capture_changes(src, f"{root}/history", f"{root}/_checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/history")


@register("stream_current_state", O.with_(O.LOG, _NR) + _CURRENT)
def q_stream_current_state(spark, sf):
    state = KeyedState(spark, scratch_path(spark, "state", "entity_log"), LOG_PK,
                       partitions=suggest_partitions(estimated_bytes(V.table(spark, sf, "events"))))
    src = V.change_log_of(SC.file_stream(spark, sf, "events.parquet"))
    continuous_sync(src, state).awaitTermination()
    return state.current(_LOG_ROW).select("entity_id", "value", "props")


@register("stream_live_queue", _Q1_SQL)
def q_stream_live_queue(spark, sf):
    """The latest action per ticket kept as state, the queue read over it."""
    state = KeyedState(spark, scratch_path(spark, "state", "latest_action"), ["ticket_id"],
                       order=["performed_at"], tie=["line_no", "amount"], nulls_first=True,
                       partitions=suggest_partitions(estimated_bytes(V.table(spark, sf, "lineitem")), 8 << 20))
    src = V.actions_of(SC.file_stream(spark, sf, "lineitem.parquet")).select(
        "ticket_id", "performed_at", "performed_by", "status", "line_no", "amount")
    continuous_sync(src, state).awaitTermination()
    return SL.live_open_alerts(V.tickets(spark, sf, status="open"), V.machines(spark, sf),
                               state)


@register("stream_daily_counts", ORACLE["actions_per_day"])
def q_stream_daily_counts(spark, sf):
    state = SL.DailyCounts(spark, scratch_path(spark, "state", "daily_counts"), "completed_at")
    src = V.actions_of(SC.file_stream(spark, sf, "lineitem.parquet"))
    SL.live_daily_counts(src, state).awaitTermination()
    return state.current(_DAYS)


# ---- the same over many micro-batches, newest rows first, read through an older reader
_LOG_ROW = "entity_id bigint, value double, props string"
_DAYS = "day timestamp_ntz, n_actions bigint"
STREAM_FILES = 12
#: A file's row groups are what the tasks of a batch read it by.
_ROW_GROUP = 8 << 20


def _state_parts(spark, sf, table: str) -> dict:
    """State partitions for about 32 MB of the table each, 8 at least, and 8 buckets in each."""
    n = suggest_partitions(estimated_bytes(V.table(spark, sf, table)), 32 << 20, least=8)
    return {"partitions": n, "buckets": 8 * n}


def _in_files(df, order: str, path: str, latest_first: bool = True):
    """The whole frame written again as about STREAM_FILES files, each a range of ``order``, and a stream over
    them, one file a micro-batch: of the latest rows first, or written in order, one after the other."""
    ranges = df.repartitionByRange(STREAM_FILES, F.desc(order) if latest_first else F.asc(order))
    if latest_first:
        ranges.write.option("parquet.block.size", _ROW_GROUP).mode("append").parquet(path)
    else:       # files are taken by time, so one job writes one; the frame is dealt out once
        ranges.write.parquet(f"{path}-dealt")
        names = sorted(df.sparkSession.read.parquet(f"{path}-dealt").inputFiles())
        for name in names:
            (df.sparkSession.read.schema(df.schema).parquet(name).coalesce(1)
             .write.option("parquet.block.size", _ROW_GROUP).mode("append").parquet(path))
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


@register("stream_state_batches", ORACLE["stream_current_state"])
def q_stream_state_batches(spark, sf):
    """Deletes and late changes in many micro-batches; then every file again, to the same query:
    replays change nothing."""
    root = scratch_path(spark, "state", "entity_log_batches")
    reader = KeyedState(spark, f"{root}/state", LOG_PK)     # opened before the stream
    reader.current()
    state = KeyedState(spark, f"{root}/state", LOG_PK, partitions=4)
    log = V.table(spark, sf, "events")
    for _ in range(2):
        src = V.change_log_of(_in_files(log, "event_id", f"{root}/input"))
        continuous_sync(src, state).awaitTermination()
    return reader.current(_LOG_ROW).select("entity_id", "value", "props")


@register("stream_daily_counts_batches", ORACLE["actions_per_day"])
def q_stream_daily_counts_batches(spark, sf):
    root = scratch_path(spark, "state", "daily_counts_batches")
    reader = SL.DailyCounts(spark, f"{root}/state", "completed_at")
    reader.current()
    src = V.actions_of(_in_files(V.table(spark, sf, "lineitem"), "l_shipdate", f"{root}/input"))
    SL.live_daily_counts(src, SL.DailyCounts(spark, f"{root}/state", "completed_at")).awaitTermination()
    return reader.current(_DAYS)


@register("stream_live_queue_batches", _Q1_SQL)
def q_stream_live_queue_batches(spark, sf):
    """What every micro-batch adds to and removes from the queue, summed up."""
    root = scratch_path(spark, "state", "queue_batches")
    src = V.actions_of(_in_files(V.table(spark, sf, "lineitem"), "l_shipdate", f"{root}/input")).select(
        "ticket_id", "performed_at", "performed_by", "status", "line_no", "amount")
    SL.live_queue(src, V.tickets(spark, sf, status="open"), V.machines(spark, sf), f"{root}/_checkpoint",
                  SD.delta_sink(f"{root}/changes"), **_state_parts(spark, sf, "lineitem")).awaitTermination()
    return SD.summed(spark.read.parquet(f"{root}/changes"))


@register("stream_intervals_batches", ORACLE["validity_intervals"])
def q_stream_intervals_batches(spark, sf):
    """H4 maintained, newest changes first: each batch splices the intervals of the keys it touches."""
    root = scratch_path(spark, "state", "interval_batches")
    stream = V.change_log_of(_in_files(V.table(spark, sf, "events"), "event_id", f"{root}/input"))
    parts = _state_parts(spark, sf, "events")
    SD.start_deltas(SH.interval_changes(stream, LOG_PK, parts["buckets"]), f"{root}/_checkpoint",
                    SD.delta_sink(f"{root}/changes"), partitions=parts["partitions"]).awaitTermination()
    bounds = SD.summed(spark.read.parquet(f"{root}/changes"))
    return SH.intervals_of(V.change_log(spark, sf), bounds, LOG_PK)


# ---- row states without change types: captured as a log with images, averaged with retractions
_STATES = """st AS (SELECT user_id, event_id, event_type = 'error' AS gone, value, props,
  lag(CASE WHEN event_type <> 'error' THEN value END) OVER w AS old_value,
  lag(CASE WHEN event_type <> 'error' THEN props END) OVER w AS old_props,
  coalesce(lag(event_type <> 'error') OVER w, FALSE) AS had
  FROM events WHERE user_id IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY event_id))"""


def _captured(spark, sf, root):
    """The change log, captured in batches from the events taken as states of their user: an error
    event is the end of the row, any other its value and props."""
    events = V.table(spark, sf, "events").select("user_id", "event_id", "event_type", "value", "props")
    stream = _in_files(events, "event_id", f"{root}/input", latest_first=False)
    parts = _state_parts(spark, sf, "events")
    changes = SH.captured_changes(stream, ["user_id"], "event_id", F.col("event_type") == "error", ["value", "props"],
                                  parts["buckets"])
    SD.start_deltas(changes, f"{root}/_checkpoint", SD.delta_sink(f"{root}/log"),
                    partitions=parts["partitions"]).awaitTermination()
    return spark.read.parquet(f"{root}/log")


@register("stream_capture_states", f"""WITH {_STATES}
SELECT user_id, old_value AS value, old_props AS props, 'delete' AS _change_type, event_id AS _commit_version
FROM st WHERE gone AND had
UNION ALL SELECT user_id, value, props, 'insert', event_id FROM st WHERE NOT gone AND NOT had
UNION ALL SELECT user_id, unnest([old_value, value]), unnest([old_props, props]),
  unnest(['update_preimage', 'update_postimage']), event_id
FROM st WHERE NOT gone AND had AND (value IS DISTINCT FROM old_value OR props IS DISTINCT FROM old_props)
""")
def q_stream_capture_states(spark, sf):
    log = _captured(spark, sf, scratch_path(spark, "state", "captured"))
    return log.select("user_id", "value", "props", H.CT, H.VER)


@register("stream_signed_averages", """
SELECT props, count(value) AS n, avg(round(value, 6)) AS average FROM (
  SELECT * FROM events WHERE user_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
WHERE event_type <> 'error' AND value IS NOT NULL GROUP BY props
""")
def q_stream_signed_averages(spark, sf):
    """ST4 / A4 with retractions over the captured log: averages of the rows that are there now."""
    root = scratch_path(spark, "state", "signed")
    log = _captured(spark, sf, root)
    state = SL.SignedAverages(spark, f"{root}/averages", ["props"], "value")
    state.start(spark.readStream.schema(log.schema).parquet(f"{root}/log")).awaitTermination()
    return state.averages().select("props", "n", "average")
