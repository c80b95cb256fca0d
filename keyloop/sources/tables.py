"""Parquet scans of the driver tables and the role views the operators run on.

Each role view is a projection (at most one key join) of one driver table; it stays lazy so
that Catalyst prunes columns and pushes predicates down to the parquet scan.  The mapping
(which column plays which role) is ours and documented in the README; the operators never
depend on it, they take column names as parameters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


_SCANS: dict[tuple[str, int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table (S2). Preview with ``.limit(n)`` at the call site.

    The driver tables are read-only, so one lazy scan per (session, path) is reused: the
    parquet schema is resolved once instead of by a footer job per call.  ``clear_scans()``
    forgets them (e.g. after the files were replaced).
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, id(spark), path)   # per session, per path
    if key not in _SCANS:
        _SCANS[key] = spark.read.parquet(path)
    return _SCANS[key]


def clear_scans() -> None:
    """Forget the reused driver-table scans."""
    _SCANS.clear()


def _code_map(col: str, pairs: list[tuple[str, str]], default: str | None) -> Column:
    expr = None
    for code, value in pairs:
        cond = F.col(col) == F.lit(code)
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    return expr.otherwise(F.lit(default)) if default is not None else expr


# Role mapping of the driver codes (ours, see README "Role mapping").
TICKET_PRIORITY = [("1-URGENT", "critical"), ("2-HIGH", "high"), ("3-MEDIUM", "medium")]
TICKET_PRIORITY_DEFAULT = "low"
TICKET_STATUS = [("O", "open"), ("P", "in_progress"), ("F", "resolved")]
WORK_ORDER_STATUS = [("O", "open"), ("P", "in_progress"), ("F", "closed")]
ACTION_STATUS = [("F", "completed"), ("O", "in_progress")]
ACTION_TYPE = [("R", "corrective"), ("A", "preventive"), ("N", "inspection")]
NOTE_TYPE = [("R", "alert"), ("A", "handoff"), ("N", "observation")]
CHANGE_TYPE = [("signup", "insert"), ("view", "update_preimage"),
               ("click", "update_postimage"), ("purchase", "update_postimage"),
               ("error", "delete")]


def machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """machines(machine_id, model, line, location) from customer."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("machine_id"),
        F.col("c_mktsegment").alias("model"),
        F.col("c_nationkey").alias("line"),
        F.col("c_name").alias("location"))


def _codes_for(pairs: list[tuple[str, str]], value: str) -> list[str]:
    return [code for code, v in pairs if v == value]


def tickets(spark: SparkSession, sf_dir: str, status: str | None = None) -> DataFrame:
    """maintenance_tickets(ticket_id, machine_id, opened_at, priority, status, description).

    ``status`` (a role value such as 'open') is translated back to the raw code so that the
    predicate reaches the parquet scan (PushedFilters) instead of a CASE expression.
    """
    o = table(spark, sf_dir, "orders")
    if status is not None:
        o = o.filter(F.col("o_orderstatus").isin(_codes_for(TICKET_STATUS, status)))
    return o.select(
        F.col("o_orderkey").alias("ticket_id"),
        F.col("o_custkey").alias("machine_id"),
        F.col("o_orderdate").alias("opened_at"),
        _code_map("o_orderpriority", TICKET_PRIORITY, TICKET_PRIORITY_DEFAULT).alias("priority"),
        _code_map("o_orderstatus", TICKET_STATUS, None).alias("status"),
        F.col("o_orderpriority").alias("description"))


def work_orders(spark: SparkSession, sf_dir: str, exclude_status: str | None = None
                ) -> DataFrame:
    """work_orders(work_order_id, machine_id, priority, title, description, assigned_to,
    due_date, status, created_at) from orders.  ``exclude_status`` pushes ``status <> v``
    (nulls dropped, as SQL does) down to the scan as a code predicate."""
    o = table(spark, sf_dir, "orders")
    if exclude_status is not None:
        o = o.filter(~F.col("o_orderstatus").isin(_codes_for(WORK_ORDER_STATUS, exclude_status))
                     & F.col("o_orderstatus").isin([c for c, _ in WORK_ORDER_STATUS]))
    return o.select(
        F.col("o_orderkey").alias("work_order_id"),
        F.col("o_custkey").alias("machine_id"),
        _code_map("o_orderpriority", TICKET_PRIORITY, TICKET_PRIORITY_DEFAULT).alias("priority"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("title"),
        F.col("o_orderpriority").alias("description"),
        # orders of unspecified priority have no assignee yet (an empty string, as a form
        # sends it); the others go to the technician of their priority level
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(""))
         .otherwise(F.concat(F.lit("tech-"), F.substring("o_orderpriority", 1, 1)))
         .alias("assigned_to"),
        # a date-like column kept as a timestamp at midnight, as the analytical tables do
        F.date_add(F.to_date("o_orderdate"), 30).cast("timestamp_ntz").alias("due_date"),
        _code_map("o_orderstatus", WORK_ORDER_STATUS, None).alias("status"),
        F.col("o_orderdate").alias("created_at"))


def actions(spark: SparkSession, sf_dir: str, status_value: str | None = None) -> DataFrame:
    """maintenance_actions from lineitem, without the machine (no join).

    (ticket_id, performed_at, line_no, amount) is the unique key; ``line_no`` and ``amount``
    are the tie-breakers of every newest-first order.
    """
    return actions_of(table(spark, sf_dir, "lineitem"), status_value)


def actions_of(li: DataFrame, status_value: str | None = None) -> DataFrame:
    """The actions projection of a lineitem-shaped frame (batch or streaming)."""
    if status_value is not None:
        li = li.filter(F.col("l_linestatus").isin(_codes_for(ACTION_STATUS, status_value)))
    status = _code_map("l_linestatus", ACTION_STATUS, None)
    return li.select(
        F.col("l_orderkey").alias("ticket_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_extendedprice").alias("amount"),
        _code_map("l_returnflag", ACTION_TYPE, None).alias("action_type"),
        F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("description"),
        F.concat(F.lit("tech-"), F.col("l_suppkey").cast("string")).alias("performed_by"),
        F.col("l_shipdate").alias("performed_at"),
        status.alias("status"),
        F.when(F.col("l_linestatus") == "F", F.col("l_shipdate")).alias("completed_at"))


def ticket_machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ticket_id -> machine_id (unique key)."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ticket_id"), F.col("o_custkey").alias("machine_id"))


def actions_with_machine(spark: SparkSession, sf_dir: str, status_value: str | None = None
                         ) -> DataFrame:
    """Actions plus ``machine_id`` = the customer of the action's order (key join)."""
    return actions(spark, sf_dir, status_value).join(ticket_machines(spark, sf_dir),
                                                     "ticket_id")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sensor_readings(reading_id, machine_id, ts, vibration, temperature) from events."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("reading_id"),
        F.col("user_id").alias("machine_id"),
        F.col("ts"),
        F.col("value").alias("vibration"),
        F.get_json_object("props", "$.k").cast("int").alias("temperature"))


def quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """quality_checks(check_id, order_id, machine_id, check_type, result, defect_code, notes,
    inspector, checked_at) from events (one check per event; order_id = event_id)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("check_id"),
        F.col("event_id").alias("order_id"),
        F.col("user_id").alias("machine_id"),
        F.col("event_type").alias("check_type"),
        F.when(F.col("value") > 50, "fail").otherwise("pass").alias("result"),
        F.when(F.col("value") > 50, F.concat(F.lit("VIB-"), F.col("user_id").cast("string")))
         .alias("defect_code"),
        F.col("props").alias("notes"),
        F.concat(F.lit("qa-"), F.col("event_type")).alias("inspector"),
        F.col("ts").alias("checked_at"))


def operator_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """operator_notes from lineitem; ``machine_id`` = l_partkey, which has keys with no
    machine, so the left join of the notes feed is exercised."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_partkey").alias("machine_id"),
        _code_map("l_returnflag", NOTE_TYPE, None).alias("note_type"),
        F.concat(F.lit("qty "), F.col("l_quantity").cast("string")).alias("content"),
        F.concat(F.lit("op-"), F.col("l_suppkey").cast("string")).alias("created_by"),
        F.col("l_shipdate").alias("created_at"))


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history table (row log) from events: key ``entity_id``, payload ``value``/``props``
    and the three change columns."""
    return change_log_of(table(spark, sf_dir, "events"))


def change_log_of(events: DataFrame) -> DataFrame:
    """The change-log projection of an events-shaped frame (batch or streaming)."""
    return events.select(
        F.col("user_id").alias("entity_id"),
        F.col("value"),
        F.col("props"),
        _code_map("event_type", CHANGE_TYPE, None).alias("_change_type"),
        F.col("event_id").alias("_commit_version"),
        F.col("ts").alias("_commit_timestamp"))


def action_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history of maintenance actions with preimages, superseded rows and deletes, from
    events: key ``action_id`` (the user), one ticket an event."""
    e = table(spark, sf_dir, "events")
    done = F.col("value") > 25
    return e.select(
        F.col("user_id").alias("action_id"), F.col("event_id").alias("ticket_id"),
        F.col("user_id").alias("machine_id"),
        F.concat(F.lit("tech-"), F.col("event_type")).alias("performed_by"),
        F.col("event_type").alias("action_type"), F.col("props").alias("description"),
        F.when(done, "completed").otherwise("in_progress").alias("status"),
        F.when(done, F.col("ts")).alias("completed_at"),
        _code_map("event_type", CHANGE_TYPE, None).alias("_change_type"),
        F.col("event_id").alias("_commit_version"), F.col("ts").alias("_commit_timestamp"))


def order_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second history table with a different schema (for the union / audit trail)."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_totalprice").alias("total"),
        F.when(F.col("o_orderstatus") == "O", "insert")
         .when(F.col("o_orderstatus") == "P", "update_postimage")
         .otherwise("delete").alias("_change_type"),
        F.col("o_orderkey").alias("_commit_version"),
        F.col("o_orderdate").alias("_commit_timestamp"))


def snapshot_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two versions of the orders table as a keyed snapshot (old, new).

    old: every order except '5-LOW' ones; new: every order except '4-NOT SPECIFIED' ones,
    and '3-MEDIUM' orders are all closed ('F').  So the diff has inserts (5-LOW), deletes
    (4-NOT SPECIFIED), updates (3-MEDIUM not yet F) and untouched rows.
    """
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "o_orderpriority")
    old = o.filter(F.col("o_orderpriority") != "5-LOW")
    new = (o.filter(F.col("o_orderpriority") != "4-NOT SPECIFIED")
            .withColumn("o_orderstatus",
                        F.when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("F"))
                         .otherwise(F.col("o_orderstatus"))))
    return old, new
