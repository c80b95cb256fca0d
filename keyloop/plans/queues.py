"""Work queues and feeds over the operational roles (Q1-Q6, Q9, Q11).

Every function takes DataFrames and column presets and returns a lazy DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyloop.functions.rows import (QUEUE_FILTER_PRIORITIES, QUEUE_SEVERITY,
                                    QUEUE_SEVERITY_DEFAULT, WORK_ORDER_SEVERITY,
                                    WORK_ORDER_SEVERITY_DEFAULT, not_in_state, severity_rank,
                                    status_is, status_not, threshold_filter)
from keyloop.operators.keyed import (first_k_keys, join_dim, latest_per_key,
                                     overwrite_first_k, reduce_to_keys, top_k,
                                     top_k_through_joins, without_match)


def alert_order(sort: str) -> list[Column]:
    """O1: the queue orders; an unknown name falls back to 'priority'."""
    presets = {
        "priority": [severity_rank("priority", QUEUE_SEVERITY, QUEUE_SEVERITY_DEFAULT),
                     F.col("opened_at")],
        "oldest": [F.col("opened_at")],
        "machine": [F.col("machine_id"), F.col("opened_at")],
    }
    return presets.get(sort, presets["priority"])


def priority_filter(df: DataFrame, priority: str | None, strict: bool = False) -> DataFrame:
    """Filter only for high / medium / low; anything else (even 'critical') is no filter,
    unless ``strict`` asks for an error."""
    if priority in QUEUE_FILTER_PRIORITIES:
        return df.filter(F.col("priority") == priority)
    if strict and priority is not None:
        raise ValueError(f"unsupported priority filter: {priority!r}")
    return df


def latest_actions(actions: DataFrame, ticket_key: str = "ticket_id",
                   order: str = "performed_at",
                   tie: Sequence[str] = ("line_no", "amount")) -> DataFrame:
    """The newest action per ticket (null ``performed_at`` wins, as in Postgres)."""
    return latest_per_key(actions, ticket_key, order, tie, nulls_first=True)


def open_alerts(tickets: DataFrame, machines: DataFrame, actions: DataFrame,
                sort: str = "priority", priority: str | None = None,
                tie: Sequence[str] = ("line_no", "amount"), ordered: bool = True,
                actions_are_latest: bool = False) -> DataFrame:
    """Q1: open tickets with machine context and their latest action, minus tickets whose
    latest action is completed.

    Plan: the open tickets (predicate pushed to the scan) join the machines (size-checked
    broadcast), then left-join the newest action per ticket.  The window output is already
    hash-partitioned by ticket, so the left join shuffles the ticket side only.
    """
    open_t = priority_filter(tickets.filter(status_is("status", "open")), priority)
    t = join_dim(open_t.select("ticket_id", "machine_id", "priority", "description",
                               "opened_at"),
                 machines.select("machine_id", "model", "line"), "machine_id")
    last = actions.select("ticket_id", "performed_at", "performed_by", "status", *tie)
    # Only the queue's tickets need their latest action: when the open-ticket keys are
    # provably small, a broadcast semi join drops the other actions map-side.  (The keys are
    # taken before the machine join, whose size estimate would be the product of its sides.)
    last = reduce_to_keys(last, open_t, "ticket_id")
    if not actions_are_latest:   # e.g. a maintained latest-action state is already one per key
        last = latest_actions(last, tie=tie)
    last = last.select("ticket_id", F.col("performed_by").alias("actioned_by"),
                       F.col("status").alias("action_status"))
    q = (t.join(last, "ticket_id", "left")
          .filter(not_in_state("action_status", "completed")))
    out = q.select("ticket_id", "machine_id", "model", "line", "priority", "description",
                   "actioned_by", "action_status", "opened_at")
    if ordered:
        out = out.orderBy(*alert_order(sort), F.col("ticket_id"))
    return out.drop("opened_at")


def open_alert_tickets_no_completion(tickets: DataFrame, machines: DataFrame,
                                     actions: DataFrame) -> DataFrame:
    """Q9 list form (J4): open tickets (with a known machine) that have no completed action
    at all.  A subset of ``open_alerts``."""
    open_t = tickets.filter(status_is("status", "open"))
    t = join_dim(open_t.select("ticket_id", "machine_id", "priority"),
                 machines.select("machine_id"), "machine_id")
    done = actions.filter(status_is("status", "completed")).select("ticket_id")
    done = reduce_to_keys(done, open_t, "ticket_id")   # only open tickets can be excluded
    return without_match(t, done, "ticket_id")


def open_alert_count(tickets: DataFrame, machines: DataFrame, actions: DataFrame) -> DataFrame:
    """The dashboard counter (one row)."""
    return open_alert_tickets_no_completion(tickets, machines, actions).agg(
        F.count(F.lit(1)).alias("open_alerts"))


def queue_counters(queue: DataFrame, values: Sequence[str] = ("high", "medium", "low"),
                   col: str = "priority") -> DataFrame:
    """A2 / Q11: one row per listed value (present even when 0) plus 'total'.

    A single pass of conditional sums (partial aggregation, one row to the final task),
    unpivoted with ``stack``; values outside the list count in the total only.
    """
    aggs = [F.sum(F.when(F.col(col) == v, 1).otherwise(0)).cast("bigint").alias(f"n{i}")
            for i, v in enumerate(values)]
    one = queue.agg(*aggs, F.count(F.lit(1)).alias("n_total"))
    pairs = ", ".join([f"'{v}', n{i}" for i, v in enumerate(values)] + ["'total', n_total"])
    return one.selectExpr(f"stack({len(values) + 1}, {pairs}) as ({col}, n)")


def recent_actions(actions: DataFrame, machines: DataFrame, k: int = 15,
                   machine_of: DataFrame | None = None) -> DataFrame:
    """Q2: newest k actions with the machine model (inner join drops orphans).

    ``machine_of`` (ticket_id -> machine_id) supplies the machine when the actions do not
    carry it.  The joins run on the newest candidates only (exact, see
    ``top_k_through_joins``)."""
    def joins(a: DataFrame) -> DataFrame:
        if machine_of is not None:
            a = join_dim(a, machine_of, "ticket_id")
        a = join_dim(a, machines.select("machine_id", "model"), "machine_id")
        return a.select("ticket_id", "line_no", "amount", "machine_id", "model",
                        "action_type", "description", "performed_by", "status",
                        "performed_at", "completed_at")
    dims = [machines.select("machine_id", "model")]
    if machine_of is not None:
        dims.append(machine_of)
    return top_k_through_joins(actions, k, "performed_at", ["ticket_id", "line_no", "amount"],
                               joins, dims=dims)


def open_work_orders(work_orders: DataFrame, machines: DataFrame,
                     ordered: bool = True) -> DataFrame:
    """Q3: work orders not closed (a null status is dropped), most urgent first."""
    wo = join_dim(work_orders.filter(status_not("status", "closed")),
                  machines.select("machine_id", "model"), "machine_id")
    out = wo.select("work_order_id", "machine_id", "model", "priority", "title", "description",
                    "assigned_to", "due_date", "status", "created_at")
    if ordered:
        out = out.orderBy(severity_rank("priority", WORK_ORDER_SEVERITY,
                                        WORK_ORDER_SEVERITY_DEFAULT),
                          F.col("created_at"), F.col("work_order_id"))
    return out


def recent_quality_checks(checks: DataFrame, machines: DataFrame, k: int = 15) -> DataFrame:
    """Q4: newest k quality checks with the machine model (joins on the candidates only)."""
    def joins(q: DataFrame) -> DataFrame:
        q = join_dim(q, machines.select("machine_id", "model"), "machine_id")
        return q.select("check_id", "order_id", "machine_id", "model", "check_type", "result",
                        "defect_code", "notes", "inspector", "checked_at")
    return top_k_through_joins(checks, k, "checked_at", ["check_id"], joins,
                               dims=[machines.select("machine_id", "model")])


def recent_notes(notes: DataFrame, machines: DataFrame, k: int = 20,
                 tie: Sequence[str] = ("order_id", "line_no", "amount")) -> DataFrame:
    """Q5: newest k operator notes; the machine is optional.  A left join to a dimension
    keeps every note exactly once, so the newest k are taken before the join."""
    n = top_k(notes, k, "created_at", list(tie))
    n = join_dim(n, machines.select("machine_id", "model"), "machine_id", how="left")
    n = n.select(*tie, "machine_id", "model", "note_type", "content", "created_by",
                 "created_at")
    return top_k(n, k, "created_at", list(tie))


# The text and severity given to the tickets opened for at-risk machines.
AT_RISK_DESCRIPTION = "High vibration + temperature — inspect before failure"


def at_risk_machines(readings: DataFrame, bounds: dict[str, float], k: int = 4,
                     key: str = "machine_id", order: str = "reading_id") -> DataFrame:
    """Q6 part 1 (P2 + A5): machines with a reading above every bound, first k in order of
    their first such reading.  Output (machine_id, first_seen, pos)."""
    return first_k_keys(readings.filter(threshold_filter(bounds)), key, order, k)


def open_risk_tickets(tickets: DataFrame, risky: DataFrame, k: int = 4) -> DataFrame:
    """Q6 part 2 (J5): the i-th at-risk machine overwrites the i-th ticket (by ticket_id) with
    an open, high-priority ticket, so the number of tickets is unchanged."""
    return overwrite_first_k(
        tickets, "ticket_id", "ticket_id", risky,
        {"machine_id": F.col("machine_id"), "priority": F.lit("high"),
         "status": F.lit("open"), "description": F.lit(AT_RISK_DESCRIPTION)}, k)
