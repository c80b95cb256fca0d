"""History analytics: time-to-fix (Q7 faithful, Q8 net), actions per day, average
time-to-fix per model (Q10)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyloop.functions.rows import status_is
from keyloop.operators.history import current_state
from keyloop.operators.keyed import join_dim


def hours_between(start: str | Column, end: str | Column) -> Column:
    """round((unix(end) - unix(start)) / 3600.0, 1) as a double; unix_timestamp truncates to
    seconds, the rounding is half-up; negative values are kept."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    diff = F.unix_timestamp(e) - F.unix_timestamp(s)
    # In SQL, 3600.0 is a decimal literal.  Double division rounds identically here: for an
    # integral number of seconds n, n/3600 is either exactly k/20 (which Spark's half-up
    # round of a double sees as its shortest decimal form, exactly k/20) or at least 1/3600
    # away from any rounding boundary, far beyond double error.  Doubles stay in generated
    # code; the wide decimal quotient would use BigDecimal arithmetic per row.
    return F.round(diff / F.lit(3600.0), 1)


def time_to_fix(history: DataFrame, machines: DataFrame, tickets: DataFrame,
                keys: Sequence[str] = ("ticket_id", "line_no"), ordered: bool = True,
                machine_from_ticket: bool = False) -> DataFrame:
    """Q7 / T1 (faithful): every history row whose status is completed (whatever its change
    type), inner-joined to its machine and left-joined to its ticket; hours_to_fix is null
    when the ticket or completed_at is missing.

    ``machine_from_ticket``: the history has no machine, its ticket's is used.  The ticket is
    joined once for both, straight from the scan of the history, so adaptive execution can
    split a ticket with very many actions."""
    h = history.filter(status_is("status", "completed"))
    models = machines.select("machine_id", "model")
    if machine_from_ticket:
        h = h.join(tickets.select("ticket_id", "machine_id", "opened_at"), "ticket_id", "left")
        j = join_dim(h, models, "machine_id")
    else:
        j = join_dim(h, models, "machine_id").join(
            tickets.select("ticket_id", "opened_at"), "ticket_id", "left")
    out = j.select(*keys, "machine_id", "model", "performed_by", "action_type", "description",
                   hours_between("opened_at", "completed_at").alias("hours_to_fix"),
                   "completed_at")
    if ordered:
        out = out.orderBy(F.desc("completed_at"), *[F.desc(k) for k in keys])
    return out.drop("completed_at")


def time_to_fix_net(history: DataFrame, machines: DataFrame, tickets: DataFrame,
                    pk: Sequence[str], order: Sequence[str], tie: Sequence[str] = (),
                    keys: Sequence[str] = ("ticket_id", "line_no"), ordered: bool = True,
                    machine_from_ticket: bool = False) -> DataFrame:
    """Q8 (corrected metric): Q7 over the net state of the history (preimages, superseded
    and deleted rows removed).  The net state comes before any join, so its limit per key
    runs map-side."""
    net = current_state(history, pk, order, tie)
    return time_to_fix(net, machines, tickets, keys, ordered, machine_from_ticket)


def actions_per_day(actions: DataFrame, ts: str = "completed_at") -> DataFrame:
    """A3: number of actions per day of completion; a null day is excluded.  The day is the
    wall-clock midnight (``to_date`` of a timestamp_ntz does not depend on the session zone,
    unlike ``date_trunc``, which returns a zoned timestamp)."""
    day = F.to_date(F.col(ts)).cast("timestamp_ntz")
    return (actions.filter(F.col(ts).isNotNull())
                   .groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n_actions")))


def avg_fix_by_model(fixes: DataFrame) -> DataFrame:
    """A4: average hours_to_fix per model (nulls ignored, as avg does)."""
    return fixes.groupBy("model").agg(
        F.round(F.avg("hours_to_fix"), 4).alias("avg_hours_to_fix"),
        F.count("hours_to_fix").alias("n_fixes"))
