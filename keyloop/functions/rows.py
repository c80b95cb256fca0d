"""Row rules as Column expressions (built-ins only, so they stay inside whole-stage codegen).

Every helper takes column names (or Columns) and returns a Column; none of them collects.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two severity orders of the reference.  The queue ranks high 0, medium 1
# and everything else 2 (so 'critical' ranks with 'low'); work orders rank critical 0,
# high 1, medium 2, everything else 3.
QUEUE_SEVERITY = {"high": 0, "medium": 1}
QUEUE_SEVERITY_DEFAULT = 2
WORK_ORDER_SEVERITY = {"critical": 0, "high": 1, "medium": 2}
WORK_ORDER_SEVERITY_DEFAULT = 3

# The only priorities the queue filter accepts; anything else (including
# 'critical') means "no filter".
QUEUE_FILTER_PRIORITIES = ("high", "medium", "low")


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def severity_rank(col: str | Column, order: Mapping[str, int] = QUEUE_SEVERITY,
                  default: int = QUEUE_SEVERITY_DEFAULT) -> Column:
    """CASE col WHEN v THEN rank ... ELSE default END (null ranks as default)."""
    c = _c(col)
    expr = None
    for value, rank in order.items():
        expr = (F.when(c == value, F.lit(rank)) if expr is None
                else expr.when(c == value, F.lit(rank)))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def status_is(col: str | Column, value: str) -> Column:
    """col = value (null is not a match)."""
    return _c(col) == F.lit(value)


def status_not(col: str | Column, value: str) -> Column:
    """Col <> value; a null status is dropped, as in SQL."""
    return _c(col) != F.lit(value)


def not_in_state(col: str | Column, value: str) -> Column:
    """P5: col IS NULL OR col <> value (null-keeping)."""
    return ~_c(col).eqNullSafe(F.lit(value))


def completed_at_rule(status: str | Column, now: Column, done: str = "completed") -> Column:
    """The completion time is ``now`` when the status is completed, else null."""
    return F.when(_c(status) == done, now)


def empty_to_null(col: str | Column) -> Column:
    """Only the empty string becomes null (blanks are kept)."""
    return F.nullif(_c(col), F.lit(""))


def default_status(assignee: str | Column, assigned: str = "assigned",
                   unassigned: str = "open") -> Column:
    """P10: 'assigned' when an assignee is given (non-empty), else 'open'."""
    return F.when(F.coalesce(_c(assignee), F.lit("")) != "", assigned).otherwise(unassigned)


def default_now(col: str | Column, now: Column) -> Column:
    """Fill a missing timestamp with ``now`` (used for absent columns)."""
    return F.coalesce(_c(col), now)


def machine_label(machine_id: str | Column, model: str | Column,
                  line: str | Column) -> Column:
    """P13: '#id · model (line)', or '#id' when the machine is unknown (null model)."""
    mid = _c(machine_id).cast("string")
    full = F.concat(F.lit("#"), mid, F.lit(" · "), _c(model), F.lit(" ("),
                    _c(line).cast("string"), F.lit(")"))
    return F.coalesce(full, F.concat(F.lit("#"), mid))


def user_slug(email: str | Column) -> Column:
    """Local part of the address, lower-cased, with every char outside [a-z0-9] removed."""
    local = F.substring_index(_c(email), "@", 1)
    return F.regexp_replace(F.lower(local), "[^a-z0-9]", "")


def short_name(email: str | Column) -> Column:
    """The part before '@', or the whole value when that part is empty."""
    local = F.substring_index(_c(email), "@", 1)
    return F.when(local == "", _c(email)).otherwise(local)


def all_of(conditions: Sequence[Column]) -> Column:
    """AND of the conditions (true for none)."""
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def threshold_filter(bounds: Mapping[str, float]) -> Column:
    """Every ``col > bound`` on the same row (strict)."""
    return all_of([F.col(c) > F.lit(b) for c, b in bounds.items()])
