"""Names of the operational schema: the per-user slug and the history-table pattern."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from keyloop.functions.rows import user_slug

# History tables are named lb_<table>_history.
HISTORY_PREFIX = "lb_"
HISTORY_SUFFIX = "_history"


def history_table_name(table: str) -> str:
    """The history table of an operational table: lb_<table>_history."""
    return f"{HISTORY_PREFIX}{table}{HISTORY_SUFFIX}"


def is_history_name(col: str | Column, literal_underscores: bool = True) -> Column:
    """``LIKE 'lb_%_history'``.  In LIKE an underscore matches any one character, so the
    plain pattern also accepts e.g. 'lbx..._history'; with ``literal_underscores`` the
    underscores are escaped and must be real underscores."""
    c = F.col(col) if isinstance(col, str) else col
    if literal_underscores:
        return F.like(c, F.lit("lb!_%!_history"), F.lit("!"))
    return c.like("lb_%_history")


def current_user_slug() -> Column:
    """The session user's slug (schema names are derived from it)."""
    return user_slug(F.current_user())
