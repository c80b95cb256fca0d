"""keyloop: keyed snapshots, work queues and change-history algebra on Spark DataFrames.

The most used entry points, re-exported::

    from keyloop import latest_per_key, open_alerts, current_state, diff_snapshots
"""

from keyloop.operators.history import (apply_changes, as_of, audit_trail, current_state,
                                       diff_snapshots, history_read, read_changes,
                                       union_histories, validity_intervals)
from keyloop.operators.keyed import (compare_keys, join_dim, latest_per_key, top_k,
                                     without_match)
from keyloop.operators.writes import (assign_keys, delete_where, insert_rows, update_where,
                                      validate_rows)
from keyloop.plans.metrics import actions_per_day, avg_fix_by_model, time_to_fix, time_to_fix_net
from keyloop.plans.queues import (open_alert_count, open_alerts, open_work_orders,
                                  queue_counters, recent_actions, recent_notes,
                                  recent_quality_checks)
from keyloop.plans.sync import reconcile, snapshot_sync, table_counts, triggered_sync
from keyloop.streaming.state import KeyedState, continuous_sync

__version__ = "0.1.0"

__all__ = [
    "KeyedState", "actions_per_day", "apply_changes", "as_of", "assign_keys", "audit_trail",
    "avg_fix_by_model", "compare_keys", "continuous_sync", "current_state", "delete_where",
    "diff_snapshots", "history_read", "insert_rows", "join_dim", "latest_per_key",
    "open_alert_count", "open_alerts", "open_work_orders", "queue_counters", "read_changes",
    "recent_actions", "recent_notes", "recent_quality_checks", "reconcile", "snapshot_sync",
    "table_counts", "time_to_fix", "time_to_fix_net", "top_k", "triggered_sync",
    "union_histories", "update_where", "validate_rows", "validity_intervals", "without_match",
]
