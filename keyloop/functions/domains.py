"""Value domains of the operational tables, for ``validate_rows``.

The reference states them twice, in DDL comments and in the app's pick-lists, and the two
sources disagree (action status 'failed' vs 'cancelled', note type 'observation' vs
'general'), so both are kept and the caller chooses.
"""

# Domains as listed by the table DDL comments.
DDL = {
    "action_type": ("preventive", "corrective", "inspection"),
    "action_status": ("in_progress", "completed", "failed"),
    "work_order_priority": ("low", "medium", "high", "critical"),
    "work_order_status": ("open", "assigned", "in_progress", "closed"),
    "check_type": ("dimensional", "functional", "visual"),
    "check_result": ("pass", "fail", "conditional"),
    "note_type": ("alert", "handoff", "resolution", "observation"),
}

# Domains as offered by the app's forms.
APP = {
    "action_type": ("corrective", "preventive", "inspection"),
    "action_status": ("in_progress", "completed", "cancelled"),
    "work_order_priority": ("low", "medium", "high", "critical"),
    "work_order_status": ("open", "assigned", "in_progress", "closed"),
    "check_type": ("visual", "dimensional", "functional"),
    "check_result": ("pass", "fail", "conditional"),
    "note_type": ("general", "alert", "handoff", "resolution"),
}

# Fields the app refuses to save empty.
APP_REQUIRED = {"work_orders": ("title",), "operator_notes": ("content",)}
