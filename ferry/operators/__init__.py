"""Operators over DataFrames; all lazy but for the few that say otherwise."""

from ferry.operators.activity import ActivityLog, activity_status, read_events
from ferry.operators.preflight import missing_lakes, problems, profile, writable
from ferry.operators.reconciling import (
    align,
    reconcile,
    reconcile_appended,
    reconcile_cells,
    reconcile_rows,
    rows_if_equal,
)
from ferry.operators.shape import constrain, day_bucket
from ferry.operators.upserts import DuplicateKeys, latest, upsert, upsert_all

__all__ = [
    "ActivityLog",
    "DuplicateKeys",
    "activity_status",
    "align",
    "constrain",
    "day_bucket",
    "latest",
    "missing_lakes",
    "problems",
    "profile",
    "read_events",
    "reconcile",
    "reconcile_appended",
    "reconcile_cells",
    "reconcile_rows",
    "rows_if_equal",
    "upsert",
    "upsert_all",
    "writable",
]
