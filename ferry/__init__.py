"""Moving tables between lakes with Spark: extract, archive by day, upsert, reconcile."""

from ferry.operators import (
    ActivityLog,
    activity_status,
    constrain,
    day_bucket,
    reconcile,
    reconcile_cells,
    upsert,
    upsert_all,
)
from ferry.plans import Archive, DatabaseMerge, Plan, Route, Transfer, Upsert, expand_control, run
from ferry.sinks import land, read_landing
from ferry.sources import Lake, scan

__all__ = [
    "ActivityLog",
    "Archive",
    "DatabaseMerge",
    "Lake",
    "Plan",
    "Route",
    "Transfer",
    "Upsert",
    "activity_status",
    "constrain",
    "day_bucket",
    "expand_control",
    "land",
    "read_landing",
    "reconcile",
    "reconcile_cells",
    "run",
    "scan",
    "upsert",
    "upsert_all",
]
