"""Plans of transfers, and running them."""

from ferry.plans.control import every_table, expand_control
from ferry.plans.runner import PlanRefused, ReconcileFailed, Run, TransferFailed, preflight, reconcile_run, run, source_frame
from ferry.plans.transfer import Archive, DatabaseMerge, Plan, Route, Transfer, Upsert

__all__ = [
    "Archive",
    "DatabaseMerge",
    "Plan",
    "PlanRefused",
    "ReconcileFailed",
    "Route",
    "Run",
    "Transfer",
    "TransferFailed",
    "Upsert",
    "every_table",
    "expand_control",
    "preflight",
    "reconcile_run",
    "run",
    "source_frame",
]
