"""Registered queries: each runs an operator over whole tables, next to the SQL it must equal."""

from queries import archives, databases, files, logs, masters, reconciles, recoveries, runs, upserts  # noqa: F401
from queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
