"""Column-level building blocks; every one is a built-in Spark expression."""

from ferry.functions.columns import (
    column,
    comparable,
    day_of,
    fingerprint,
    predicate,
    quoted_names,
    rendered,
)
from ferry.functions.credentials import CREDENTIAL_FIELDS, redact, strip_url, without_credentials

__all__ = [
    "CREDENTIAL_FIELDS",
    "column",
    "comparable",
    "day_of",
    "fingerprint",
    "predicate",
    "quoted_names",
    "redact",
    "rendered",
    "strip_url",
    "without_credentials",
]
