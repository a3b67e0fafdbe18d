"""Shaping a scan for an archive: constraints and the day bucket."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from ferry.functions.columns import column, day_of, predicate
from ferry.sinks.landing import BUCKET


def constrain(df: DataFrame, constraints: Iterable[str]) -> DataFrame:
    """Keep rows that satisfy every constraint; no constraints keep every row.

    Each constraint is an expression of its own, so an OR inside one stays inside it.
    Catalyst joins them into one filter and pushes it into the scan.
    """
    for text in constraints:
        df = df.where(predicate(text, df.columns))
    return df


def day_bucket(
    df: DataFrame, name: str, fmt: str | None = None, bucket: str = BUCKET, lenient: bool = False
) -> DataFrame:
    """Append the day of a date, timestamp or text column."""
    if bucket.lower() in (c.lower() for c in df.columns):
        raise ValueError(f"the table already has a column {bucket}")
    dtype = df.select(column(name)).schema[0].dataType
    return df.withColumn(bucket, day_of(name, dtype, fmt, lenient))
