"""Writing the next version of a master table kept as files."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from ferry.functions.columns import column
from ferry.operators.upserts import upsert, upsert_all
from ferry.sinks.landing import Landing, land
from ferry.sources import files
from ferry.sources.lake import Lake
from ferry.sources.scans import read_files


def land_master(
    master: DataFrame | None,
    staged: Sequence[DataFrame],
    lake: Lake,
    name: str,
    keys: Sequence[str],
    *,
    run_id: str | None = None,
    **how,
) -> Landing:
    """Merge staged tables, oldest first, and land the whole result beside the current version."""
    versions = replace(lake, snapshots=True, write_mode="overwrite")
    return land(upsert_all(master, staged, keys, **how), versions, name, run_id=run_id)


def land_partitions(
    spark: SparkSession,
    staged: Sequence[DataFrame],
    lake: Lake,
    name: str,
    keys: Sequence[str],
    partition: str,
    *,
    run_id: str | None = None,
    **how,
) -> Landing:
    """Merge staged tables into a master partitioned by a column that is part of its key.

    Only partitions that staged rows fall into are read and replaced, each as a whole when the
    job commits. A run that is cut off there may leave some replaced and others not; running
    it again with the same rows ends in the same master.
    """
    if partition not in keys:
        raise ValueError(f"{partition} must be part of the key, or matches could be elsewhere")
    merged = upsert_all(None, staged, keys, **how)
    fixed = replace(lake, snapshots=False, write_mode="overwrite")
    master = None
    if files.exists(spark, fixed.path(name)):
        # As many values as there are directories to replace.
        touched = [r[0] for r in merged.select(column(partition)).distinct().toLocalIterator()]
        hit = column(partition).isin([v for v in touched if v is not None])
        if None in touched:
            hit = hit | column(partition).isNull()
        master = read_files(spark, fixed, fixed.path(name), merged.schema).where(hit)
    how = how | {"check_unique": False, "order_by": None}
    return land(upsert(master, merged, keys, **how), fixed, name, bucket=partition, run_id=run_id)
