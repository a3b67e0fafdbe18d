"""Versions of a master that share files: only files that can hold a staged key are written again.

A master is kept in so many files by the hash of its key, one file each. Its versions are run directories; a version has the
files that were written for it, and a manifest that names these and those it shares with versions before. A staged
row can only match in the file of its own hash, so files without a staged row are neither read nor written.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass, replace
from math import ceil
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ferry.functions.columns import column
from ferry.operators.upserts import upsert, upsert_all
from ferry.sinks.days import row_bytes
from ferry.sinks.landing import Landing, land
from ferry.sources import files
from ferry.sources.lake import Lake, join_uri
from ferry.sources.scans import MANIFEST, read_files

#: About what a file of a master holds; there are as many files as cores at least, and more once they hold four times as much.
FILE_BYTES = 128 << 20
_GROWN = 4
_UNMARKED = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}
_PART = re.compile(r"part-(\d+)-")


@dataclass(frozen=True)
class Manifest:
    """What a version is made of: by number, the files below the master's directory."""

    keys: list[str]
    buckets: int
    rows: int
    files: dict[int, list[str]]

    @classmethod
    def of(cls, spark: SparkSession, version: str) -> Manifest | None:
        place = join_uri(version, MANIFEST)
        if not files.exists(spark, place):
            return None
        said = json.loads(files.read_text(spark, place))
        return cls(said["keys"], said["buckets"], said["rows"], {int(k): v for k, v in said["files"].items()})

    def text(self) -> str:
        every = [f for of in self.files.values() for f in of]
        return json.dumps({"keys": self.keys, "buckets": self.buckets, "rows": self.rows, "files": self.files, "paths": every})


def bucket(keys: Sequence[str], buckets: int) -> Column:
    """The number of the file that a key is in; null keys match nothing, and are somewhere."""
    return F.pmod(F.xxhash64(*[column(k) for k in keys]), F.lit(buckets)).cast("int")


def land_version(
    spark: SparkSession,
    current: tuple[str, T.StructType | None] | None,
    staged: Sequence[DataFrame],
    lake: Lake,
    name: str,
    keys: Sequence[str],
    *,
    run_id: str,
    schema: T.StructType,
    number: int | None = None,
    **how: Any,
) -> Landing:
    """Merge staged tables, oldest first, into the version ``current`` (place and types) and land the next one beside it.

    ``schema`` is what a version of unknown types is read with. A version without a manifest, with other
    keys, or whose files have outgrown their size, is written whole, into ``number`` files or as many as its size asks for.
    """
    merged = upsert_all(None, staged, keys, **how)
    versions = replace(lake, snapshots=True, write_mode="overwrite", options={**lake.options, **_UNMARKED})
    place, types = current or (None, None)
    schema = types or schema
    before = Manifest.of(spark, place) if place else None
    table = lake.path(name)
    grown = before and before.rows * row_bytes(merged) > _GROWN * FILE_BYTES * before.buckets
    shared: dict[int, list[str]] = {}
    if before and before.keys == list(keys) and not (grown and number is None) and number in (None, before.buckets):
        buckets = before.buckets
        touched = {r[0] for r in merged.select(bucket(keys, buckets)).distinct().collect()}
        shared = {b: of for b, of in before.files.items() if b not in touched}
        hit = [join_uri(table, f) for b in sorted(touched) for f in before.files.get(b, [])]
        master = read_files(spark, lake, hit, schema) if hit else None
        kept = before.rows - (master.count() if master is not None else 0)
    else:
        master = read_files(spark, lake, place, schema) if place else None
        rows = sum(frame.count() for frame in [*staged, *([master] if master is not None else [])])
        buckets = number or max(spark.sparkContext.defaultParallelism, ceil(rows * row_bytes(merged) / FILE_BYTES))
        kept = 0
    how = how | {"check_unique": False, "order_by": None}
    whole = upsert(master, merged, keys, **how) if master is not None else merged
    landing = land(whole.repartitionById(buckets, bucket(keys, buckets)), versions, name, run_id=run_id)
    made: dict[int, list[str]] = {}
    for path in files.children(spark, landing.path):
        part = path.rsplit("/", 1)[-1]
        number_of = int(_PART.match(part)[1])
        # The first task leaves an empty file if it has no rows.
        if number_of not in shared:
            made.setdefault(number_of, []).append(f"{files.RUN}{run_id}/{part}")
    manifest = Manifest(list(keys), buckets, kept + landing.rows, {**shared, **made})
    files.write_text(spark, join_uri(landing.path, MANIFEST), manifest.text())
    # Only now is the version complete for readers.
    files.write_text(spark, join_uri(landing.path, "_SUCCESS"), "")
    return replace(landing, rows=manifest.rows)
