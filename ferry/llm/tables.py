"""What the operators share: checked columns, hidden names, and written intermediate tables."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from ferry.workspace import scratch

#: White space of all operators on words: `[\x20\x09-\x0D]`.
SPACE = " \t\n\x0b\x0c\r"

#: Rows that may be broadcast. Beyond that the same join is done by a shuffle.
BROADCAST_ROWS = 2_000_000

#: What workers remember from task to task, by operator.
CACHES: dict[str, dict] = {}


def forget_others(owner: str) -> None:
    """Empty what other operators left in this worker: workers go on from stage to stage, and memories would add up."""
    left = [cache for name, cache in CACHES.items() if name != owner and cache]
    for cache in left:
        cache.clear()
    if left:
        pa.default_memory_pool().release_unused()


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str, **options: str) -> DataFrame:
    """The frame as a Parquet table below the shared folder: cut lineage that survives lost executors."""
    path = scratch(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast what was counted and found small; otherwise leave the join to a shuffle."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; an absent id counts as the empty text."""
    return F.crc32(F.encode(F.coalesce(F.col(column).cast("string"), F.lit("")), "UTF-8")) % modulus


def with_results(df: DataFrame, inputs: dict[str, Column], fn, fields: str) -> DataFrame:
    """Every row as the struct ``row``, beside what ``fn`` makes of the inputs, one Arrow batch at a time.

    ``fn`` gets a batch of the inputs and returns the arrays of ``fields`` (a DDL string). Rows pass
    through untouched, so columns of any name do.
    """
    row = F.struct(*(df[f"`{c}`"] for c in df.columns)).alias("row")
    narrow = df.select(row, F.struct(*(c.alias(k) for k, c in inputs.items())).alias("inputs"))
    made = StructType.fromDDL(fields)
    names = ["row", *made.names]

    def batches(it):
        for batch in it:
            given = pa.RecordBatch.from_struct_array(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), *fn(given)], names=names)

    schema = StructType([StructField("row", narrow.schema["row"].dataType), *made.fields])
    return narrow.mapInArrow(batches, schema)


def total(df: DataFrame, column: Column) -> int:
    return int(df.agg(F.coalesce(F.sum(column), F.lit(0))).first()[0])
