"""Planning the tasks that write a table partitioned by a column, from one histogram of that column.

A task that writes many small partitions spends its time opening files, one that writes a large partition spends it
writing. So a partition weighs its bytes and one file; those that outgrow a task are cut, and all pieces are dealt
to as many tasks as there are cores, the heaviest first, each to the task that has least to do so far.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from heapq import heapify, heapreplace
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ferry.functions.columns import column, comparable

#: Opening, closing and committing a file takes about as long as writing so many bytes.
FILE_BYTES = 4 << 20


@dataclass(frozen=True)
class Tasks:
    """How many tasks write, and which of them each partition goes to, by the hash of its value."""

    number: int
    of: dict[int, list[int]]


def plan(rows: Iterable[tuple[int, int]], row_bytes: int, cores: int, task_bytes: int) -> Tasks:
    """Tasks for partitions of so many rows each, given as (hash, rows)."""
    pieces = []
    for key, n in rows:
        cut = max(1, ceil(n * row_bytes / task_bytes))
        pieces += [(n * row_bytes / cut + FILE_BYTES, key)] * cut
    whole = sum(weight - FILE_BYTES for weight, _ in pieces)
    number = max(1, min(cores, len(pieces)), ceil(whole / task_bytes))
    loads = [(0.0, task) for task in range(number)]
    heapify(loads)
    of: dict[int, list[int]] = {}
    for weight, key in sorted(pieces, reverse=True):
        load, task = loads[0]
        heapreplace(loads, (load + weight, task))
        of.setdefault(key, []).append(task)
    return Tasks(number, of)


def by_partition(df: DataFrame, name: str, task_bytes: int | None = None) -> DataFrame:
    """The rows of ``df``, dealt to tasks that write partitions by the column ``name``.

    The column is read once more than the rows are, to be counted. A count per partition comes to the driver, which
    lists them all again when the write is committed. Values that turn up only in the second reading go by their hash.
    """
    spark, key = df.sparkSession, F.xxhash64(column(name))
    counts = df.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("rows")).collect()
    tasks = plan(counts, row_bytes(df), spark.sparkContext.defaultParallelism, task_bytes or target_bytes(spark))
    # A row per partition, a few numbers each.
    dealt = spark.createDataFrame(list(tasks.of.items()), "__key long, __tasks array<int>")
    joined = df.join(F.broadcast(dealt), key == F.col("__key"), "left")
    piece = F.get(F.col("__tasks"), F.pmod(_any_row(df), F.size("__tasks")).cast("int"))
    task = F.coalesce(piece, F.pmod(key, F.lit(tasks.number)).cast("int"))
    return joined.repartitionById(tasks.number, task).drop("__key", "__tasks")


def _any_row(df: DataFrame) -> Column:
    """A number that tells rows apart, as far as they differ."""
    return F.xxhash64(*[column(f.name) for f in df.schema.fields if comparable(f.dataType)])


def row_bytes(df: DataFrame) -> int:
    """What Spark takes a row of these types to be."""
    return max(1, df._jdf.schema().defaultSize())


def target_bytes(spark: SparkSession) -> int:
    """What a task should write: the size that adaptive execution aims at."""
    said = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64MB")
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(said)
