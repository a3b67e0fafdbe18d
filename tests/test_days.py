"""Planned write tasks of partitioned tables."""

from __future__ import annotations

from collections import Counter

from conftest import rows
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ferry.sinks import days, land, read_landing

SIZES = st.dictionaries(st.integers(), st.integers(1, 10_000), max_size=60)


@settings(deadline=None)
@given(SIZES, st.integers(1, 200), st.integers(1, 16), st.integers(1 << 14, 1 << 24))
def test_every_partition_has_tasks_and_none_is_overloaded(sizes, row_bytes, cores, task_bytes):
    made = days.plan(sizes.items(), row_bytes, cores, task_bytes)
    assert made.of.keys() == sizes.keys()
    assert all(0 <= t < made.number for tasks in made.of.values() for t in tasks)
    loads = Counter()
    pieces = []
    for key, tasks in made.of.items():
        assert len(tasks) == max(1, -(-sizes[key] * row_bytes // task_bytes))
        each = sizes[key] * row_bytes / len(tasks) + days.FILE_BYTES
        pieces += [each] * len(tasks)
        for t in tasks:
            loads[t] += each
    if pieces:
        # The bound of dealing the heaviest first: an even share and at most one piece more.
        assert max(loads.values()) <= sum(pieces) / made.number + max(pieces) + 1e-6
        assert len(loads) == min(made.number, len(pieces))


def test_many_small_days_go_through_all_tasks(spark, lake):
    df = spark.range(3000).select("id", F.expr("date_add(date'2020-01-01', cast(id % 600 as int))").alias("day"))
    to = lake()
    landing = land(df, to, "t", bucket="day")
    back = read_landing(spark, to, landing)
    assert back.count() == 3000 and back.exceptAll(df.select("id", "day")).isEmpty()
    files = back.select("day", F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).alias("task")).distinct()
    per_task = [r["count"] for r in files.groupBy("task").count().collect()]
    assert sum(per_task) == 600 and len(per_task) == 4 and max(per_task) <= 151


def test_a_hot_day_is_cut_and_nulls_are_days_too(spark, lake, monkeypatch):
    monkeypatch.setattr(days, "target_bytes", lambda spark: 12 * 500)
    hot = F.when(F.col("id") < 4000, "hot").when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id").cast("string"))
    df = spark.range(4050).select("id", hot.alias("day"))
    to = lake()
    back = read_landing(spark, to, land(df, to, "t", bucket="day"))
    assert rows(back) == rows(df)
    files = back.groupBy("day").agg(F.count_distinct(F.col("_metadata.file_name")).alias("files"))
    by_day = {r["day"]: r["files"] for r in files.collect()}
    assert by_day.pop("hot") > 8 and set(by_day.values()) == {1}


def test_rows_that_are_costly_to_compute_are_computed_once(spark, lake):
    seen = spark.sparkContext.accumulator(0)

    def count(x: int) -> int:
        seen.add(1)
        return x

    df = spark.range(50).groupBy((F.col("id") % 5).alias("day")).agg(F.sum("id").alias("id"))
    df = df.select("day", F.udf(count, "long")("id").alias("id"))
    to = lake()
    back = read_landing(spark, to, land(df, to, "t", bucket="day"))
    assert back.count() == 5 and seen.value == 5


def test_empty_table(spark, lake):
    to = lake()
    landing = land(spark.range(0).withColumn("day", F.lit("x")), to, "t", bucket="day")
    assert landing.rows == 0
