from __future__ import annotations

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from ferry.operators import DuplicateKeys, latest, upsert, upsert_all
from ferry.sinks import land_partitions, read_landing

SCHEMA = "k int, v int, w string"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_update_ignore_and_set(spark):
    master = frame(spark, [(1, 10, "a"), (2, 20, "b"), (None, 30, "c")])
    staging = frame(spark, [(2, 21, "B"), (3, 31, "C"), (None, 41, "D")])
    new = [(3, 31, "C"), (None, 30, "c"), (None, 41, "D")]
    assert rows(upsert(master, staging, ["k"])) == [(1, 10, "a"), (2, 21, "B"), *new]
    assert rows(upsert(master, staging, ["k"], on_match="ignore")) == [(1, 10, "a"), (2, 20, "b"), *new]
    assert rows(upsert(master, staging, ["k"], set_columns=["v"])) == [(1, 10, "a"), (2, 21, "b"), *new]


def test_set_to_null(spark):
    master, staging = frame(spark, [(1, 10, "a")]), frame(spark, [(1, None, "x")])
    assert rows(upsert(master, staging, ["k"], set_columns=["v"])) == [(1, None, "a")]


def test_composite_keys_with_partial_nulls(spark):
    schema = "a int, b int, v int"
    master = spark.createDataFrame([(1, None, 1), (1, 2, 2)], schema)
    staging = spark.createDataFrame([(1, None, 3), (1, 2, 4)], schema)
    assert rows(upsert(master, staging, ["a", "b"])) == [(1, 2, 4), (1, None, 1), (1, None, 3)]


@pytest.mark.parametrize("mode", ["update", "ignore"])
def test_keys_of_other_types_match(spark, mode):
    master = spark.createDataFrame([(1, 1.5)], "k long, v double")
    staging = spark.createDataFrame([("1", 2), ("2", 3)], "k string, v int")
    merged = upsert(master, staging, ["k"], on_match=mode)
    assert merged.dtypes == master.dtypes
    assert rows(merged) == [(1, 2.0 if mode == "update" else 1.5), (2, 3.0)]


def test_no_master_and_no_staging(spark):
    some, none = frame(spark, [(1, 1, "a")]), frame(spark, [])
    assert rows(upsert(None, some, ["k"])) == rows(some)
    for mode in ("update", "ignore"):
        assert rows(upsert(some, none, ["k"], on_match=mode)) == rows(some)
        assert rows(upsert(none, some, ["k"], on_match=mode)) == rows(some)


def test_duplicate_keys(spark):
    staging = frame(spark, [(1, 1, "a"), (1, 2, "b")])
    for master in (None, frame(spark, [])):
        with pytest.raises(DuplicateKeys, match="2 staged rows"):
            upsert(master, staging, ["k"])
    assert rows(upsert(None, staging, ["k"], order_by=["v"])) == [(1, 2, "b")]
    with pytest.raises(ValueError):
        upsert(None, staging, ["k"], on_match="replace")
    with pytest.raises(ValueError):
        upsert(staging, frame(spark, [(1, 1, "a")]), ["k"], set_columns=["nope"])


def test_latest_settles_ties_and_keeps_maps(spark):
    schema = "k int, t int, m map<string,int>"
    df = spark.createDataFrame([(1, 1, {"a": 1}), (1, 2, {"b": 2}), (None, 1, None)], schema)
    assert rows(latest(df, ["k"], ["t"])) == [(1, 2, {"b": 2}), (None, 1, None)]
    tied = frame(spark, [(1, 1, "a"), (1, 1, "b")])
    assert rows(latest(tied, ["k"], ["v"])) == [(1, 1, "b")]


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_hot_and_null_keys_merge_whole(spark, broadcast):
    """A third of the master has one key, another third has none."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        i = F.col("id")
        key = F.when(i % 3 == 0, 7).when(i % 3 == 1, None).otherwise(i).cast("long")
        master = spark.range(9000).select(key.alias("k"), i.alias("v"))
        staging = spark.createDataFrame([(7, -1), (10_000, -2)], "k long, v long")
        merged = upsert(master, staging, ["k"]).cache()
        assert merged.where("k is null").count() == 3000
        assert rows(merged.where("v < 0")) == [(10_000, -2), (7, -1)]
        assert merged.count() == 3000 + master.where("k is not null and k <> 7").count() + 2
        merged.unpersist()
        kept = upsert(master, staging, ["k"], on_match="ignore")
        assert kept.count() == 9001
        changed = upsert(master, staging, ["k"], set_columns=["v"])
        assert changed.where("k = 7 and v = -1").count() == master.where("k = 7").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_null_keys_are_shuffled_apart(spark):
    from ferry.operators.upserts import _spread_nulls

    df = spark.range(1000).select(F.lit(None).cast("long").alias("k"), F.col("id").alias("v"))
    spread = _spread_nulls(df, ["k"]).repartition(4, "k", "__spread")
    sizes = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 400


def test_the_spread_stays_a_join_key(spark, capsys):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = frame(spark, [(1, 1, "a")])
        upsert(df, df, ["k"]).explain()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    plan = capsys.readouterr().out
    assert "hashpartitioning(k" in plan and "__spread" in plan.split("hashpartitioning(k")[1][:30]


def merged_in_python(master, staging, mode, columns):
    held = {k: (k, v, w) for k, v, w in master}
    for k, v, w in staging:
        if k not in held:
            held[k] = (k, v, w)
        elif mode == "update":
            held[k] = (k, v, held[k][2]) if columns else (k, v, w)
    return sorted(held.values(), key=repr)


table = st.lists(
    st.tuples(st.integers(0, 5), st.integers(0, 9), st.sampled_from("xyz")), unique_by=lambda r: r[0]
)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(table, table, table, st.sampled_from([("update", None), ("ignore", None), ("update", ["v"])]))
def test_merging_together_equals_merging_in_turn(spark, master, first, second, how):
    mode, columns = how
    frames = [frame(spark, x) for x in (master, first, second)]
    got = upsert_all(frames[0], frames[1:], ["k"], on_match=mode, set_columns=columns)
    step = merged_in_python(master, first, mode, columns)
    assert rows(got) == merged_in_python(step, second, mode, columns)


@pytest.mark.parametrize("how", [{}, {"on_match": "ignore"}, {"set_columns": ["v"]}])
def test_the_plan_grows_in_proportion_to_the_staged_tables(spark, how):
    def relations(n):
        staged = [frame(spark, [(1, i, "a")]) for i in range(n)]
        merged = upsert_all(frame(spark, [(1, 1, "a")]), staged, ["k"], **how)
        return str(merged._jdf.queryExecution().optimizedPlan()).count("LogicalRDD")

    two, four, eight = (relations(n) for n in (2, 4, 8))
    assert eight - four == 2 * (four - two)


@pytest.mark.parametrize("fmt", ["orc", "csv"])
def test_only_touched_partitions_are_rewritten(spark, lake, fmt):
    to = lake(fmt)
    schema = "k int, v string, day int"

    def go(data, **how):
        staged = [spark.createDataFrame(data, schema)]
        landing = land_partitions(spark, staged, to, "m", ["day", "k"], "day", **how)
        back = read_landing(spark, to, landing)
        return rows(back), {f for f in back.inputFiles() if "day=2" in f}

    first = [(1, "a", 1), (2, "b", 2), (3, "c", None)]
    got, second_day = go(first)
    assert got == sorted(first, key=repr) and second_day
    got, same_day = go([(1, "A", 1), (9, "n", 1), (3, "d", None)])
    assert same_day == second_day
    assert got == sorted([(1, "A", 1), (9, "n", 1), (2, "b", 2), (3, "c", None), (3, "d", None)], key=repr)
    got, same_day = go([(1, "x", 1), (5, "y", 5)], on_match="ignore")
    assert same_day == second_day and (1, "A", 1) in got and (5, "y", 5) in got and len(got) == 6
    assert go([])[0] == got
    with pytest.raises(ValueError, match="part of the key"):
        land_partitions(spark, [spark.createDataFrame(first, schema)], to, "m", ["k"], "day")
