from __future__ import annotations

from dataclasses import replace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ferry.operators import reconcile, writable
from ferry.plans import Plan, Route, Transfer, run
from ferry.sinks import land, read_landing
from ferry.sources import jdbc, scan
from ferry.sources.jdbc import Split
from queries.registry import fresh


def sizes(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_types_survive(spark, db):
    df = spark.sql(
        "select 1 as i, 2L as l, 1.5D as d, 'x' as s, date'2024-02-29' as day,"
        " timestamp_ntz'2024-01-01 01:02:03.000004' as ntz, true as b"
        " union all select null, null, null, null, null, null, null"
    )
    back = read_landing(spark, db, land(df, db, fresh("t")))
    assert back.dtypes == df.dtypes and rows(back) == rows(df)


def test_save_modes(spark, db):
    one, two = spark.range(1), spark.range(1, 3)
    expected = {"append": [(0,), (1,), (2,)], "overwrite": [(1,), (2,)], "ignore": [(0,)]}
    for mode, result in expected.items():
        table = fresh(mode)
        land(one, db, table, mode=mode)
        landing = land(two, db, table, mode=mode)
        assert rows(read_landing(spark, db, landing)) == result
        assert landing.rows == (None if mode == "ignore" else 2)
    table = fresh("error")
    land(one, db, table, mode="error")
    with pytest.raises(FileExistsError):
        land(two, db, table, mode="error")


def test_append_leaves_no_half_batch(spark, db):
    table = fresh("t")
    land(spark.range(3), db, table)
    broken = spark.range(0, 100, 1, 4).select(
        F.when(F.col("id") == 99, F.raise_error(F.lit("lost")))
        .otherwise(F.col("id"))
        .cast("long")
        .alias("id")
    )
    with pytest.raises(Exception, match="lost"):
        land(broken, db, table, mode="append")
    assert scan(spark, db, table).count() == 3


def test_atomic_overwrites_keep_the_old_rows_until_the_new_are_there(spark, db):
    table = fresh("t")
    jdbc.execute(spark, db, [f'CREATE TABLE {table} ("id" BIGINT NOT NULL PRIMARY KEY)'])
    safe = replace(db, atomic=True)
    land(spark.range(3), safe, table)
    broken = spark.range(5).select(F.raise_error(F.lit("lost")).cast("long").alias("id"))
    twice = spark.sql("select explode(array(8L, 8L)) as id")
    for bad in (broken, twice):
        with pytest.raises(Exception):
            land(bad, safe, table)
        assert rows(scan(spark, db, table)) == [(0,), (1,), (2,)]
    assert land(spark.range(5, 7), safe, table).rows == 2
    assert rows(scan(spark, db, table)) == [(5,), (6,)]
    assert jdbc.primary_key(spark, db, table) == ["id"]


def test_append_matches_columns_by_name(spark, db):
    table = fresh("t")
    jdbc.execute(spark, db, [f"CREATE TABLE {table} (B VARCHAR(9), A BIGINT)"])
    land(spark.sql("select 1L as a, 'x' as b"), db, table, mode="append", column_types="b VARCHAR(9)")
    assert rows(scan(spark, db, table)) == [("x", 1)]


def test_rows_written_twice_are_noticed(spark, db, monkeypatch):
    real = jdbc.count
    monkeypatch.setattr(jdbc, "count", lambda *a: real(*a) + 1)
    with pytest.raises(RuntimeError, match="wrote 3 rows, found 4"):
        land(spark.range(3), db, fresh("t"))
    wrong = iter([5, 3])
    monkeypatch.setattr(jdbc, "count", lambda *a: next(wrong))
    assert land(spark.range(3), db, fresh("t")).rows == 3


@pytest.mark.parametrize("column", ["id", "x", "ts", "day"])
def test_splits_cover_every_row_once(spark, db, column):
    df = spark.range(1000).select(
        "id",
        (F.col("id") / 7).alias("x"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, id)").alias("ts"),
        F.expr("date_add(date'2024-01-01', cast(id as int))").alias("day"),
    )
    df = df.unionAll(df.limit(1).select(*[F.lit(None).alias(c) for c in df.columns]))
    table = fresh("t")
    land(df, db, table)
    split = scan(spark, db, table, split=Split(column, 4))
    assert len(sizes(split)) == 4 and max(sizes(split)) < 400
    assert reconcile(df, split).first()[2:] == (0, 0)


def test_balanced_splits_follow_clustered_values(spark, db):
    i = F.col("id")
    df = spark.range(1000).select(F.when(i < 990, i).otherwise(i * 1_000_000_000).alias("k"))
    table = fresh("t")
    land(df, db, table)
    even, wide = (scan(spark, db, table, split=Split("k", 4, balanced=b)) for b in (True, False))
    assert max(sizes(wide)) == 990 and max(sizes(even)) < 600
    assert reconcile(df, even).first()[2:] == (0, 0)


def test_splits_of_empty_and_constant_tables(spark, db):
    for df in (spark.range(0), spark.range(5).select(F.lit(1).alias("id"))):
        table = fresh("t")
        land(df, db, table)
        for balanced in (True, False):
            assert scan(spark, db, table, split=Split("id", 4, balanced=balanced)).count() == df.count()


def test_filters_and_columns_reach_the_database(spark, db, capsys):
    table = fresh("t")
    land(spark.range(9).withColumn("v", F.col("id")), db, table)
    scan(spark, db, table).where("id < 3").select("id").explain()
    plan = capsys.readouterr().out
    assert "*LessThan(id,3)" in plan and "ReadSchema: struct<id:bigint>" in plan


def test_statements_are_one_transaction(spark, db):
    table = fresh("t")
    land(spark.range(3), db, table)
    with pytest.raises(Exception):
        jdbc.execute(spark, db, [f"DELETE FROM {table}", "DELETE FROM nowhere"])
    assert scan(spark, db, table).count() == 3


def test_lost_connections_are_not_absent_tables(spark, db):
    assert jdbc.table_exists(spark, db, "nowhere") is False
    gone = replace(db, url="jdbc:derby:/nowhere/at/all")
    with pytest.raises(Exception):
        jdbc.table_exists(spark, gone, "nowhere")
    assert writable(spark, db) is None
    assert "cannot write" in writable(spark, gone)


def test_connections_may_be_limited(spark, db):
    table = fresh("t")
    landing = land(spark.range(0, 100, 1, 4), replace(db, max_connections=2), table)
    assert landing.rows == 100


def test_tables_are_read_in_parallel(spark, db):
    table = fresh("t")
    jdbc.execute(spark, db, [f'CREATE TABLE {table} ("id" BIGINT NOT NULL PRIMARY KEY, "v" BIGINT)'])
    land(spark.range(1000).withColumn("v", F.col("id")), db, table, mode="append")
    few = replace(db, fetch_size=100, max_connections=4)
    assert jdbc.primary_key(spark, db, table) == ["id"]
    assert len(sizes(scan(spark, few, table))) == 4
    assert scan(spark, replace(few, max_connections=1), table).rdd.getNumPartitions() == 1
    assert scan(spark, db, table).rdd.getNumPartitions() == db.max_connections
    assert scan(spark, few, table).distinct().count() == 1000
    # Without a key, by a unique index, else by the first number or date.
    for index in (True, False):
        table = fresh("t")
        columns = '"s" VARCHAR(10), "d" DATE, "id" BIGINT NOT NULL'
        jdbc.execute(spark, db, [f"CREATE TABLE {table} ({columns})"] + [f'CREATE UNIQUE INDEX i_{table} ON {table} ("id")'] * index)
        rows_ = spark.range(1000).selectExpr("cast(id as string) AS s", "date_add(date'2024-01-01', cast(id % 50 as int)) AS d", "id")
        land(rows_, db, table, mode="append")
        assert jdbc.unique_indexes(spark, db, table) == ([["id"]] if index else [])
        assert len(sizes(scan(spark, few, table))) == 4 and scan(spark, few, table).distinct().count() == 1000


def test_subselects_are_read_in_parallel(spark, db):
    table = fresh("t")
    nulls = "CASE WHEN id % 10 = 0 THEN NULL ELSE id END AS k"
    land(spark.range(1000).selectExpr("cast(id AS string) AS s", "id / 7 AS x", nulls, "id"), db, table)
    few = replace(db, fetch_size=100, max_connections=4)
    rows = scan(spark, few, f'( select "s", "x", "k", "id" from {table} where "id" >= 200 ) q')
    assert len(sizes(rows)) == 4 and max(sizes(rows)) < 400
    assert rows.count() == 800 and rows.distinct().count() == 800 and rows.where("k IS NULL").count() == 80
    sums = scan(spark, few, f'( select mod("id", 20) as "g", count(*) as "n", \'order by\' as "t" from {table} group by mod("id", 20) ) q')
    assert sums.rdd.getNumPartitions() > 1 and sorted((r.g, r.n) for r in sums.collect()) == [(g, 50) for g in range(20)]
    # One connection where rows may be others when asked again, where no column can be cut, or where one is wanted.
    for text, n in (
        (f'( select "id" from {table} fetch first 10 rows only ) q', 10),
        (f'( select row_number() over () as "i" from {table} ) q', 1000),
        (f'( select "s", "x" from {table} ) q', 1000),
    ):
        one = scan(spark, few, text)
        assert one.rdd.getNumPartitions() == 1 and one.count() == n
    whole = scan(spark, few, f'( select "id" from {table} ) q', split=jdbc.WHOLE)
    assert whole.rdd.getNumPartitions() == 1 and whole.count() == 1000
    assert scan(spark, few, f'( select "id" from {table} where "id" < 0 ) q').count() == 0


WAYS = {"plain": {}, "truncate": {"options": {"truncate": "true"}}, "atomic": {"atomic": True}}


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("via", ["view", "synonym", "subselect"])
def test_overwriting_through_other_names_keeps_the_rows(spark, db, way, via):
    table, shown = fresh("t").upper(), fresh("shown").upper()
    land(spark.range(7), db, table)
    of = f'VIEW {shown} AS SELECT * FROM {table} WHERE "id" > 2' if via != "synonym" else f"SYNONYM {shown} FOR {table}"
    jdbc.execute(spark, db, [f"CREATE {of}"])
    source = f"( select * from {shown} ) x" if via == "subselect" else shown
    to = replace(db, name="to", **WAYS[way])
    run(spark, Plan("p", (db, to), (Route(db.name, "to", (Transfer(source, table),)),)))
    assert rows(scan(spark, db, table)) == [(i,) for i in range(0 if via == "synonym" else 3, 7)]
    assert rows(scan(spark, db, shown)) == rows(scan(spark, db, table))


@pytest.mark.parametrize("way", WAYS)
def test_a_failed_overwrite_leaves_the_old_rows_and_no_other_table(spark, db, way, monkeypatch):
    table, to = fresh("t").upper(), replace(db, **WAYS[way])
    land(spark.range(3), db, table)
    before = jdbc.tables(spark, db)
    broken = spark.range(9).select(F.when(F.col("id") == 8, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        land(broken, to, table)
    # Staged rows that cannot be proven to be whole never take the place of the old ones.
    with monkeypatch.context() as m:
        real = jdbc.count
        m.setattr(jdbc, "count", lambda *a: real(*a) - 1)
        with pytest.raises(RuntimeError, match="wrote 9 rows, found 8"):
            land(spark.range(9), to, table)
    # Nor do rows that get lost on the way over.
    if way != "plain":
        with monkeypatch.context() as m:
            real_move = jdbc.move
            m.setattr(jdbc, "move", lambda *a, **k: real_move(*a[:5], a[5] + 1, **k))
            with pytest.raises(jdbc.Miscounted):
                land(spark.range(9), to, table)
    assert rows(scan(spark, db, table)) == [(0,), (1,), (2,)] and jdbc.tables(spark, db) == before


def test_a_plain_overwrite_brings_its_own_definition(spark, db):
    table = fresh("t")
    land(spark.range(3), db, table)
    land(spark.sql("select 1.5D as x, 'a' as y"), db, table)
    assert scan(spark, db, table).columns == ["x", "y"] and rows(scan(spark, db, table)) == [(1.5, "a")]


def test_an_overwrite_that_fits_no_view_is_refused_with_the_rows_left(spark, db):
    table, view = fresh("t").upper(), fresh("v").upper()
    land(spark.range(3), db, table)
    jdbc.execute(spark, db, [f"CREATE VIEW {view} AS SELECT * FROM {table}"])
    with pytest.raises(ValueError, match="has no columns"):
        land(spark.sql("select 1 as other"), db, table)
    assert scan(spark, db, view).count() == 3
