from __future__ import annotations

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ferry.operators import reconcile
from ferry.sinks import SelfOverwrite, land, read_landing
from ferry.sources import Lake, is_subselect, join_uri, scan

TRICKY = [
    (1, None, ""),
    (2, "\\N", " a "),
    (3, "\\\\N", 'q"\n\r\nx'),
    (4, "", "\\"),
    (5, 'a\\"b', '"'),
    (6, "a,b", "\r"),
    (7, "\u00e9\u4e2d\U0001f600", "\t"),
    (8, "\\", "\\N "),
]


@pytest.mark.parametrize("fmt", ["csv", "orc", "parquet"])
def test_text_survives_every_format(spark, lake, fmt):
    df = spark.createDataFrame(TRICKY, "i int, s string, t string")
    to = lake(fmt)
    assert rows(read_landing(spark, to, land(df, to, "t"))) == rows(df)


def test_csv_without_header_comes_back_typed(spark, lake):
    df = spark.createDataFrame(TRICKY, "i int, s string, t string")
    to = lake("csv", header=False)
    back = read_landing(spark, to, land(df, to, "t"))
    assert back.dtypes == df.dtypes and rows(back) == rows(df)


text = st.none() | st.text(alphabet='aN\\",\n\r \t\'#é', max_size=6)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(text, text, st.none() | st.floats(allow_nan=False), st.none() | st.integers(-9, 9)),
        max_size=12,
    )
)
def test_csv_is_lossless_for_any_text(spark, lake, data):
    df = spark.createDataFrame(data, "s string, t string, x double, i int")
    to = lake("csv")
    back = read_landing(spark, to, land(df, to, "t"))
    assert reconcile(df, back).first()[2:] == (0, 0)


@pytest.mark.parametrize("fmt", ["csv", "orc", "parquet"])
def test_every_plain_type_survives(spark, lake, fmt):
    df = spark.sql(
        "select true as b, 1Y as t, 2S as s, 3 as i, 4L as l, 1.5F as f, 1.0E-9D as d, 1.230BD as n,"
        " date'2024-02-29' as day, timestamp'2024-01-01 01:02:03.000004' as ts,"
        " timestamp_ntz'2024-01-01 01:02:03.000004' as ntz"
        " union all select null, null, null, null, null, null, null, null, null, null, null"
    )
    to = lake(fmt)
    back = read_landing(spark, to, land(df, to, "t"))
    assert back.dtypes == df.dtypes and rows(back) == rows(df)


def test_nested_types_need_orc_or_parquet(spark, lake):
    df = spark.createDataFrame([(1, [1, None], {"a": 1})], "id int, a array<int>, m map<string,int>")
    for fmt in ("orc", "parquet"):
        to = lake(fmt, fmt)
        assert rows(read_landing(spark, to, land(df, to, "t"))) == rows(df)
    with pytest.raises(TypeError, match="csv cannot hold"):
        land(df, lake("csv", "csv"), "t")


@pytest.mark.parametrize("fmt", ["csv", "orc", "parquet"])
@pytest.mark.parametrize("bucket", [None, "d"])
def test_empty_tables_land(spark, lake, fmt, bucket):
    df = spark.createDataFrame([], "i int, s string, d date")
    to = lake(fmt)
    landing = land(df, to, "t", bucket=bucket)
    back = read_landing(spark, to, landing)
    assert landing.rows == 0 and back.count() == 0 and back.columns == df.columns


def test_header_governs_both_ways(spark, lake):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string")
    named, bare = lake("csv", "named"), lake("csv", "bare", header=False)
    land(df, named, "t")
    land(df, bare, "t")
    assert rows(scan(spark, named, "t")) == [("1", "x"), ("2", "y")]
    assert scan(spark, bare, "t").dtypes == [("_c0", "int"), ("_c1", "string")]
    assert scan(spark, bare, "t").count() == 2


def test_foreign_csv_is_read_in_the_plain_dialect(spark, tmp_path):
    (tmp_path / "part-0.csv").write_text('a,b\n1,\n2,\\N\n3,"x ""y"""\n')
    foreign = Lake("f", str(tmp_path), format="csv", dialect="plain", options={"escape": '"'})
    assert rows(scan(spark, foreign, "part-0.csv")) == [("1", None), ("2", "\\N"), ("3", 'x "y"')]


def test_damaged_landings_are_not_read_as_nulls(spark, lake, tmp_path):
    to = lake("csv", snapshots=False)
    landing = land(spark.createDataFrame([(1,)], "a int"), to, "t")
    (tmp_path / "lake" / "t" / "part-9.csv").write_text("a\nbroken\n")
    with pytest.raises(Exception, match="MALFORMED|BAD_DATA|NumberFormat|malformed"):
        read_landing(spark, to, landing).collect()


def test_save_modes(spark, lake):
    one, two = spark.range(1), spark.range(1, 3)
    for mode, expected in {
        "append": [(0,), (1,), (2,)],
        "overwrite": [(1,), (2,)],
        "ignore": [(0,)],
    }.items():
        to = lake("orc", mode, snapshots=False)
        landing = land(one, to, "t")
        land(two, to, "t", mode=mode)
        assert rows(read_landing(spark, to, landing)) == expected
    to = lake("orc", "error", snapshots=False)
    land(one, to, "t", mode="error")
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        land(two, to, "t", mode="error")


def test_snapshots_keep_the_last_good_run(spark, lake):
    to = lake()
    first = land(spark.range(3), to, "t")
    second = land(spark.range(5), to, "t")
    assert first.path != second.path and ":" not in first.run_id
    assert read_landing(spark, to, first).count() == 3
    assert scan(spark, to, "t").count() == 5
    broken = spark.range(9).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        land(broken, to, "t")
    assert scan(spark, to, "t").count() == 5


def test_snapshots_do_not_append(lake):
    with pytest.raises(ValueError, match="snapshots replace"):
        lake(write_mode="append", snapshots=True)
    assert lake(write_mode="append").snapshots is False


def test_overwriting_its_own_source_is_refused(spark, lake):
    to = lake(snapshots=False)
    landing = land(spark.range(3), to, "t")
    with pytest.raises(SelfOverwrite):
        land(scan(spark, to, "t").where("id > 0"), to, "t")
    assert read_landing(spark, to, landing).count() == 3


def test_number_of_files(spark, lake):
    df = spark.range(0, 1000, 1, 4)
    to = lake()
    assert len(read_landing(spark, to, land(df, to, "a", files_per_table=1)).inputFiles()) == 1
    assert len(read_landing(spark, to, land(df, to, "b")).inputFiles()) == 4


def test_subselects_over_files(spark, lake):
    to = lake("parquet")
    land(spark.range(5).withColumn("v", F.col("id") * 2), to, "numbers")
    land(spark.range(2), to, "other")
    spark.range(1).createOrReplaceTempView("other")
    sql = "( with n as (select * from Numbers) select n.v from n join other o on n.id = o.id ) AS \"t\""
    assert rows(scan(spark, to, sql)) == [(0,), (2,)]
    assert spark.table("other").count() == 1
    assert not spark.catalog.tableExists("numbers")
    spark.catalog.dropTempView("other")


def test_pieces():
    assert join_uri("s3a://bucket/a/", "/b", "c") == "s3a://bucket/a/b/c"
    assert is_subselect("( select 1 ) x") and is_subselect("(SELECT 1)")
    assert not is_subselect("selection") and not is_subselect("(t)")
    with pytest.raises(ValueError):
        Lake(" ", "/x", format="orc")
    with pytest.raises(ValueError):
        Lake("x", "/x", format="xml")
    with pytest.raises(ValueError):
        Lake("x", "jdbc:x", driver="org.example.Driver")
    assert Lake("x", "s3a://b", driver="s3", format="orc").snapshots is False
