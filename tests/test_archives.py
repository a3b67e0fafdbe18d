from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ferry.operators import constrain, day_bucket
from ferry.sinks import land, read_landing


def test_constraints_are_separate_expressions(spark):
    df = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (0, 0, 1)], "a int, b int, c int")
    assert rows(constrain(df, ["a = 1", "b = 1 OR c = 1"])) == [(1, 0, 1), (1, 1, 0)]
    assert constrain(df, []).count() == 3


def test_quoted_mixed_case_columns(spark):
    df = spark.createDataFrame([("2009-07-15", 1), ("2009-09-01", 2)], "IncidentDate string, id int")
    kept = constrain(
        df,
        [
            "\"IncidentDate\"::date <= to_date('08/01/2009', 'MM/dd/yyyy')",
            "\"IncidentDate\"::date >= to_date('07/01/2009', 'MM/dd/yyyy')",
        ],
    )
    assert rows(day_bucket(kept, '"IncidentDate"')) == [("2009-07-15", 1, dt.date(2009, 7, 15))]


def test_days_of_text(spark):
    df = spark.createDataFrame([("08/01/2009",), (None,)], "d string")
    assert rows(day_bucket(df, "d", "MM/dd/yyyy").select("bucket_val")) == [(None,), (dt.date(2009, 8, 1),)]
    bad = spark.createDataFrame([("8th of May",)], "d string")
    for fmt in (None, "MM/dd/yyyy"):
        assert day_bucket(bad, "d", fmt, lenient=True).first()["bucket_val"] is None
        with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE_TIMESTAMP"):
            day_bucket(bad, "d", fmt).collect()


def test_bucket_name_must_be_free(spark):
    with pytest.raises(ValueError, match="bucket_val"):
        day_bucket(spark.sql("select date'2024-01-01' as d, 1 as bucket_val"), "d")


def _events(spark, n=3000):
    """A third of all rows fall on one day."""
    day = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 11).cast("int")
    return spark.range(n).select("id", F.date_add(F.lit("2024-01-01"), day).alias("bucket_val"))


@pytest.mark.parametrize("fmt", ["csv", "orc"])
def test_null_days_and_hot_days_come_back(spark, lake, fmt):
    df = _events(spark).unionAll(spark.sql("select -1L, null"))
    to = lake(fmt)
    landing = land(df, to, "e", bucket="bucket_val")
    assert landing.rows == 3001
    assert rows(read_landing(spark, to, landing)) == rows(df)


def test_hot_days_are_written_by_several_tasks(spark, lake):
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    try:
        df = _events(spark, 60_000).withColumn("pad", F.sha2(F.col("id").cast("string"), 256))
        to = lake()
        landing = land(df, to, "e", bucket="bucket_val")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    files = read_landing(spark, to, landing).inputFiles()
    hot = [f for f in files if "bucket_val=2024-01-01" in f]
    assert len(hot) > 1
    assert read_landing(spark, to, landing).count() == 60_000


def test_days_are_clustered(spark, lake):
    to = lake()
    df = _events(spark).repartition(4)
    clustered = read_landing(spark, to, land(df, to, "a", bucket="bucket_val"))
    scattered = read_landing(spark, to, land(df, to, "b", bucket="bucket_val", cluster=False))
    assert len(clustered.inputFiles()) == 11 < len(scattered.inputFiles())


def test_rerun_replaces_only_its_days(spark, lake):
    to = lake(snapshots=False)
    land(_events(spark), to, "e", bucket="bucket_val")
    again = _events(spark).where("bucket_val = date'2024-01-02'").limit(1)
    landing = land(again, to, "e", bucket="bucket_val")
    kept = _events(spark).where("bucket_val <> date'2024-01-02'")
    assert rows(read_landing(spark, to, landing)) == rows(kept.unionAll(again))
    landing = land(again, to, "e", bucket="bucket_val", keep_other_days=False)
    assert rows(read_landing(spark, to, landing)) == rows(again)


def test_day_filters_prune_directories(spark, lake, capsys):
    to = lake()
    landing = land(_events(spark), to, "e", bucket="bucket_val")
    read_landing(spark, to, landing).where("bucket_val = date'2024-01-02'").explain()
    assert "PartitionFilters: [isnotnull(bucket_val" in capsys.readouterr().out


def test_hot_days_without_adaptive_execution(spark, lake):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        to = lake()
        landing = land(_events(spark), to, "e", bucket="bucket_val")
        back = read_landing(spark, to, landing)
        assert back.count() == 3000
        assert len([f for f in back.inputFiles() if "bucket_val=2024-01-01" in f]) == 4
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_text_partitions(spark, lake):
    to = lake()
    df = spark.createDataFrame([(1, "a/b=c %"), (2, None), (3, "2024-01-01"), (4, " ")], "id int, p string")
    assert rows(read_landing(spark, to, land(df, to, "t", bucket="p"))) == rows(df)
    with pytest.raises(Exception, match="an empty p would be read back as null"):
        land(spark.sql("select 1 as id, '' as p"), to, "t", bucket="p")
