"""Scans and sinks over files."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ferry.sinks import land, read_landing
from ferry.sources import scan
from ferry.sources.files import children
from queries.registry import query, table, tables, target


@query(
    """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(c_name AS VARCHAR) AS c_name,
           CAST(c_nationkey AS VARCHAR) AS c_nationkey, CAST(c_acctbal AS VARCHAR) AS c_acctbal,
           CAST(c_mktsegment AS VARCHAR) AS c_mktsegment
    FROM customer
    """
)
def csv_header_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = target(spark, "csv")
    land(table(spark, sf_dir, "customer"), lake, "customer")
    return scan(spark, lake, "customer")


@query("SELECT * FROM customer")
def csv_part_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A directory's part files, each scanned by its own name."""
    customer = table(spark, sf_dir, "customer")
    lake = target(spark, "csv", snapshots=False)
    land(customer, lake, "customer", files_per_table=3)
    parts = [p.removeprefix(lake.url) for p in children(spark, lake.path("customer"))]
    return reduce(DataFrame.unionAll, [scan(spark, lake, p, customer.schema) for p in parts])


@query(
    """
    SELECT CAST(s_suppkey AS INTEGER) AS _c0, s_name AS _c1,
           CAST(s_nationkey AS INTEGER) AS _c2, s_acctbal AS _c3
    FROM supplier
    """
)
def csv_inferred_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = target(spark, "csv", header=False)
    land(table(spark, sf_dir, "supplier"), lake, "supplier")
    return scan(spark, lake, "supplier")


@query("SELECT * FROM documents")
def csv_lossless_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = target(spark, "csv")
    return read_landing(spark, lake, land(table(spark, sf_dir, "documents"), lake, "documents"))


@query("SELECT * FROM lineitem")
def orc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = target(spark, "orc")
    return read_landing(spark, lake, land(table(spark, sf_dir, "lineitem"), lake, "lineitem"))


@query(
    """
    SELECT l_returnflag, l_linestatus, COUNT(*) AS n, MAX(l_extendedprice) AS dearest,
           1 AS n_files
    FROM lineitem GROUP BY l_returnflag, l_linestatus
    """
)
def single_file_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report in one file; the aggregation below it runs in parallel."""
    report = scan(
        spark,
        tables(sf_dir),
        "( SELECT l_returnflag, l_linestatus, COUNT(*) AS n, MAX(l_extendedprice) AS dearest"
        " FROM lineitem GROUP BY l_returnflag, l_linestatus ) r",
    )
    lake = target(spark, "csv")
    landed = read_landing(spark, lake, land(report, lake, "report", files_per_table=1))
    return landed.selectExpr("*", f"{len(landed.inputFiles())} AS n_files")


@query("SELECT * FROM events WHERE event_type = 'purchase'")
def file_subselect_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, tables(sf_dir), "( select * from events where event_type = 'purchase' ) e")


_BY_NATION = """
    SELECT n.n_name, COUNT(*) AS n_orders, MAX(o.o_totalprice) AS dearest
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
                  JOIN nation n ON c.c_nationkey = n.n_nationkey
    GROUP BY n.n_name
"""


@query(_BY_NATION)
def source_sql_join_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, tables(sf_dir), f"( {_BY_NATION} ) t")


def _two_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    return orders.where("o_orderstatus = 'F'"), orders.where("o_orderstatus <> 'F'")


def _second_lands_with(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    first, second = _two_batches(spark, sf_dir)
    lake = target(spark, "orc", snapshots=False)
    landing = land(first, lake, "orders")
    try:
        land(second, lake, "orders", mode=mode)
    except AnalysisException as e:
        if mode != "error" or e.getCondition() != "PATH_ALREADY_EXISTS":
            raise
    return read_landing(spark, lake, landing)


@query(
    """
    SELECT * FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT * FROM orders WHERE o_orderstatus <> 'F'
    """
)
def save_mode_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _second_lands_with(spark, sf_dir, "append")


@query("SELECT * FROM orders WHERE o_orderstatus <> 'F'")
def save_mode_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _second_lands_with(spark, sf_dir, "overwrite")


@query("SELECT * FROM orders WHERE o_orderstatus = 'F'")
def save_mode_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _second_lands_with(spark, sf_dir, "ignore")


@query("SELECT * FROM orders WHERE o_orderstatus = 'F'")
def save_mode_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _second_lands_with(spark, sf_dir, "error")
