"""Plans: many tables at once, tables named by a control query, and a lake onto itself."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ferry.plans import Plan, Route, Transfer, reconcile_run, run
from ferry.sinks import read_landing
from ferry.sources import scan
from queries.registry import query, table, tables, target

FANOUT = ("customer", "lineitem", "orders", "part", "supplier")


def _fanout(spark: SparkSession, sf_dir: str, fmt: str) -> tuple[Plan, object]:
    lake = target(spark, fmt)
    items = tuple(Transfer(f"{name}.parquet", name) for name in FANOUT)
    plan = Plan("fanout", (tables(sf_dir), lake), (Route("tables", lake.name, items),))
    return plan, run(spark, plan)


@query(
    "\nUNION ALL\n".join(
        f"""SELECT 'tables' AS source_lake, 'target' AS destination_lake, '{t}' AS "table",
                   'orc' AS format, COUNT(*) AS "rows" FROM {t}"""
        for t in FANOUT
    )
)
def fanout_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, done = _fanout(spark, sf_dir, "orc")
    return done.manifest(spark).drop("path", "seconds", "run_id")


@query(
    "\nUNION ALL\n".join(
        f"""SELECT 'tables' AS source_lake, 'target' AS destination_lake, '{t}' AS "table",
                   COUNT(*) AS src_rows, COUNT(*) AS dst_rows, CAST(0 AS BIGINT) AS missing,
                   CAST(0 AS BIGINT) AS extra FROM {t}"""
        for t in FANOUT
    )
)
def fanout_reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every table is landed as CSV, read again and compared with its source row by row."""
    return reconcile_run(spark, *_fanout(spark, sf_dir, "csv")).drop("seconds")


@query(
    """
    SELECT 'orders_' || LOWER(REGEXP_REPLACE(o_orderpriority, '[^A-Za-z0-9]+', '_', 'g')) AS destination,
           COUNT(*) AS n, MIN(o_orderkey) AS first_key, MAX(o_totalprice) AS dearest
    FROM orders GROUP BY 1
    """
)
def control_table_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A control query over orders names one transfer per priority; all of them are landed."""
    lake = target(spark, "orc")
    control = (
        "( SELECT DISTINCT o_orderpriority AS description,"
        " concat('( SELECT * FROM orders WHERE o_orderpriority = \"', o_orderpriority, '\" ) t') AS query,"
        " concat('orders_', lower(regexp_replace(o_orderpriority, '[^A-Za-z0-9]+', '_'))) AS destination"
        " FROM orders ) c"
    )
    item = Transfer(control, "by_priority", control=True, control_lake="tables")
    plan = Plan("control", (tables(sf_dir), lake), (Route("tables", "target", (item,)),))
    landed = [
        read_landing(spark, lake, one.landing).withColumn("destination", F.lit(one.landing.name))
        for one in run(spark, plan).landed
    ]
    return (
        reduce(DataFrame.unionByName, landed)
        .groupBy("destination")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("o_orderkey").alias("first_key"),
            F.max("o_totalprice").alias("dearest"),
        )
    )


@query("SELECT * FROM customer")
def self_transfer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One lake is source and destination; the copy has another name."""
    lake = target(spark, "orc")
    first = Route("tables", "target", (Transfer("customer.parquet", "customer"),))
    again = Route("target", "target", (Transfer("customer", "customer_copy"),))
    run(spark, Plan("self", (tables(sf_dir), lake), (first, again)))
    return scan(spark, lake, "customer_copy")
