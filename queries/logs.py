"""The activity log: status, older logs, redaction, and the latest committed landing."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ferry.functions import redact
from ferry.operators import ActivityLog, activity_status, read_events
from ferry.plans import Plan, Route, Transfer, TransferFailed, Upsert, run
from ferry.sinks import Landing, read_landing
from ferry.workspace import scratch
from queries.registry import query, table, tables, target


def _started(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.lit("orders").alias("integration_name"),
        F.concat(F.lit("host-"), "o_custkey").alias("host_name"),
        F.col("o_orderkey").cast("string").alias("table_name"),
        F.col("o_orderdate").alias("start"),
        F.lit("STARTED").alias("event"),
        F.col("o_orderdate").alias("event_time"),
        F.concat(F.lit('{"priority":"'), "o_orderpriority", F.lit('"}')).alias("configuration"),
        F.lit(None).cast("string").alias("stacktrace"),
        F.col("o_orderstatus"),
    )


@query(
    """
    SELECT 'orders' AS integration_name, 'host-' || o_custkey AS host_name,
           CAST(o_orderkey AS VARCHAR) AS table_name, o_orderdate AS start,
           CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 1 HOUR END AS finish,
           CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'P' THEN 'SUCCESS' END AS result,
           '{"priority":"' || o_orderpriority || '"}' AS configuration,
           CASE WHEN o_orderstatus = 'F' THEN 'broken ' || o_orderkey END AS stacktrace
    FROM orders
    """,
    name="activity_status",
)
def activity_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a run: O still runs, F failed, P succeeded an hour later."""
    started = _started(table(spark, sf_dir, "orders"))
    failed = F.col("o_orderstatus") == "F"
    closed = started.where("o_orderstatus <> 'O'").withColumns(
        {
            "event": F.when(failed, "FAILED").otherwise("SUCCESS"),
            "event_time": F.col("start") + F.expr("INTERVAL 1 HOUR"),
            "configuration": F.lit(None).cast("string"),
            "stacktrace": F.when(failed, F.concat(F.lit("broken "), "table_name")),
        }
    )
    return activity_status(started.unionByName(closed))


@query(
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS table_name, o_orderdate AS start,
           CASE WHEN o_orderstatus = 'F' THEN '{}'
                ELSE '{"priority":"' || o_orderpriority || '"}' END AS configuration,
           CAST(NULL AS VARCHAR) AS stacktrace
    FROM orders
    """
)
def activity_schema_upgrade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log whose older files know neither configuration nor stacktrace."""
    path = scratch(spark, "activity")
    events = _started(table(spark, sf_dir, "orders")).withColumns(
        {"start": F.col("start").cast("timestamp"), "event_time": F.col("event_time").cast("timestamp")}
    )
    older = events.where("o_orderstatus = 'F'").drop("configuration", "stacktrace", "o_orderstatus")
    older.write.orc(path)
    events.where("o_orderstatus <> 'F'").drop("o_orderstatus").write.mode("append").orc(path)
    return activity_status(read_events(spark, path)).select(
        "table_name", F.col("start").cast("timestamp_ntz"), "configuration", "stacktrace"
    )


@query(
    """
    SELECT c_custkey,
           '[{"name":"' || c_name || '","url":"jdbc:postgresql://host' || c_nationkey
           || ':5432/db?ssl=true","dataFormat":"orc"},{"name":"' || c_mktsegment
           || '","url":"s3a://bucket/' || c_custkey || '","dataFormat":"csv"}]' AS lakes
    FROM customer
    """
)
def activity_redaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as a config of two lakes, credentials in fields and inside urls."""

    def lake(name: str, url: Column, fmt: str) -> Column:
        return F.struct(
            F.col(name).alias("name"),
            url.alias("url"),
            F.lit(fmt).alias("dataFormat"),
            F.lit("someone").alias("username"),
            F.col("c_acctbal").cast("string").alias("password"),
            F.lit("AK").alias("accessKeyId"),
            F.lit("SK").alias("secretAccessKey"),
            F.create_map(F.lit("password"), F.lit("pw")).alias("properties"),
        )

    jdbc_url = F.concat(
        F.lit("jdbc:postgresql://someone:pw@host"),
        "c_nationkey",
        F.lit(":5432/db?ssl=true&user=someone&password=pw"),
    )
    s3_url = F.concat(F.lit("s3a://AK:SK@bucket/"), "c_custkey")
    lakes = F.array(lake("c_name", jdbc_url, "orc"), lake("c_mktsegment", s3_url, "csv"))
    customer = table(spark, sf_dir, "customer")
    return redact(customer.select("c_custkey", lakes.alias("lakes")), "lakes")


@query(
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2 AS o_totalprice, o_orderdate,
           o_orderpriority
    FROM orders
    """
)
def snapshot_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs of one table, the last of which lands but fails: the second one counts."""
    lake = target(spark, "orc", activity_log=True)
    doubled = (
        "( SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2 AS o_totalprice,"
        " o_orderdate, o_orderpriority FROM orders ) t"
    )
    ambiguous = Upsert("master", ("o_orderstatus",))
    for item in (
        Transfer("orders.parquet", "orders"),
        Transfer(doubled, "orders"),
        Transfer("orders.parquet", "orders", merge=ambiguous),
    ):
        plan = Plan("orders", (tables(sf_dir), lake), (Route("tables", "target", (item,)),))
        try:
            run(spark, plan)
        except TransferFailed:
            if item.merge is None:
                raise
    latest = ActivityLog(spark, lake, "orders").latest("orders")
    return read_landing(spark, lake, Landing(**json.loads(latest)))
