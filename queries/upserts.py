"""Upserts of orders: earlier orders are the master, later ones with doubled prices are staged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ferry.operators import upsert, upsert_all
from ferry.plans import Plan, Route, Transfer, Upsert, run
from ferry.sinks import land, read_landing
from ferry.sources import scan
from queries.registry import query, table, tables, target

KEYS = ["o_orderkey"]

_DOUBLED = """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2 AS o_totalprice, o_orderdate,
           o_orderpriority
    FROM orders
"""


def _master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where("o_orderstatus IN ('F', 'O')")


def _staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where("o_orderstatus IN ('O', 'P')")
    return orders.withColumn("o_totalprice", F.col("o_totalprice") * 2)


@query("SELECT * FROM orders")
def upsert_create_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first run of a transfer with a merge: there is no master yet."""
    lake = target(spark, "orc")
    item = Transfer("orders.parquet", "staging", merge=Upsert("master", ("o_orderkey",)))
    run(spark, Plan("orders", (tables(sf_dir), lake), (Route("tables", "target", (item,)),)))
    return scan(spark, lake, "master")


@query(f"SELECT * FROM orders WHERE o_orderstatus = 'F' UNION ALL {_DOUBLED} WHERE o_orderstatus <> 'F'")
def upsert_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = target(spark, "orc")
    merged = upsert(_master(spark, sf_dir), _staging(spark, sf_dir), KEYS)
    return read_landing(spark, lake, land(merged, lake, "master"))


@query(f"SELECT * FROM orders WHERE o_orderstatus <> 'P' UNION ALL {_DOUBLED} WHERE o_orderstatus = 'P'")
def upsert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = target(spark, "orc")
    merged = upsert(_master(spark, sf_dir), _staging(spark, sf_dir), KEYS, on_match="ignore")
    return read_landing(spark, lake, land(merged, lake, "master"))


@query(
    """
    SELECT o_orderkey, o_custkey, o_orderstatus,
           CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE o_totalprice * 2 END AS o_totalprice,
           o_orderdate,
           CASE WHEN o_orderstatus = 'P' THEN 'staged' ELSE o_orderpriority END AS o_orderpriority
    FROM orders
    """
)
def upsert_set_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matched rows take only the staged price; new rows come whole."""
    lake = target(spark, "orc")
    staging = _staging(spark, sf_dir).withColumn("o_orderpriority", F.lit("staged"))
    merged = upsert(_master(spark, sf_dir), staging, KEYS, set_columns=["o_totalprice"])
    return read_landing(spark, lake, land(merged, lake, "master"))


@query(
    """
    SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    FROM (
        SELECT *, ROW_NUMBER() OVER (
            PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
        FROM orders)
    WHERE rn = 1
    """
)
def upsert_latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many staged rows per customer: the latest order of each becomes the master."""
    orders = table(spark, sf_dir, "orders")
    return upsert(None, orders, ["o_custkey"], order_by=["o_orderdate", "o_orderkey"])


@query(
    f"""
    SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT'
    UNION ALL {_DOUBLED} WHERE o_orderstatus <> 'F'
    UNION ALL
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 4 AS o_totalprice, o_orderdate,
           o_orderpriority
    FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
    """
)
def upsert_recover_leftover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an earlier run landed is merged first, then the new rows, into one new master."""
    lake = target(spark, "orc")
    urgent = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'")
    leftover = urgent.withColumn("o_totalprice", F.col("o_totalprice") * 4)
    merged = upsert_all(_master(spark, sf_dir), [leftover, _staging(spark, sf_dir)], KEYS)
    return read_landing(spark, lake, land(merged, lake, "master"))


@query(
    """
    SELECT *, CAST(ts AS DATE) AS bucket_val FROM events
    WHERE event_type <> 'purchase'
      AND CAST(ts AS DATE) NOT BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'
    UNION ALL
    SELECT event_id, ts, user_id, event_type, value * 2 AS value, props,
           CAST(ts AS DATE) AS bucket_val
    FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'
    """
)
def upsert_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A master by day: later rows of three days rewrite these days and no others."""
    lake = target(spark, "orc", snapshots=False)
    merge = Upsert("master", ("bucket_val", "event_id"), partition="bucket_val")
    earlier = (
        "( SELECT *, CAST(ts AS DATE) AS bucket_val FROM events WHERE event_type <> 'purchase' ) e"
    )
    later = (
        "( SELECT event_id, ts, user_id, event_type, value * 2 AS value, props,"
        " CAST(ts AS DATE) AS bucket_val FROM events"
        " WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' ) e"
    )
    for source in (earlier, later):
        item = Transfer(source, "staging", merge=merge)
        run(spark, Plan("events", (tables(sf_dir), lake), (Route("tables", "target", (item,)),)))
    return scan(spark, lake, "master")
