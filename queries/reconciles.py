"""Reconciling orders with a landed copy that differs in known ways, and preflight checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ferry.operators import missing_lakes, profile, reconcile, reconcile_cells
from ferry.sinks import land, read_landing
from queries.registry import query, table, target

# The copy: urgent F orders at twice the price, O orders of medium priority under another
# status, no low P orders, and high F orders a second time under negative keys.
_COPY = """
    SELECT o_orderkey, o_custkey,
           CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '3-MEDIUM' THEN 'X'
                ELSE o_orderstatus END AS o_orderstatus,
           CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN o_totalprice * 2
                ELSE o_totalprice END AS o_totalprice,
           o_orderdate, o_orderpriority
    FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')
    UNION ALL
    SELECT -1 - o_orderkey AS o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
           o_orderpriority
    FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'
"""

_VALUES = ("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


def _both(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    changed = orders.where(~((status == "P") & (priority == "5-LOW"))).withColumns(
        {
            "o_orderstatus": F.when((status == "O") & (priority == "3-MEDIUM"), "X").otherwise(status),
            "o_totalprice": F.when(
                (status == "F") & (priority == "1-URGENT"), F.col("o_totalprice") * 2
            ).otherwise(F.col("o_totalprice")),
        }
    )
    extra = orders.where((status == "F") & (priority == "2-HIGH"))
    copy = changed.unionByName(extra.withColumn("o_orderkey", -1 - F.col("o_orderkey")))
    lake = target(spark, "csv")
    return orders, read_landing(spark, lake, land(copy, lake, "orders"))


def _cells_sql(source: str, copy: str) -> str:
    lines = "\nUNION ALL\n".join(
        f"""SELECT o_orderkey, kind, '{c}' AS "column", CAST(s_{c} AS VARCHAR) AS src,
                   CAST(d_{c} AS VARCHAR) AS dst
            FROM paired WHERE kind <> 'changed' OR s_{c} IS DISTINCT FROM d_{c}"""
        for c in _VALUES
    )
    columns = ", ".join(f"s.{c} AS s_{c}, d.{c} AS d_{c}" for c in _VALUES)
    return f"""
    WITH src AS ({source}), dst AS ({copy}),
    paired AS (
        SELECT COALESCE(s.o_orderkey, d.o_orderkey) AS o_orderkey,
               CASE WHEN d.o_orderkey IS NULL THEN 'missing'
                    WHEN s.o_orderkey IS NULL THEN 'extra' ELSE 'changed' END AS kind, {columns}
        FROM src s FULL JOIN dst d ON s.o_orderkey = d.o_orderkey
    )
    {lines}"""


@query(
    f"""
    WITH copy AS ({_COPY})
    SELECT (SELECT COUNT(*) FROM orders) AS src_rows, (SELECT COUNT(*) FROM copy) AS dst_rows,
           (SELECT COUNT(*) FROM (SELECT * FROM orders EXCEPT ALL SELECT * FROM copy)) AS missing,
           (SELECT COUNT(*) FROM (SELECT * FROM copy EXCEPT ALL SELECT * FROM orders)) AS extra
    """
)
def reconcile_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile(*_both(spark, sf_dir))


@query(_cells_sql("SELECT * FROM orders", _COPY), name="reconcile_cells")
def reconcile_all_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile_cells(*_both(spark, sf_dir), ["o_orderkey"])


_EVENT_COLUMNS = {
    "event_id": "bigint",
    "ts": "timestamp_ntz",
    "user_id": "bigint",
    "event_type": "string",
    "value": "double",
    "props": "string",
}


@query(
    "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS column_name, '{t}' AS data_type, TRUE AS fits_csv, TRUE AS fits_orc,
                   TRUE AS fits_jdbc, COUNT(*) FILTER (WHERE {c} IS NULL) AS nulls,
                   {f"CAST(MAX(LENGTH({c})) AS INTEGER)" if t == "string" else "CAST(NULL AS INTEGER)"}
                   AS longest
            FROM events"""
        for c, t in _EVENT_COLUMNS.items()
    )
)
def preflight_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a destination must hold: types, nulls and the longest text of every column."""
    return profile(table(spark, sf_dir, "events"))


@query(
    """
    SELECT o_orderkey, 'customer_' || o_custkey AS source_lake,
           'segment_' || o_orderstatus AS destination_lake, 'customer_' || o_custkey AS unknown
    FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
    UNION ALL
    SELECT o_orderkey, 'customer_' || o_custkey, 'segment_' || o_orderstatus,
           'segment_' || o_orderstatus
    FROM orders WHERE o_orderstatus = 'P'
    """
)
def preflight_lakes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plan as large as orders against lakes as many as customers with a balance."""
    plan = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(F.lit("customer_"), "o_custkey").alias("source_lake"),
        F.concat(F.lit("segment_"), "o_orderstatus").alias("destination_lake"),
    )
    customers = table(spark, sf_dir, "customer").where("c_acctbal > 0")
    segments = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'")
    lakes = customers.select(F.concat(F.lit("customer_"), "c_custkey").alias("name")).unionAll(
        segments.select(F.concat(F.lit("segment_"), "o_orderstatus").alias("name"))
    )
    return missing_lakes(plan, lakes)
