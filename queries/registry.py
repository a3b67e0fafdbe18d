"""The registry and the lakes that queries read from and write to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from ferry.sources import Lake, scan
from ferry.workspace import is_single_process, scratch

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its own name, or another where an operator has that one."""

    def register(fn: Query) -> Query:
        QUERIES[name or fn.__name__] = fn
        ORACLES[name or fn.__name__] = sql.strip()
        return fn

    return register


def tables(sf_dir: str) -> Lake:
    """The given parquet tables."""
    return Lake("tables", sf_dir, format="parquet", snapshots=False)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan(spark, tables(sf_dir), f"{name}.parquet")


def target(spark: SparkSession, fmt: str, name: str = "target", **options) -> Lake:
    """An empty file lake in the shared folder."""
    return Lake(name, scratch(spark, "lake"), format=fmt, **options)


def database(spark: SparkSession, name: str = "database", **options) -> Lake:
    """The database that the session names, or, in one process, an embedded one.

    Executors of a cluster cannot see a database embedded in the driver, so there the settings
    ``spark.ferry.jdbc.url``, ``.driver``, ``.user`` and ``.password`` must name a shared one.
    """
    named = {k: spark.conf.get(f"spark.ferry.jdbc.{k}", None) for k in ("url", "driver", "user", "password")}
    if named["url"]:
        return Lake(
            name,
            named["url"],
            driver=named["driver"],
            username=named["user"],
            password=named["password"] or "",
            **options,
        )
    if not is_single_process(spark):
        raise RuntimeError("on a cluster, spark.ferry.jdbc.url must name a database all executors reach")
    folder = _embedded()
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", f"{folder}/derby.log")
    return Lake(
        name,
        f"jdbc:derby:{folder}/db;create=true",
        driver="org.apache.derby.iapi.jdbc.AutoloadedDriver",
        username="app",
        password="app",
        **options,
    )


@cache
def _embedded() -> str:
    return tempfile.mkdtemp(prefix="ferry-db-")


def fresh(name: str) -> str:
    """A table name of one's own."""
    return f"{name}_{uuid.uuid4().hex[:10]}"
