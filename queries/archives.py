"""Archives: constraints, day buckets, day-partitioned landings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ferry.operators import constrain, day_bucket
from ferry.plans import Archive, Plan, Route, run
from ferry.sinks import land, read_landing
from ferry.sources import Lake
from queries.registry import query, table, tables, target

CONSTRAINTS = (
    "\"event_type\" = 'purchase' OR \"event_type\" = 'click'",
    "to_date(\"ts\") <= to_date('01/20/2024', 'MM/dd/yyyy')",
    "to_date(\"ts\") >= to_date('01/05/2024', 'MM/dd/yyyy')",
)


def archive_events(spark: SparkSession, sf_dir: str, lake: Lake, constraints=()) -> DataFrame:
    item = Archive("events.parquet", '"ts"', "events", constraints)
    plan = Plan("archive", (tables(sf_dir), lake), (Route("tables", lake.name, (item,)),))
    return read_landing(spark, lake, run(spark, plan).landed[0].landing)


@query("SELECT *, CAST(ts AS DATE) AS bucket_val FROM events")
def archive_day_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return day_bucket(table(spark, sf_dir, "events"), '"ts"')


@query(
    """
    SELECT *, CAST(ts AS DATE) AS bucket_val FROM events
    WHERE (event_type = 'purchase' OR event_type = 'click')
      AND CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
    """
)
def archive_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return day_bucket(constrain(table(spark, sf_dir, "events"), CONSTRAINTS), "ts")


@query("SELECT *, CAST(ts AS DATE) AS bucket_val FROM events")
def archive_partitioned_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_events(spark, sf_dir, target(spark, "orc"))


@query("SELECT *, CAST(ts AS DATE) AS bucket_val FROM events")
def archive_partitioned_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_events(spark, sf_dir, target(spark, "csv"))


@query(
    """
    SELECT *, CAST(ts AS DATE) AS bucket_val FROM events
    WHERE (event_type = 'purchase' OR event_type = 'click')
      AND CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
    """
)
def archive_constrained_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_events(spark, sf_dir, target(spark, "orc"), CONSTRAINTS)


@query(
    """
    SELECT *, CAST(ts AS DATE) AS bucket_val FROM events
    WHERE CAST(ts AS DATE) = DATE '2024-01-10'
    """
)
def archive_pruned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the directory of the day is opened."""
    landed = archive_events(spark, sf_dir, target(spark, "orc"))
    return landed.where("bucket_val = date'2024-01-10'")


@query(
    """
    SELECT *, CAST(ts AS DATE) AS bucket_val FROM events
    WHERE CAST(ts AS DATE) <> DATE '2024-01-10' OR event_type = 'purchase'
    """
)
def archive_rerun_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day is landed again; the other days stay as they are."""
    lake = target(spark, "orc", snapshots=False)
    events = day_bucket(table(spark, sf_dir, "events"), "ts")
    land(events, lake, "events", bucket="bucket_val")
    again = events.where("bucket_val = date'2024-01-10' AND event_type = 'purchase'")
    return read_landing(spark, lake, land(again, lake, "events", bucket="bucket_val"))
