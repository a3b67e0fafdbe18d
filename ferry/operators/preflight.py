"""Checks before a run: do the lakes exist, can the sources be read, do the sinks fit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ferry.functions.columns import column
from ferry.sinks.landing import fits_csv
from ferry.sources import files, jdbc
from ferry.sources.lake import Lake
from ferry.sources.scans import scan
from ferry.workspace import new_run_id

# The sinks a source is judged against.
SINKS = ("csv", "orc", "jdbc")


def fits(dtype: T.DataType, sink: str) -> bool:
    """Whether a sink can hold a column type and give it back."""
    if sink == "csv":
        return fits_csv(dtype)
    if sink == "jdbc":
        return not isinstance(
            dtype,
            (T.ArrayType, T.MapType, T.StructType, T.NullType, T.VariantType, T.DayTimeIntervalType),
        )
    return not isinstance(dtype, (T.NullType, T.VariantType))


def profile(df: DataFrame) -> DataFrame:
    """One row per column: type, fit for every sink, null count and longest text.

    The nulls say which columns a NOT NULL destination refuses, the longest text how wide its
    text columns must be. One pass, one row per task; wide text is measured, not moved.
    """
    none = F.lit(None).cast("int")

    def measured(f: T.StructField) -> Column:
        col = column(f.name)
        length = F.max(F.length(col)) if isinstance(f.dataType, T.StringType) else none
        return F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            *[F.lit(fits(f.dataType, s)).alias(f"fits_{s}") for s in SINKS],
            F.count_if(col.isNull()).alias("nulls"),
            length.alias("longest"),
        )

    return df.agg(F.array(*[measured(f) for f in df.schema.fields]).alias("columns")).select(
        F.inline("columns")
    )


def missing_lakes(plan: DataFrame, lakes: DataFrame) -> DataFrame:
    """Plan rows (source_lake, destination_lake, …) whose lakes are not all known.

    ``unknown`` names the lake. Works for plans and lake lists of any size.
    """
    names = lakes.select(F.col("name").alias("unknown")).distinct()
    ends = plan.withColumn(
        "unknown", F.explode(F.array_distinct(F.array("source_lake", "destination_lake")))
    )
    return ends.join(names, "unknown", "left_anti").select(*plan.columns, "unknown")


def problems(
    spark: SparkSession, source: Lake, source_name: str, destination: Lake, table: str
) -> list[str]:
    """What would stop a transfer, found from schemas alone; no rows are read."""
    try:
        schema = scan(spark, source, source_name, split=jdbc.WHOLE).schema
    except Exception as e:
        return [f"cannot read {source_name} in lake {source.name}: {type(e).__name__}"]
    found = [
        f"{destination.format} cannot hold {f.name} {f.dataType.simpleString()}"
        for f in schema.fields
        if not fits(f.dataType, destination.format)
    ]
    if destination.write_mode != "append":
        return found
    if destination.is_jdbc:
        if not jdbc.table_exists(spark, destination, table):
            return found
    elif destination.snapshots or not files.exists(spark, destination.path(table)):
        return found
    held = {c.lower() for c in scan(spark, destination, table, split=jdbc.WHOLE).columns}
    given = {c.lower() for c in schema.names}
    found += [f"{table} lacks the column {c}" for c in sorted(given - held)]
    found += [f"{table} has a column {c} that the source lacks" for c in sorted(held - given)]
    return found


def writable(spark: SparkSession, lake: Lake) -> str | None:
    """Create and drop an empty table; the reason if that fails, else nothing."""
    table = "probe_" + new_run_id()[-8:]
    try:
        if lake.is_jdbc:
            jdbc.execute(spark, lake, [f"CREATE TABLE {table} (a INTEGER)", f"DROP TABLE {table}"])
        else:
            files.probe(spark, lake.path(table))
    except Exception as e:
        return f"cannot write to lake {lake.name}: {type(e).__name__}"
    return None
