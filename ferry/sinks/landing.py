"""Landing a DataFrame in a lake as files or as a database table."""

from __future__ import annotations

import json
import logging
import re
import time
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from ferry.functions.columns import backticked, column, comparable
from ferry.operators.reconciling import align, parts
from ferry.sinks import days
from ferry.sources import files, jdbc
from ferry.sources.lake import Lake, has_text
from ferry.sources.scans import escape_nulls, read_files, scan
from ferry.workspace import new_run_id

log = logging.getLogger(__name__)

BUCKET = "bucket_val"

# How often a table is overwritten until its rows are those that were sent.
_ATTEMPTS = 3


class SelfOverwrite(ValueError):
    """A transfer would overwrite the table it reads."""


@dataclass(frozen=True)
class Landing:
    """What one landing left behind; enough to read it back with its own types."""

    lake: str
    name: str
    path: str
    format: str
    schema: str
    rows: int | None
    seconds: float
    run_id: str
    # Rows that were there before and stayed, where rows were appended.
    rows_before: int = 0
    # What those rows add up to, part by part; not logged.
    anchor: Mapping[int, tuple[int, int, int]] | None = field(default=None, repr=False)

    def to_log(self, lake: Lake) -> str:
        """As JSON that says where in the lake, not where the lake is: its url may hold credentials."""
        base = lake.path()
        path = _LAKE + self.path.removeprefix(base) if not lake.is_jdbc and self.path.startswith(base) else self.path
        return json.dumps({k: v for k, v in asdict(replace(self, path=path, anchor=None)).items() if k != "anchor"})

    def place(self, lake: Lake) -> str:
        return lake.path() + self.path.removeprefix(_LAKE) if self.path.startswith(_LAKE) else self.path


# Stands for the lake's url in logged paths.
_LAKE = "{lake}"


def land(
    df: DataFrame,
    lake: Lake,
    name: str,
    *,
    mode: str | None = None,
    bucket: str | None = None,
    keep_other_days: bool = True,
    cluster: bool = True,
    files_per_table: int | None = None,
    tasks_per_day: int | None = None,
    column_types: str | None = None,
    run_id: str | None = None,
) -> Landing:
    """Write ``df`` to ``lake`` under ``name`` and say where and how many rows.

    ``mode`` defaults to the lake's write mode and holds for files as well as databases. Lakes
    with snapshots write a new run directory, which replaces the former ones for readers.

    ``bucket`` partitions files by that column. Rows are first brought together by day, by a plan of
    tasks made from the number of rows of each day: days that outgrow a task are cut, small ones are spread over all cores
    (what is no plain scan is left to adaptive execution). ``cluster=False`` skips that shuffle for input already in day order. Overwriting a
    bucketed landing replaces only the days at hand unless ``keep_other_days`` is off.

    ``tasks_per_day`` cuts every day into as many parts instead. Without adaptive execution that is how it is done, by
    default with four for each partition of the input: one day may be all of it.

    ``files_per_table`` forces a number of files; 1 puts everything through one task.
    """
    run_id = run_id or new_run_id()
    mode = (mode or lake.write_mode).lower()
    if lake.snapshots and mode != "overwrite":
        raise ValueError(f"lake {lake.name}: snapshots replace, they do not {mode}")
    started = time.monotonic()
    schema, before, anchor = df.schema, 0, None
    if mode == "append":
        before, anchor = _rows_there(df, lake, name)
    if lake.is_jdbc:
        path, rows = name, _to_database(df, lake, name, mode, column_types, run_id)
    else:
        path, rows = _to_files(
            df, lake, name, mode, bucket, keep_other_days, cluster, files_per_table, tasks_per_day, run_id
        )
        if bucket is not None:
            # Partition columns come last when files are read back.
            schema = T.StructType(
                [f for f in schema.fields if f.name != bucket] + [schema[bucket]]
            )
    return Landing(
        lake.name, name, path, lake.format, schema.json(), rows, time.monotonic() - started, run_id, before, anchor
    )


def read_landing(
    spark: SparkSession, lake: Lake, landing: Landing, split: jdbc.Split | None = None
) -> DataFrame:
    """The landed rows with the types they had when they were written; ``split`` is for databases."""
    if lake.is_jdbc:
        return scan(spark, lake, landing.path, split=split)
    schema = T.StructType.fromJson(json.loads(landing.schema))
    if lake.format == "csv":
        # Landed by us, so anything malformed is damage and must not turn into nulls.
        strict = {"mode": "FAILFAST", "enforceSchema": "false"} | dict(lake.options)
        lake = replace(lake, options=strict)
    return read_files(spark, lake, landing.place(lake), schema)


def _rows_there(df: DataFrame, lake: Lake, name: str) -> tuple[int, Mapping[int, tuple[int, int, int]] | None]:
    """How many rows a table holds before ``df`` is appended and, in an anchored lake, what they add up to.

    Without an anchor this is a count in the database, or of the files' own row counts.
    """
    spark = df.sparkSession
    if not (jdbc.table_exists(spark, lake, name) if lake.is_jdbc else files.children(spark, lake.path(name))):
        return 0, {}
    if lake.anchored:
        held = scan(spark, lake, name) if lake.is_jdbc else read_files(spark, lake, lake.path(name), df.schema)
        try:
            sums = parts(align(held, df.schema))
        except ValueError as e:
            log.warning("%s in lake %s is counted only: %s", name, lake.name, e)
        else:
            return sum(n for n, _, _ in sums.values()), sums
    return jdbc.count(spark, lake, name) if lake.is_jdbc else read_files(spark, lake, lake.path(name)).count(), None


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _to_files(
    df: DataFrame,
    lake: Lake,
    name: str,
    mode: str,
    bucket: str | None,
    keep_other_days: bool,
    cluster: bool,
    files_per_table: int | None,
    tasks_per_day: int | None,
    run_id: str,
) -> tuple[str, int | None]:
    spark = df.sparkSession
    path = lake.path(name, files.RUN + run_id) if lake.snapshots else lake.path(name)
    # Replacing single days happens after everything is read; replacing a directory, before.
    by_day = bucket is not None and keep_other_days
    if mode == "overwrite" and not lake.snapshots and not by_day:
        if files.reads_from(df, path):
            raise SelfOverwrite(f"{name} in lake {lake.name} would overwrite its own source")
    if mode == "ignore" and files.exists(spark, path):
        return path, None
    if lake.format == "csv":
        unsupported = [f.name for f in df.schema.fields if not fits_csv(f.dataType)]
        if unsupported:
            raise TypeError(f"csv cannot hold the columns {unsupported}")
        if lake.dialect == "lossless":
            df = escape_nulls(df)
    if bucket is not None and has_text(df.schema[bucket].dataType):
        df = df.withColumn(bucket, _not_empty(bucket))
    if files_per_table is not None:
        df = df.repartition(files_per_table)
    elif bucket is not None and cluster:
        df = _by_day(df, bucket, tasks_per_day)
    # Counted in the writing stage itself, whose tasks report once even if they ran twice.
    counted, seen = _counted(df)
    writer = counted.write.format(lake.format).options(**lake.write_options()).mode(mode)
    if bucket is not None:
        writer = writer.partitionBy(bucket)
        if by_day and mode == "overwrite" and not lake.snapshots:
            writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.save(path)
    return path, seen.get["rows"]


def _not_empty(bucket: str) -> Column:
    """A text partition value, which as a directory name could not be told from null if empty."""
    why = F.lit(f"an empty {bucket} would be read back as null")
    return F.when(column(bucket) == "", F.raise_error(why)).otherwise(column(bucket))


# What is read again at the cost of a scan. Anything else is computed once.
_SCANNED = {"Project", "Filter", "SubqueryAlias", "View", "LogicalRelation", "LogicalRDD", "LocalRelation", "Range", "Union"}


def _by_day(df: DataFrame, bucket: str, parts: int | None) -> DataFrame:
    """Bring the rows of a day together, but never more than a task should write, nor many days into one task.

    Tasks are planned from the rows of each day, which are counted first. What comes from joins or aggregates would be
    computed twice for that: there adaptive execution joins small days and cuts large ones.
    """
    if parts is None and df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        return days.by_partition(df, bucket) if _only_scans(df) else df.hint("rebalance", column(bucket))
    row = [column(f.name) for f in df.schema.fields if comparable(f.dataType)]
    # More parts than tasks, so that hashing them deals evenly.
    parts = parts or 4 * max(1, df.rdd.getNumPartitions())
    return df.repartition(column(bucket), F.pmod(F.xxhash64(*row), F.lit(parts)))


def _only_scans(df: DataFrame) -> bool:
    waiting = [df._jdf.queryExecution().optimizedPlan()]
    while waiting:
        node = waiting.pop()
        if node.nodeName() not in _SCANNED and not node.nodeName().startswith("Relation"):
            return False
        below = node.children().iterator()
        while below.hasNext():
            waiting.append(below.next())
    return True


def fits_csv(dtype: T.DataType) -> bool:
    return not isinstance(
        dtype, (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.NullType, T.VariantType)
    )


def _to_database(
    df: DataFrame, lake: Lake, table: str, mode: str, column_types: str | None, run_id: str
) -> int | None:
    """Write a table so that a task that ran twice cannot leave its rows twice, and old rows go last.

    Each task commits on its own, and one that is lost after its commit runs again. So the
    rows are counted in the database, and written again if they are too many. Where a table is there, they
    first go to one of their own beside it: its rows may be read by the very scan that replaces them, through a view
    or a synonym. Only when all staged rows are proven to be there they take the place of the old ones, or are
    added to them, in one step that counts them again.
    """
    spark = df.sparkSession
    there = jdbc.table_exists(spark, lake, table)
    if there and mode == "ignore":
        return None
    if there and mode in ("error", "errorifexists"):
        raise FileExistsError(f"table {table} in lake {lake.name} exists")
    if not there:
        return _write_table(df, lake, table, column_types)
    stage = jdbc.beside(table, f"_{re.sub(r'\W', '', run_id)[-16:]}")
    keeps_definition = mode == "append" or lake.atomic or str(lake.options.get("truncate", "")).lower() == "true"
    try:
        rows = _write_table(df, lake, stage, column_types)
        if keeps_definition:
            jdbc.move(spark, lake, stage, table, df.columns, rows, keep=mode == "append")
        else:
            jdbc.swap(spark, lake, stage, table, df.columns, rows)
    finally:
        if jdbc.table_exists(spark, lake, stage):
            jdbc.execute(spark, lake, [f"DROP TABLE {stage}"])
    return rows


def _write_table(df: DataFrame, lake: Lake, table: str, column_types: str | None) -> int:
    options = lake.jdbc_options()
    if column_types:
        options["createTableColumnTypes"] = column_types
    # Every task holds a connection. Spark's own limit would write a copy of the plan that
    # does not report its row count.
    limit = int(options.pop("numPartitions", lake.max_connections))
    for _ in range(_ATTEMPTS):
        # Dealt anew rather than merged into fewer tasks, which would hold for the source's scan as well.
        counted, seen = _counted(df.repartition(limit) if df.rdd.getNumPartitions() > limit else df)
        writer = counted.write.format("jdbc").options(**options).option("dbtable", table)
        writer.mode("overwrite").save()
        rows = seen.get["rows"]
        landed = jdbc.count(df.sparkSession, lake, table)
        if landed == rows:
            return rows
        log.warning("table %s: wrote %d rows, found %d", table, rows, landed)
    raise RuntimeError(f"table {table}: wrote {rows} rows, found {landed}")


def varchar_types(df: DataFrame, lengths: dict[str, int]) -> str:
    """``createTableColumnTypes`` for text columns whose longest value is known."""
    return ", ".join(f"{backticked(c)} VARCHAR({max(n, 1)})" for c, n in lengths.items())


def text_lengths(df: DataFrame, names: Sequence[str] | None = None) -> dict[str, int]:
    """The longest value of each text column, in one pass and one row."""
    names = names or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not names:
        return {}
    longest = df.agg(*[F.max(F.length(column(n))).alias(n) for n in names]).first()
    return {n: longest[n] or 1 for n in names}
