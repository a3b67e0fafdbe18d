"""Scans: one entry point that turns (lake, source) into a lazy DataFrame."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ferry.functions.columns import column
from ferry.sources import files, jdbc
from ferry.sources.lake import Lake, has_text, join_uri

_SUBSELECT = re.compile(
    r"""^\(\s*(?P<sql>(?:select|with)\b.*)\)\s*(?:as\s+)?["`]?\w*["`]?$""", re.I | re.S
)

# Temporary views belong to the whole session, so only one thread names them at a time.
_views = Lock()


def is_subselect(source: str) -> bool:
    return _SUBSELECT.match(source.strip()) is not None


def scan(
    spark: SparkSession,
    lake: Lake,
    source: str,
    schema: T.StructType | None = None,
    split: jdbc.Split | None = None,
) -> DataFrame:
    """A table, a file, a directory, or ``( select … ) alias`` of a lake, as a DataFrame.

    Nothing but the schema is read here. ``split`` reads a database in parallel.
    """
    if lake.is_jdbc:
        return jdbc.read(spark, lake, source, split)
    if is_subselect(source):
        return _sql_over_files(spark, lake, source)
    return read_files(spark, lake, current_path(spark, lake, lake.path(source)), schema)


def current_path(spark: SparkSession, lake: Lake, path: str) -> str:
    """Where a table's rows are: below its latest completed run, if it has runs.

    What is on disk decides, whatever the lake says: masters have runs in every lake.
    """
    return files.latest_run(spark, path) or path


# Names the files of a version that shares some with versions before; hidden from readers.
MANIFEST = "_manifest"


def _files_of(spark: SparkSession, path: str | list[str]) -> str | list[str]:
    """The files that a run's manifest names, if it has one, else the path itself."""
    if not isinstance(path, str) or not path.rsplit("/", 1)[-1].startswith(files.RUN):
        return path
    place = join_uri(path, MANIFEST)
    if not files.exists(spark, place):
        return path
    table = path.rsplit("/", 1)[0]
    return [join_uri(table, f) for f in json.loads(files.read_text(spark, place))["paths"]] or path


def read_files(
    spark: SparkSession, lake: Lake, path: str | list[str], schema: T.StructType | None = None
) -> DataFrame:
    """What is at a path, or in the files that a master's version there is made of."""
    path = _files_of(spark, path)
    reader = spark.read.format(lake.format).options(**lake.read_options(schema))
    if schema is not None:
        reader = reader.schema(schema)
    with _few_listing_tasks(spark):
        df = reader.load(path)
    return unescape_nulls(df) if lake.format == "csv" and lake.dialect == "lossless" else df


# Directories are listed by so many tasks a core; Spark's own default is one task a directory.
_LISTING_TASKS = 4
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_listing_lock = Lock()
_listing: list[str] = []


@contextmanager
def _few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """List directories by a few tasks with many each while a table is opened; the session's own setting comes back.

    The setting is the session's, so threads that open tables at the same time share it: the first keeps what it
    was, the last puts it back. It decides how many tasks there are, never what they find.
    """
    with _listing_lock:
        _listing.append(spark.conf.get(_LISTING, "10000") if not _listing else _listing[0])
        spark.conf.set(_LISTING, str(min(int(_listing[0]), _LISTING_TASKS * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        with _listing_lock:
            before = _listing.pop()
            if not _listing:
                spark.conf.set(_LISTING, before)


# Null is written as \N, so text that reads \N itself carries one more backslash.
def _rewrite_text(df: DataFrame, rewrite) -> DataFrame:
    def each(f: T.StructField) -> Column:
        col = column(f.name)
        return rewrite(col).alias(f.name) if has_text(f.dataType) else col

    return df.select([each(f) for f in df.schema.fields])


def escape_nulls(df: DataFrame) -> DataFrame:
    return _rewrite_text(
        df, lambda c: F.when(c.rlike(r"^\\+N$"), F.concat(F.lit("\\"), c)).otherwise(c)
    )


def unescape_nulls(df: DataFrame) -> DataFrame:
    return _rewrite_text(
        df, lambda c: F.when(c.rlike(r"^\\{2,}N$"), F.substring(c, 2, 2_147_483_647)).otherwise(c)
    )


def _sql_over_files(spark: SparkSession, lake: Lake, source: str) -> DataFrame:
    """Run a subselect over the tables of a file lake.

    Only the children of the lake that the text mentions are opened. Spark resolves the
    text at once, so the names are needed no longer than this call.
    """
    sql = _SUBSELECT.match(source.strip())["sql"]
    children = [(_view_name(p), p) for p in files.children(spark, lake.url)]
    found = [(n, p) for n, p in children if re.search(rf"(?<!\w){re.escape(n)}(?!\w)", sql, re.I)]
    mentioned = dict(found)
    if len({n.lower() for n in mentioned}) < len(found):
        raise ValueError(f"several files of lake {lake.name} are called one of {sorted(mentioned)}")
    with _views, _named(spark, lake, mentioned):
        return spark.sql(sql)


def _view_name(path: str) -> str:
    """A table's name as SQL can say it: what is no letter, digit or underscore becomes one."""
    return re.sub(r"\W", "_", files.table_name(path))


@contextmanager
def _named(spark: SparkSession, lake: Lake, tables: dict[str, str]) -> Iterator[None]:
    """Temporary views for the tables; views of the same name come back afterwards."""
    hidden = {}
    try:
        for name, path in tables.items():
            if _is_view(spark, name):
                hidden[name] = spark.table(name)
            df = read_files(spark, lake, current_path(spark, lake, path))
            df.createOrReplaceTempView(name)
        yield
    finally:
        for name in tables:
            spark.catalog.dropTempView(name)
        for name, df in hidden.items():
            df.createOrReplaceTempView(name)


def _is_view(spark: SparkSession, name: str) -> bool:
    try:
        return spark.catalog.getTable(name).isTemporary
    except AnalysisException:
        return False
