"""Databases: scans split into ranges, and statements that run inside the database."""

from __future__ import annotations

import hashlib
import logging
import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, datetime
from math import ceil, floor

from pyspark.sql import DataFrame, SparkSession, types as T

from ferry.functions.credentials import strip_url, without_secrets
from ferry.sources.lake import Lake

log = logging.getLogger(__name__)

# A histogram this fine per partition keeps equal-count ranges within a few percent.
_BINS_PER_PARTITION = 64
_MAX_BINS = 8192
_MAX_DEPTH = 4


@dataclass(frozen=True)
class Split:
    """How to read a table with several connections.

    ``column`` should be numeric, a date or a timestamp, and close to unique: rows that share
    one value always travel together. Bounds are asked of the database when not given.
    ``balanced`` (numeric columns) cuts at equal row counts in place of equal widths, for
    columns whose values cluster.
    """

    column: str
    partitions: int
    lower: str | None = None
    upper: str | None = None
    balanced: bool = False


# Over one connection, without asking the database how a table could be split.
WHOLE = Split("", 1)


def read(spark: SparkSession, lake: Lake, source: str, split: Split | None = None) -> DataFrame:
    """A table or ``( select … ) alias``; the text runs in the database.

    Without a ``split`` a table is split by its primary key or a unique index of one column, if that is a
    number or a date, else by its first such column: numbers at equal row counts, which the
    database counts. So is a ``( select … ) alias``, by its first such column, unless its rows may differ when it
    is asked again; every connection asks for its range of it.
    """
    whole = _reader(spark, lake).option("dbtable", source)
    if split is None and lake.max_connections > 1 and _repeatable(source):
        split = _by_itself(spark, lake, source)
    if split is None or split.partitions < 2:
        return whole.load()
    lower, upper, rows = split.lower, split.upper, None
    if lower is None or upper is None:
        lower, upper, rows = _bounds(spark, lake, source, split)
    if lower is None:
        return whole.load()
    if split.balanced or isinstance(lower, datetime):
        if split.balanced:
            rows = count(spark, lake, source) if rows is None else rows
            cuts = _equal_counts(spark, lake, source, split, float(lower), float(upper), rows)
        else:
            # Spark's own bounds know no timestamps without time zone.
            step = (upper - lower) / split.partitions
            cuts = [f"{{ts '{lower + step * i}'}}" for i in range(1, split.partitions)]
        predicates = _ranges(quote(spark, lake, split.column), cuts)
        options = lake.jdbc_options()
        return spark.read.jdbc(options.pop("url"), source, predicates=predicates, properties=options)
    if not isinstance(lower, (str, date)):
        lower, upper = floor(lower), ceil(upper)
    return (
        whole.option("partitionColumn", quote(spark, lake, split.column))
        .option("lowerBound", str(lower))
        .option("upperBound", str(upper))
        .option("numPartitions", split.partitions)
        .load()
    )


# Floating-point numbers may be NaN or infinite, which are no bounds.
_SPLITTABLE = (T.IntegralType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)

# Words of a subselect whose rows, or their order, may be others when it is asked again, or that would be lost in ranges.
_UNREPEATABLE = re.compile(
    r"\b(limit|fetch|offset|top|rownum|order|over|sample|tablesample|rand|random|uuid|newid|sys_guid|nextval|next\s+value|identity\w*|sysdate|systimestamp|now|getdate|current\w*|localtime\w*)\b",
    re.IGNORECASE,
)
_QUOTED = re.compile(r"'[^']*'|\"[^\"]*\"|`[^`]*`|\[[^\]]*\]")


def _repeatable(source: str) -> bool:
    """Whether every connection that asks for a part of the source sees the same rows of it."""
    return not source.strip().startswith("(") or _UNREPEATABLE.search(_QUOTED.sub("''", source)) is None


def _by_itself(spark: SparkSession, lake: Lake, table: str) -> Split | None:
    """How to read a table or a subselect over as many connections as the lake allows."""
    fields = [f for f in _reader(spark, lake).option("dbtable", table).load().schema if isinstance(f.dataType, _SPLITTABLE)]
    by_name = {f.name.lower(): f for f in fields}
    indexed = [] if table.strip().startswith("(") else [primary_key(spark, lake, table), *unique_indexes(spark, lake, table)]
    for keys in indexed:
        if len(keys) == 1 and keys[0].lower() in by_name:
            return Split(by_name[keys[0].lower()].name, lake.max_connections)
    if not fields:
        return None
    return Split(fields[0].name, lake.max_connections, balanced=isinstance(fields[0].dataType, T.NumericType))


def _reader(spark: SparkSession, lake: Lake):
    return spark.read.format("jdbc").options(**lake.jdbc_options())


def _derived(source: str, alias: str) -> str:
    """A source as it may stand in a FROM clause."""
    return source if source.strip().startswith("(") else f"{source} {alias}"


def _bounds(spark: SparkSession, lake: Lake, source: str, split: Split):
    """Least and greatest value and, where ranges of equal counts are wanted, the rows: one statement."""
    name = quote(spark, lake, split.column)
    rows = "COUNT(*)" if split.balanced else "0"
    sql = f"(SELECT MIN({name}) AS lo, MAX({name}) AS hi, {rows} AS n FROM {_derived(source, 's')}) b"
    return tuple(read(spark, lake, sql, WHOLE).first())


def _equal_counts(
    spark: SparkSession, lake: Lake, source: str, split: Split, lo: float, hi: float, rows: int
) -> list[str]:
    """Cuts between ranges of about equal row counts."""
    target = rows / split.partitions
    cuts, filled = [], 0
    edges = _histogram(spark, lake, source, split, lo, hi, target, _MAX_DEPTH)
    for edge, n in edges[:-1]:
        filled += n
        if filled >= target:
            cuts.append(repr(edge))
            filled = 0
    return cuts


def _histogram(
    spark: SparkSession,
    lake: Lake,
    source: str,
    split: Split,
    lo: float,
    hi: float,
    target: float,
    depth: int,
) -> list[tuple[float, int]]:
    """(upper edge, rows) of bins, counted by the database; at most ``_MAX_BINS`` come back.

    A bin that alone outgrows a partition is cut again, so clustered values are spread too.
    """
    name = quote(spark, lake, split.column)
    bins = min(split.partitions * _BINS_PER_PARTITION, _MAX_BINS)
    width = (hi - lo) / bins
    if lo + width <= lo:
        return [(hi, 0)]
    sql = (
        f"(SELECT b, COUNT(*) AS n FROM (SELECT CAST(FLOOR(({name} - {lo!r}) / {width!r}) "
        f"AS INTEGER) AS b FROM {_derived(source, 's')} WHERE {name} >= {lo!r} AND {name} <= {hi!r}"
        f") h GROUP BY b) g"
    )
    edges: list[tuple[float, int]] = []
    for b, n in sorted((int(b), int(n)) for b, n in read(spark, lake, sql, WHOLE).toLocalIterator()):
        low, high = lo + b * width, lo + (b + 1) * width
        if n > target and depth > 0:
            edges += _histogram(spark, lake, source, split, low, high, target, depth - 1)
        else:
            edges.append((high, n))
    return edges


def _ranges(name: str, cuts: Sequence[str]) -> list[str]:
    """Predicates that cover every row once; nulls go with the lowest values."""
    if not cuts:
        return ["1 = 1"]
    return [
        f"({name} < {cuts[0]} OR {name} IS NULL)",
        *(f"({name} >= {a} AND {name} < {b})" for a, b in zip(cuts, cuts[1:])),
        f"({name} >= {cuts[-1]})",
    ]


def quote(spark: SparkSession, lake: Lake, name: str) -> str:
    """A column name quoted as the database wants it; quoted names stay as they are."""
    if name[:1] in '"`[':
        return name
    return spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(lake.url).quoteIdentifier(name)


def count(spark: SparkSession, lake: Lake, source: str) -> int:
    sql = f"(SELECT COUNT(*) AS n FROM {_derived(source, 's')}) c"
    return int(read(spark, lake, sql, WHOLE).first()[0])


@contextmanager
def _connection(spark: SparkSession, lake: Lake) -> Iterator:
    """One connection on the driver, for statements only; rows never travel over it."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
    none = gateway.new_array(jvm.java.lang.Object, 0)
    driver = (
        loader.loadClass(lake.driver)
        .getDeclaredConstructor(gateway.new_array(jvm.java.lang.Class, 0))
        .newInstance(none)
    )
    properties = jvm.java.util.Properties()
    for key, value in ({"user": lake.username, "password": lake.password} | dict(lake.options)).items():
        properties.setProperty(key, str(value))
    connection = driver.connect(lake.url, properties)
    if connection is None:
        raise ValueError(f"the driver {lake.driver} does not accept {strip_url(lake.url)}")
    try:
        yield connection
    finally:
        connection.close()


def primary_key(spark: SparkSession, lake: Lake, table: str) -> list[str]:
    """Columns of a table's primary key, as the database describes it."""
    with _connection(spark, lake) as connection:
        about = connection.getMetaData()
        *schema, name = [_stored(about, p) for p in _parts(table)]
        found = about.getPrimaryKeys(None, schema[-1] if schema else None, name)
        keys = []
        while found.next():
            keys.append((found.getInt("KEY_SEQ"), found.getString("COLUMN_NAME")))
    return [k for _, k in sorted(keys)]


def unique_indexes(spark: SparkSession, lake: Lake, table: str) -> list[list[str]]:
    """Columns of a table's unique indexes, as the database describes them."""
    with _connection(spark, lake) as connection:
        about = connection.getMetaData()
        *schema, name = [_stored(about, p) for p in _parts(table)]
        found = about.getIndexInfo(None, schema[-1] if schema else None, name, True, True)
        indexes: dict[str, list[tuple[int, str]]] = {}
        while found.next():
            if found.getString("COLUMN_NAME"):
                indexes.setdefault(found.getString("INDEX_NAME"), []).append((found.getInt("ORDINAL_POSITION"), found.getString("COLUMN_NAME")))
    return [[c for _, c in sorted(columns)] for columns in indexes.values()]


def _parts(table: str) -> list[str]:
    """The parts of a table's name, quoted ones with their quotes."""
    return re.findall(r'"(?:[^"]|"")+"|[^."]+', table.strip())


def identity(spark: SparkSession, lake: Lake, table: str) -> tuple[str, str]:
    """(schema, name) as the catalog holds them; a bare name is in the connection's own schema."""
    with _connection(spark, lake) as connection:
        about = connection.getMetaData()
        *schema, name = [_stored(about, p) for p in _parts(table)]
        return (schema[-1] if schema else connection.getSchema() or ""), name


def beside(table: str, suffix: str) -> str:
    """The name of a table in the same schema, whether quoted or not."""
    *schema, name = _parts(table)
    name = f'{name[:-1]}{suffix}"' if name.endswith('"') else name + suffix
    return ".".join([*schema, name])


def _stored(about, name: str) -> str:
    """A name as the catalog holds it: quoted ones as they are, others in its own case."""
    if name.startswith('"'):
        return name[1:-1]
    if about.storesUpperCaseIdentifiers():
        return name.upper()
    return name.lower() if about.storesLowerCaseIdentifiers() else name


def tables(spark: SparkSession, lake: Lake, schema: str | None = None) -> list[tuple[str, str]]:
    """(schema, name) of the tables that the database's catalog lists."""
    kinds = spark.sparkContext._gateway.new_array(spark._jvm.java.lang.String, 1)
    kinds[0] = "TABLE"
    with _connection(spark, lake) as connection:
        found = connection.getMetaData().getTables(None, schema, "%", kinds)
        names = []
        while found.next():
            names.append((found.getString("TABLE_SCHEM") or "", found.getString("TABLE_NAME")))
    return sorted(names)


class Miscounted(RuntimeError):
    """A statement touched another number of rows than were sent; nothing was committed."""


def execute(spark: SparkSession, lake: Lake, statements: Sequence[str], rows: int | None = None) -> None:
    """Run statements inside the database as one transaction; with ``rows`` the last must touch as many."""
    with _connection(spark, lake) as connection:
        connection.setAutoCommit(False)
        try:
            statement = connection.createStatement()
            for sql in statements:
                statement.execute(sql)
            touched = statement.getUpdateCount()
            if rows is not None and touched != rows:
                raise Miscounted(f"{touched} rows in place of {rows}: {statements[-1]}")
            connection.commit()
        except Exception:
            connection.rollback()
            raise


def move(spark: SparkSession, lake: Lake, stage: str, table: str, names: Sequence[str], rows: int, keep: bool) -> None:
    """Add the staged rows to a table, or put them in place of its own unless ``keep``, all or none.

    The table keeps its definition, and views and synonyms of it go on. Columns are matched by name.
    """
    held = {c.lower(): c for c in read(spark, lake, table, WHOLE).columns}
    lacking = [c for c in names if c.lower() not in held]
    if lacking:
        raise ValueError(f"table {table} has no columns {lacking}")
    into = ", ".join(quote(spark, lake, held[c.lower()]) for c in names)
    given = ", ".join(quote(spark, lake, c) for c in names)
    empty = [] if keep else [f"DELETE FROM {table}"]
    execute(spark, lake, [*empty, f"INSERT INTO {table} ({into}) SELECT {given} FROM {stage}"], rows)


def swap(spark: SparkSession, lake: Lake, stage: str, table: str, names: Sequence[str], rows: int) -> None:
    """Put a staged table in a table's place, with the staged definition.

    The old table steps aside under another name and goes last, so at every moment one of the two is there whole, also in
    databases where such statements are no transaction. What the database does not let go, since a view reads it or
    since the name is a view or synonym itself, keeps its definition and gets the staged rows, all or none.
    """
    aside = beside(table, f"_{hashlib.blake2b(stage.encode(), digest_size=5).hexdigest()}")
    try:
        execute(spark, lake, [_rename(lake, table, aside), _rename(lake, stage, table), f"DROP TABLE {aside}"])
    except Exception as refused:
        if not table_exists(spark, lake, table) and table_exists(spark, lake, aside):
            execute(spark, lake, [_rename(lake, aside, table)])
        if not table_exists(spark, lake, stage):
            # The staged table has its place, and only the old one could not be dropped.
            log.warning("table %s is replaced, %s remains: %s", table, aside, without_secrets(str(refused).splitlines()[0]))
            return
        move(spark, lake, stage, table, names, rows, keep=False)


def _rename(lake: Lake, table: str, to: str) -> str:
    """How databases rename a table; the new name stays in the schema."""
    bare = _parts(to)[-1]
    if lake.url.startswith("jdbc:derby:"):
        return f"RENAME TABLE {table} TO {bare}"
    if lake.url.startswith("jdbc:sqlserver:"):
        return f"EXEC sp_rename '{table}', '{bare.strip(chr(34))}'"
    return f"ALTER TABLE {table} RENAME TO {bare}"


# Holds for every staging table, by the hash of its name, which landing is in it and which was merged.
_MERGES = "ferry_merges"


def _staging_key(spark: SparkSession, lake: Lake, staging: str) -> int:
    name = ".".join(identity(spark, lake, staging))
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=7).digest(), "big")


def mark_staged(spark: SparkSession, lake: Lake, staging: str) -> None:
    """Note that a staging table holds rows that are not merged yet."""
    if not table_exists(spark, lake, _MERGES):
        execute(spark, lake, [f"CREATE TABLE {_MERGES} (staging_key BIGINT, merged INTEGER)"])
    key = _staging_key(spark, lake, staging)
    forget = f"DELETE FROM {_MERGES} WHERE staging_key = {key}"
    execute(spark, lake, [forget, f"INSERT INTO {_MERGES} (staging_key, merged) VALUES ({key}, 0)"])


def merged_statements(spark: SparkSession, lake: Lake, staging: str) -> list[str]:
    """What notes, in the transaction that merges, that a staging table's rows are merged."""
    if not table_exists(spark, lake, _MERGES):
        return []
    key = _staging_key(spark, lake, staging)
    return [f"UPDATE {_MERGES} SET merged = 1 WHERE staging_key = {key}"]


def is_merged(spark: SparkSession, lake: Lake, staging: str) -> bool:
    """Whether what a staging table holds was merged; if nothing is known, it was not."""
    if not table_exists(spark, lake, _MERGES):
        return False
    key = _staging_key(spark, lake, staging)
    sql = f"(SELECT merged FROM {_MERGES} WHERE staging_key = {key}) m"
    return any(r[0] == 1 for r in read(spark, lake, sql, WHOLE).collect())


def table_exists(spark: SparkSession, lake: Lake, table: str) -> bool:
    """Whether Spark's own existence check finds the table; a lost connection still raises."""
    jvm = spark._jvm
    dialect = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(lake.url)
    with _connection(spark, lake) as connection:
        try:
            connection.createStatement().executeQuery(dialect.getTableExistsQuery(table)).close()
            return True
        except Exception:
            if connection.isValid(10):
                return False
            raise
