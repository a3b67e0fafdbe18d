"""Proving that a landed copy equals its source, over every row and every cell.

Rows are matched by fingerprint: each side is read once, one row becomes 16 bytes, equal
rows of a task are counted together before the shuffle, and only rows that differ are ever
moved whole. Neither a key nor a row that holds much of the table lands on one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ferry.functions.columns import column, fingerprint, rendered
from ferry.workspace import scratch

SOURCE, LANDED = "source", "landed"


def align(df: DataFrame, schema: T.StructType, by_position: bool = False) -> DataFrame:
    """A landed table with the names, order and types of its source.

    Columns are matched by name, whatever its case, or by position. A cell that cannot be
    read as its source's type fails the job with its value; it is never made null.
    """
    if by_position:
        if len(df.columns) != len(schema):
            raise ValueError(f"{len(schema)} source columns but {len(df.columns)} landed ones")
        held = dict(zip(schema.names, df.columns))
    else:
        lower = {c.lower(): c for c in df.columns}
        held = {n: lower[n.lower()] for n in schema.names if n.lower() in lower}
        if len(held) != len(schema) or len(df.columns) != len(schema):
            raise ValueError(f"columns differ: source {schema.names}, landed {df.columns}")

    def cast(f: T.StructField) -> Column:
        raw = column(held[f.name])
        if df.schema[held[f.name]].dataType == f.dataType:
            return raw.alias(f.name)
        typed = raw.try_cast(f.dataType)
        bad = F.concat(F.lit(f"landed {f.name} is no {f.dataType.simpleString()}: "), raw.cast("string"))
        return F.when(raw.isNotNull() & typed.isNull(), F.raise_error(bad)).otherwise(typed).alias(f.name)

    return df.select([cast(f) for f in schema.fields])


def _counted(src: DataFrame, dst: DataFrame) -> DataFrame:
    """(__fp, n_src, n_dst): how often each distinct row occurs on either side."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    left = src.select(fingerprint(src).alias("__fp"), one.alias("s"), none.alias("d"))
    right = dst.select(fingerprint(dst).alias("__fp"), none.alias("s"), one.alias("d"))
    return left.unionAll(right).groupBy("__fp").agg(F.sum("s").alias("n_src"), F.sum("d").alias("n_dst"))


def reconcile(src: DataFrame, dst: DataFrame, by_position: bool = False) -> DataFrame:
    """One row: src_rows, dst_rows, missing (source rows not landed) and extra (the reverse).

    Rows are compared as multisets, so a row that is there twice must have landed twice.
    """
    dst = align(dst, src.schema, by_position)
    diff = F.col("n_src") - F.col("n_dst")
    none = F.lit(0).cast("long")
    return _counted(src, dst).agg(
        *[
            F.coalesce(F.sum(c), none).alias(name)
            for name, c in {
                "src_rows": F.col("n_src"),
                "dst_rows": F.col("n_dst"),
                "missing": F.greatest(diff, none),
                "extra": F.greatest(-diff, none),
            }.items()
        ]
    )


def rows_if_equal(src: DataFrame, dst: DataFrame, by_position: bool = False) -> int | None:
    """The row count of two tables that hold the same rows as often; nothing if they differ.

    Each side is reduced to its count and the sums of its rows' two hashes, one row per task, in one pass: a proof
    but for a chance of 2^-128, and no row is shuffled. Only tables that differ need ``reconcile``.
    """
    dst = align(dst, src.schema, by_position)

    def sums(df: DataFrame) -> DataFrame:
        hashes = df.select(fingerprint(df).alias("__fp"))
        wide = [F.sum(F.col("__fp")[c].cast("decimal(20,0)")).alias(c) for c in ("a", "b")]
        return hashes.agg(F.count(F.lit(1)).alias("n"), *wide)

    left, right = sums(src).unionAll(sums(dst)).collect()
    return left["n"] if left == right else None


# Into so many parts rows are dealt by their fingerprints where a table is compared by sums.
PARTS = 1024


def parts(df: DataFrame) -> dict[int, tuple[int, int, int]]:
    """Rows and the sums of their two hashes, by part; one row per part comes to the driver."""
    return _sums([df])[0]


def _sums(frames: Sequence[DataFrame]) -> list[dict[int, tuple[int, int, int]]]:
    each = [df.select(F.lit(i).alias("side"), fingerprint(df).alias("__fp")) for i, df in enumerate(frames)]
    every = each[0]
    for more in each[1:]:
        every = every.unionAll(more)
    wide = [F.sum(F.col("__fp")[c].cast("decimal(20,0)")).alias(c) for c in ("a", "b")]
    by = every.groupBy("side", F.pmod(F.col("__fp")["b"], F.lit(PARTS)).alias("part")).agg(F.count(F.lit(1)).alias("n"), *wide)
    found: list[dict[int, tuple[int, int, int]]] = [{} for _ in frames]
    for r in by.toLocalIterator():
        found[r["side"]][r["part"]] = (r["n"], int(r["a"]), int(r["b"]))
    return found


def reconcile_appended(
    src: DataFrame, dst: DataFrame, before: Mapping[int, tuple[int, int, int]], by_position: bool = False
) -> tuple[int, int, int, int]:
    """(src_rows, dst_rows, missing, extra) of rows appended to a table that held what ``parts`` said ``before``.

    From the rows and sums of each part those of before are subtracted, so a lost row is missed though an equal one was
    there already. A part whose rows differ in number is short of, or ahead by, that many; one whose rows are as many but add up
    differently has one row in place of another at least. So the counts are exact where a part has differences of one
    kind, and never zero if the tables differ (but for a chance of 2^-128).
    """
    sent, held = _sums([src, align(dst, src.schema, by_position)])
    none, missing, extra = (0, 0, 0), 0, 0
    for part in sent.keys() | held.keys() | before.keys():
        n, a, b = (s + o - h for s, o, h in zip(sent.get(part, none), before.get(part, none), held.get(part, none)))
        changed = int(n == 0 and (a, b) != (0, 0))
        missing, extra = missing + max(n, 0) + changed, extra + max(-n, 0) + changed
    return sum(x[0] for x in sent.values()), sum(x[0] for x in held.values()) - sum(x[0] for x in before.values()), missing, extra


def reconcile_rows(src: DataFrame, dst: DataFrame, by_position: bool = False) -> DataFrame:
    """Every row that differs, once, as (_side, _copies, *columns).

    ``_copies`` is by how many occurrences the side is ahead. The fingerprints that differ are
    written to the shared folder, so the size of the join below is known when it is planned:
    with few differences both tables are filtered in place by a broadcast.
    """
    spark = src.sparkSession
    dst = align(dst, src.schema, by_position)
    path = scratch(spark, "reconcile")
    _counted(src, dst).where("n_src <> n_dst").write.parquet(path)
    differing = spark.read.schema("__fp struct<a:long,b:long>, n_src long, n_dst long").parquet(path)

    def side(df: DataFrame, label: str, ahead: Column) -> DataFrame:
        marked = differing.where(ahead > 0).select("__fp", ahead.alias("__copies"))
        row = F.struct(*[column(c) for c in df.columns]).alias("__row")
        found = df.select(row, fingerprint(df).alias("__fp")).join(marked, "__fp")
        # Copies of a row are equal: each task keeps one of them before the next shuffle. That
        # shuffle is by another order of the hashes, so that adaptive execution is free to
        # split the join for a row with many copies.
        single = found.groupBy(F.struct("__fp.b", "__fp.a").alias("__same")).agg(
            F.any_value("__row").alias("__row"), F.any_value("__copies").alias("__copies")
        )
        return single.select(F.lit(label).alias("_side"), F.col("__copies").alias("_copies"), "__row.*")

    return side(src, SOURCE, F.col("n_src") - F.col("n_dst")).unionAll(
        side(dst, LANDED, F.col("n_dst") - F.col("n_src"))
    )


def cells(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Differing rows, as ``reconcile_rows`` gives them, broken down to cells.

    Columns: the keys, ``kind``, ``column``, ``src``, ``dst``. A key that differs in one row on
    either side is ``changed`` and has a line per differing cell. ``missing`` and ``extra``
    rows have a line per cell. A key with several differing rows on a side does not say which
    rows belong together: it is ``ambiguous`` and has one line with the two row counts.
    """
    schema = T.StructType(rows.schema.fields[2:])
    values = [f for f in schema.fields if f.name not in keys]
    cell = F.struct(
        *[rendered(column(f.name), f.dataType).alias(f"v{i}") for i, f in enumerate(values)],
        F.lit(True).alias("present"),
    )
    none = F.lit(None).cast("string")

    def ahead(label: str) -> Column:
        return F.sum(F.when(F.col("_side") == label, F.col("_copies")).otherwise(0))

    def row_of(label: str) -> Column:
        return F.first(F.when(F.col("_side") == label, cell), ignorenulls=True)

    by_key = rows.groupBy(*[column(k) for k in keys]).agg(
        ahead(SOURCE).alias("__n_src"),
        ahead(LANDED).alias("__n_dst"),
        row_of(SOURCE).alias("__src"),
        row_of(LANDED).alias("__dst"),
    )
    n_src, n_dst = F.col("__n_src"), F.col("__n_dst")
    kind = (
        F.when((n_src > 1) | (n_dst > 1), "ambiguous")
        .when(n_dst == 0, "missing")
        .when(n_src == 0, "extra")
        .otherwise("changed")
    )

    def line(name: Column, src: Column, dst: Column) -> Column:
        return F.struct(name.alias("column"), src.alias("src"), dst.alias("dst"))

    every = F.array(
        *[
            line(F.lit(f.name), F.col("__src")[f"v{i}"], F.col("__dst")[f"v{i}"])
            for i, f in enumerate(values)
        ]
    )
    whole = every if values else F.array(line(none, none, none))
    counts = F.array(line(none, n_src.cast("string"), n_dst.cast("string")))
    changed = F.filter(every, lambda x: ~x["src"].eqNullSafe(x["dst"])) if values else whole
    report = (
        F.when(F.col("kind") == "ambiguous", counts)
        .when(F.col("kind") == "changed", changed)
        .otherwise(whole)
    )
    named_keys = [column(k) for k in keys]
    return (
        by_key.withColumn("kind", kind)
        .select(*named_keys, "kind", F.explode(report).alias("__cell"))
        .select(*named_keys, "kind", "__cell.column", "__cell.src", "__cell.dst")
    )


def reconcile_cells(
    src: DataFrame, dst: DataFrame, keys: Sequence[str], by_position: bool = False
) -> DataFrame:
    """Every cell that differs between the two tables; see ``cells`` for the columns."""
    return cells(reconcile_rows(src, dst, by_position), keys)

