"""Turning the rows of a control query, or everything a lake holds, into transfers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ferry.plans.transfer import DatabaseMerge, Transfer, Upsert
from ferry.sources import files, jdbc
from ferry.sources.lake import Lake


def expand_control(control: DataFrame) -> list[Transfer]:
    """One transfer per control row, which is one per table to move.

    Columns: description, query, destination. Optional ones set up a merge: ``master_sql`` and
    ``merge_sql`` for databases, or ``master``, ``keys`` (comma-separated) and ``on_match`` for
    files. Column names may have any case, as databases change it.
    """
    lower = control.toDF(*[c.lower() for c in control.columns])
    missing = {"description", "query", "destination"} - set(lower.columns)
    if missing:
        raise ValueError(f"the control query lacks {sorted(missing)}")
    return [_transfer(row.asDict()) for row in lower.toLocalIterator()]


def _transfer(row: dict) -> Transfer:
    merge = None
    if row.get("master_sql") and row.get("merge_sql"):
        merge = DatabaseMerge(row["master_sql"], row["merge_sql"], row.get("master"))
    elif row.get("master") and row.get("keys"):
        keys = tuple(k.strip() for k in row["keys"].split(","))
        merge = Upsert(row["master"], keys, row.get("on_match") or "update")
    return Transfer(row["query"], row["destination"], row["description"] or "", merge)


def every_table(spark: SparkSession, lake: Lake, schema: str | None = None) -> list[Transfer]:
    """One transfer per table of a lake: all tables of a database's catalog, or all of its files."""
    if lake.is_jdbc:
        found = jdbc.tables(spark, lake, schema)
        names = [name.lower() for _, name in found]
        # A name that several schemas hold says which one.
        wanted = [
            f"{owner}_{name}".lower() if names.count(name.lower()) > 1 else name.lower() for owner, name in found
        ]
        sources = [".".join(jdbc.quote(spark, lake, p) for p in one if p) for one in found]
        twice = sorted({w for w in wanted if wanted.count(w) > 1})
        if twice:
            raise ValueError(f"several tables of lake {lake.name} would be called {twice}")
        return [Transfer(source, name) for source, name in zip(sources, wanted)]
    return [Transfer(p.rsplit("/", 1)[-1], n) for n, p in files.named(files.children(spark, lake.url)).items()]
