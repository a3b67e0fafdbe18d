"""What to move: transfers and archives between named lakes."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import types as T

from ferry.sources.jdbc import Split
from ferry.sources.lake import Lake


@dataclass(frozen=True)
class Upsert:
    """Merge landed files into a master table of the same lake, see ``operators.upsert``.

    With ``partition``, a key column, the master is partitioned by it and only the partitions
    that landed rows fall into are rewritten. Otherwise the master is kept in ``files`` files by the hash of its key (as many
    as its size asks for, if not given), and a new version writes those that landed rows fall into and shares the others.
    """

    master: str
    keys: tuple[str, ...]
    on_match: str = "update"
    set_columns: tuple[str, ...] | None = None
    order_by: tuple[str, ...] | None = None
    partition: str | None = None
    files: int | None = None


@dataclass(frozen=True)
class DatabaseMerge:
    """Merge a landed table into a master inside the database, by the user's own SQL.

    With ``master`` named, ``create_sql`` runs only while that table does not exist.
    """

    create_sql: str
    merge_sql: str
    master: str | None = None


@dataclass(frozen=True)
class Transfer:
    """Copy a table or ``( select … ) alias`` to a destination table.

    With ``control`` the source is a query whose rows (description, query, destination) become
    transfers of their own. It is asked of ``control_lake``, by default the destination.
    """

    source: str
    destination: str
    description: str = ""
    merge: Upsert | DatabaseMerge | None = None
    control: bool = False
    control_lake: str | None = None
    schema: T.StructType | None = None
    split: Split | None = None
    files: int | None = None
    column_types: str | None = None


@dataclass(frozen=True)
class Archive:
    """Land the rows that satisfy all constraints in one directory per day of ``column``.

    ``database_constraints`` are in the SQL of a source database, which sends only the rows that
    satisfy them: for days kept as text, say, which Spark's own filters are not pushed down to.
    """

    source: str
    column: str
    destination: str
    constraints: tuple[str, ...] = ()
    description: str = ""
    fmt: str | None = None
    lenient: bool = False
    schema: T.StructType | None = None
    split: Split | None = None
    database_constraints: tuple[str, ...] = ()


@dataclass(frozen=True)
class Route:
    """Items that go from one lake to another."""

    source_lake: str
    destination_lake: str
    items: tuple[Transfer | Archive, ...]


@dataclass(frozen=True)
class Plan:
    """A named run: its lakes, and either transfers or archives between them."""

    name: str
    lakes: tuple[Lake, ...]
    routes: tuple[Route, ...]
    description: str = ""
    by_name: Mapping[str, Lake] = field(init=False, repr=False, compare=False)

    def __post_init__(self) -> None:
        if not self.name.strip():
            raise ValueError("a plan needs a name")
        names = [lake.name for lake in self.lakes]
        twice = sorted({n for n in names if names.count(n) > 1})
        if twice:
            raise ValueError(f"several lakes are called {twice}")
        object.__setattr__(self, "by_name", {lake.name: lake for lake in self.lakes})
        ends = {n for r in self.routes for n in (r.source_lake, r.destination_lake)}
        unknown = sorted(ends - set(names))
        if unknown:
            raise ValueError(f"unknown lakes {unknown}")
        if len({type(i) for r in self.routes for i in r.items}) > 1:
            raise ValueError("a plan holds transfers or archives, not both")

    def describe(self) -> dict[str, Any]:
        """The plan as it may be logged: no credentials, and no SQL that might hold any."""
        return {
            "name": self.name,
            "description": self.description,
            "datalakes": [lake.describe() for lake in self.lakes],
            "routes": [
                {
                    "source": r.source_lake,
                    "destination": r.destination_lake,
                    "tables": [i.destination for i in r.items],
                }
                for r in self.routes
            ],
        }
