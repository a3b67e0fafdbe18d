"""A lake: a named endpoint with everything needed to read from it or write to it."""

from __future__ import annotations

import logging
import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import types as T

from ferry.functions.columns import TIMESTAMP_FORMAT, TIMESTAMP_NTZ_FORMAT
from ferry.functions.credentials import without_credentials

log = logging.getLogger(__name__)

# The two file drivers, the chunk size and the write mode a lake starts with.
FILESYSTEM = "filesystem"
S3 = "s3"
DEFAULT_CHUNK = 20_000
DEFAULT_WRITE_MODE = "overwrite"

# A database takes so many connections at once, however large the cluster.
DEFAULT_CONNECTIONS = 16

FILE_FORMATS = ("csv", "orc", "parquet")
WRITE_MODES = ("overwrite", "append", "ignore", "error", "errorifexists")

# Nothing is trimmed, null and the empty string stay apart, quotes are doubled.
_LOSSLESS_CSV = {
    "nullValue": "\\N",
    "emptyValue": "",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": TIMESTAMP_FORMAT,
    "timestampNTZFormat": TIMESTAMP_NTZ_FORMAT,
}


def join_uri(base: str, *parts: str) -> str:
    """Join path pieces below any URI without touching the ``//`` of its scheme."""
    return "/".join([base.strip().rstrip("/"), *(p.strip("/") for p in parts if p)])


def has_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.CharType, T.VarcharType))


@dataclass(frozen=True)
class Lake:
    """One endpoint.

    ``driver`` is ``filesystem``, ``s3`` or the class name of a JDBC driver. Credentials of
    object stores belong to the Spark session; ``username`` and ``password`` are for databases.

    ``snapshots`` makes every landing a new ``run=`` directory, which leaves the last good
    copy untouched while the next one is written. It is how file systems are overwritten
    unless turned off; other write modes work on one fixed directory.

    ``dialect`` is ``lossless`` (what this library writes to CSV) or ``plain`` (Spark's own
    CSV defaults, for files written elsewhere). ``multiline`` reads quoted line breaks; turn
    it off for large foreign files without them, which then can be split between tasks.

    ``max_connections`` limits how many tasks write to a database at once, and how many read a
    table that has a primary key to split it by. Overwriting a database table writes the new rows beside the old ones,
    which go when all are there; ``atomic`` then moves them over in one transaction, which keeps the table's definition.

    ``anchored`` reads a table before rows are appended to it, so that a comparison can tell the new rows from equal ones that were
    there; without it they are only counted.
    """

    name: str
    url: str
    driver: str = FILESYSTEM
    format: str = ""
    username: str = field(default="", repr=False)
    password: str = field(default="", repr=False)
    header: bool = True
    fetch_size: int = DEFAULT_CHUNK
    batch_size: int = DEFAULT_CHUNK
    write_mode: str = DEFAULT_WRITE_MODE
    activity_log: bool = False
    snapshots: bool | None = None
    dialect: str = "lossless"
    multiline: bool = True
    max_connections: int = DEFAULT_CONNECTIONS
    atomic: bool = False
    anchored: bool = True
    options: Mapping[str, str] = field(default_factory=dict, repr=False)

    def __post_init__(self) -> None:
        if not self.name.strip():
            raise ValueError("a lake needs a name")
        set_ = object.__setattr__
        set_(self, "url", self.url.strip())
        set_(self, "write_mode", self.write_mode.lower())
        if self.write_mode not in WRITE_MODES:
            raise ValueError(f"lake {self.name}: unknown write mode {self.write_mode}")
        if self.dialect not in ("lossless", "plain"):
            raise ValueError(f"lake {self.name}: unknown csv dialect {self.dialect}")
        if self.is_jdbc:
            set_(self, "format", "jdbc")
            if not self.username.strip():
                raise ValueError(f"lake {self.name}: a database needs a username")
            if not self.password:
                log.warning("lake %s connects with a blank password", self.name)
        elif self.format not in FILE_FORMATS:
            raise ValueError(f"lake {self.name}: format must be one of {FILE_FORMATS}")
        if self.snapshots is None:
            fresh_runs = self.driver == FILESYSTEM and self.write_mode == DEFAULT_WRITE_MODE
            set_(self, "snapshots", fresh_runs)
        if self.snapshots and self.write_mode != DEFAULT_WRITE_MODE:
            raise ValueError(f"lake {self.name}: snapshots replace, they do not {self.write_mode}")

    @property
    def is_jdbc(self) -> bool:
        return self.driver not in (FILESYSTEM, S3)

    def path(self, *parts: str) -> str:
        return join_uri(self.url, *parts)

    def read_options(self, schema: T.StructType | None = None) -> dict[str, str]:
        """Options of a file scan; user options win over the defaults."""
        if self.format != "csv":
            return dict(self.options)
        opts = {"header": str(self.header).lower()}
        if self.dialect == "lossless":
            opts |= _LOSSLESS_CSV
        if schema is None:
            # Without a header there is nothing to go by but the data: a second pass over it.
            opts["inferSchema"] = str(not self.header).lower()
        # Only text can hold a line break, and files read this way cannot be split.
        text = schema is None or any(has_text(f.dataType) for f in schema.fields)
        opts["multiLine"] = str(self.multiline and text).lower()
        return opts | dict(self.options)

    def write_options(self) -> dict[str, str]:
        if self.format != "csv":
            return dict(self.options)
        opts = {"header": str(self.header).lower()}
        if self.dialect == "lossless":
            opts |= _LOSSLESS_CSV | {"quoteAll": "true"}
        return opts | dict(self.options)

    def jdbc_options(self) -> dict[str, str]:
        """Options common to JDBC scans and sinks; user options win over the defaults."""
        return {
            "url": self.url,
            "driver": self.driver,
            "user": self.username,
            "password": self.password,
            "fetchsize": str(self.fetch_size),
            "batchsize": str(self.batch_size),
            "preferTimestampNTZ": "true",
        } | dict(self.options)

    def secrets(self) -> list[str]:
        """Values that must not be logged, wherever they turn up."""
        named = [v for k, v in self.options.items() if re.search("password|pwd|secret|token|key", k, re.I)]
        return [str(v) for v in (self.password, *named) if len(str(v)) > 3]

    def describe(self) -> dict[str, Any]:
        """The lake as it may be logged."""
        return without_credentials(
            {
                "name": self.name,
                "url": self.url,
                "driver": self.driver,
                "dataFormat": self.format,
                "username": self.username,
                "password": self.password,
                "header": self.header,
                "fetchSize": self.fetch_size,
                "batchSize": self.batch_size,
                "writeMode": self.write_mode,
                "properties": dict(self.options),
            }
        )
