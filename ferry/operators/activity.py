"""The activity log: an append-only table of events and the status derived from it.

Runs only ever add events. What a run's current state is follows from its latest event, so
no row is updated in place and a crashed run simply has no closing event.
"""

from __future__ import annotations

import hashlib
import json
import logging
import socket
import uuid
from collections.abc import Iterable, Mapping
from datetime import datetime, timezone
from typing import Any
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ferry.functions.credentials import without_credentials, without_secrets
from ferry.sources import files, jdbc
from ferry.sources.lake import Lake, join_uri

log = logging.getLogger(__name__)

# The log's table name, its key, and the results it records.
ACTIVITY_TABLE = "integration_activity"
KEY = ("integration_name", "host_name", "table_name", "start")
STARTED, LANDED, SUCCESS, FAILED = "STARTED", "LANDED", "SUCCESS", "FAILED"
# Ours: what a run landed will not be merged any more.
ABANDONED = "ABANDONED"
NO_CONFIGURATION = "{}"

EVENT_SCHEMA = (
    T.StructType()
    .add("integration_name", "string")
    .add("host_name", "string")
    .add("table_name", "string")
    .add("start", "timestamp")
    .add("event", "string")
    .add("event_time", "timestamp")
    .add("configuration", "string")
    .add("stacktrace", "string")
    .add("run_id", "string")
    .add("landing", "string")
    .add("table_key", "long")
)

# Columns of a database log that no user chooses, and how wide they are. Names are text of any
# length, which some databases cannot compare; the hash beside the table's name is what is asked for.
_SHORT = {"event": 16, "run_id": 64}


def host_name() -> str:
    try:
        return socket.gethostname() or uuid.uuid4().hex
    except OSError:
        return uuid.uuid4().hex


def activity_status(events: DataFrame) -> DataFrame:
    """One row per run: started, and finished with a result or still running (nulls).

    A run's last event decides. Each task keeps one event per run before the shuffle.
    """
    closing = F.col("event").isin(SUCCESS, FAILED)
    last = F.max_by(
        F.struct(
            F.when(closing, F.col("event_time")).alias("finish"),
            F.when(closing, F.col("event")).alias("result"),
            F.col("stacktrace"),
        ),
        # Closing events win over others of the same instant.
        F.struct(F.col("event_time"), closing, F.col("event")),
    )
    return (
        events.groupBy(*KEY)
        .agg(last.alias("last"), F.max("configuration").alias("configuration"))
        .select(
            *KEY,
            "last.finish",
            "last.result",
            F.coalesce("configuration", F.lit(NO_CONFIGURATION)).alias("configuration"),
            "last.stacktrace",
        )
    )


def read_events(spark: SparkSession, path: str, below: str = "") -> DataFrame:
    """Events of a file log, old and new: columns that a file lacks read as null."""
    if not files.exists(spark, join_uri(path, below)):
        return spark.createDataFrame([], EVENT_SCHEMA)
    reader = spark.read.schema(EVENT_SCHEMA).option("basePath", path)
    return reader.orc(join_uri(path, below))


def _of_table(table: str) -> str:
    return f"{ACTIVITY_TABLE}/table_name={quote(table, safe='')}"


def _key_of(table: str) -> int:
    """A table's name as a number that any database can compare."""
    return int.from_bytes(hashlib.blake2b(table.encode(), digest_size=8).digest(), "big", signed=True)


class ActivityLog:
    """Appends events to ``integration_activity`` in a lake. A log failure only warns."""

    def __init__(
        self, spark: SparkSession, lake: Lake, integration_name: str, secrets: Iterable[str] = ()
    ):
        self.spark, self.lake, self.name = spark, lake, integration_name
        self.secrets = tuple(secrets)
        self.host = host_name()
        if lake.is_jdbc:
            self._create_or_upgrade()

    @classmethod
    def of(cls, spark: SparkSession, lakes: Iterable[Lake], name: str) -> ActivityLog | None:
        """The log of the first lake that is marked to hold one, if any can be opened."""
        lakes = tuple(lakes)
        secrets = [s for lake in lakes for s in lake.secrets()]
        for lake in lakes:
            if lake.activity_log:
                try:
                    return cls(spark, lake, name, secrets)
                except Exception:
                    log.exception("no activity log: lake %s cannot be opened", lake.name)
                    return None
        return None

    def _create_or_upgrade(self) -> None:
        """Create the table, or add the columns it lacks, all or none of them."""
        if not jdbc.table_exists(self.spark, self.lake, ACTIVITY_TABLE):
            types = ", ".join(f"{c} VARCHAR({n})" for c, n in _SHORT.items())
            self._append(self.spark.createDataFrame([], EVENT_SCHEMA), types)
            return
        held = {c.lower() for c in jdbc.read(self.spark, self.lake, ACTIVITY_TABLE, jdbc.WHOLE).columns}
        jvm = self.spark._jvm
        dialect = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(self.lake.url)
        types = jvm.org.apache.spark.sql.types.DataTypes

        def type_of(f: T.StructField) -> str:
            long = isinstance(f.dataType, T.LongType)
            found = dialect.getJDBCType(types.LongType if long else types.StringType)
            return found.get().databaseTypeDefinition() if found.isDefined() else "BIGINT" if long else "TEXT"

        jdbc.execute(
            self.spark,
            self.lake,
            [
                dialect.getAddColumnQuery(ACTIVITY_TABLE, f.name, type_of(f))
                for f in EVENT_SCHEMA.fields
                if f.name not in held
            ],
        )

    def _append(self, df: DataFrame, column_types: str | None = None) -> None:
        options = self.lake.jdbc_options()
        if column_types:
            options["createTableColumnTypes"] = column_types
        df.write.format("jdbc").options(**options).option("dbtable", ACTIVITY_TABLE).mode(
            "append"
        ).save()

    def events(self, table: str | None = None) -> DataFrame:
        """All events, or those of one table, for which only its directory is listed."""
        if not self.lake.is_jdbc:
            below = "" if table is None else _of_table(table).removeprefix(ACTIVITY_TABLE)
            return read_events(self.spark, self.lake.path(ACTIVITY_TABLE), below)
        options = self.lake.jdbc_options() | {"preferTimestampNTZ": "false"}
        held = self.spark.read.format("jdbc").options(**options).option("dbtable", ACTIVITY_TABLE)
        events = held.load().select([F.col(f.name).cast(f.dataType) for f in EVENT_SCHEMA.fields])
        if table is None:
            return events
        key = F.col("table_key")
        # Compared as an expression, which stays in Spark.
        return events.where((key == _key_of(table)) | key.isNull()).where(F.concat("table_name", F.lit("")) == table)

    def status(self) -> DataFrame:
        return activity_status(self.events())

    def record(
        self,
        table: str,
        start: datetime,
        event: str,
        *,
        run_id: str,
        configuration: Mapping[str, Any] | None = None,
        error: BaseException | None = None,
        landing: str | None = None,
        must: bool = False,
    ) -> None:
        """Append one event. ``must`` raises if that fails: the event commits something."""
        config = None
        if configuration is not None:
            config = json.dumps(without_credentials(configuration), sort_keys=True)
        trace = None
        if error is not None:
            trace = without_secrets(f"{type(error).__name__}: {error}", self.secrets)
        now = datetime.now(timezone.utc)
        key = _key_of(table)
        row = (self.name, self.host, table, start, event, now, config, trace, run_id, landing, key)
        try:
            # Literals stay inside the JVM; a list of rows would go through Python's pickles.
            df = self.spark.range(0, 1, 1, 1).select(
                *[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, EVENT_SCHEMA.fields)]
            )
            if self.lake.is_jdbc:
                self._append(df)
            else:
                # A directory of its own per event: writers in one directory would clear
                # away each other's unfinished files.
                place = f"{_of_table(table)}/event={event}/run_id={run_id}"
                df.drop("table_name", "event", "run_id").write.orc(self.lake.path(place))
        except Exception:
            if must:
                raise
            log.exception("could not record %s of %s", event, table)

    def _of(self, table: str, lake: str | None) -> DataFrame:
        """Events of this integration about a table, in one lake if that is named."""
        events = self.events(table).where(F.concat("integration_name", F.lit("")) == self.name)
        return events if lake is None else events.where(F.get_json_object("landing", "$.lake") == lake)

    def latest(self, table: str, lake: str | None = None) -> str | None:
        """The landing of the last run of a table that succeeded: its committed version."""
        succeeded = F.concat("event", F.lit("")) == SUCCESS
        row = self._of(table, lake).where(succeeded & F.col("landing").isNotNull())
        return row.agg(F.max_by("landing", "start")).first()[0]

    def leftovers(self, table: str, lake: str | None = None) -> list[str]:
        """Landings of runs after the last success that landed, and were neither merged nor given up."""
        runs = self._of(table, lake).groupBy("run_id").agg(
            F.min("start").alias("start"),
            F.max(F.when(F.col("event") == LANDED, F.col("landing"))).alias("landing"),
            F.max((F.col("event") == SUCCESS) & F.col("landing").isNotNull()).alias("done"),
            F.max(F.col("event") == ABANDONED).alias("given_up"),
        )
        done = runs.agg(F.max(F.when(F.col("done"), F.col("start")))).first()[0]
        open_ = runs.where(~F.col("done") & ~F.col("given_up") & F.col("landing").isNotNull())
        if done is not None:
            open_ = open_.where(F.col("start") > F.lit(done))
        return [r["landing"] for r in open_.orderBy("start").toLocalIterator()]
