"""Running a plan: every transfer is scanned, shaped, landed, merged and recorded."""

from __future__ import annotations

import json
import logging
import re
import time
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ferry.functions.credentials import strip_url, without_secrets
from ferry.operators.activity import ABANDONED, FAILED, LANDED, STARTED, SUCCESS, ActivityLog
from ferry.operators.preflight import problems, writable
from ferry.operators.reconciling import reconcile, reconcile_appended, rows_if_equal
from ferry.operators.shape import constrain, day_bucket
from ferry.operators.upserts import DuplicateKeys, require_unique
from ferry.plans.control import expand_control
from ferry.plans.transfer import Archive, DatabaseMerge, Plan, Route, Transfer, Upsert
from ferry.sinks.landing import BUCKET, Landing, SelfOverwrite, land, read_landing
from ferry.sinks.ledger import GIVEN_UP, MERGED, STAGED, MergeLedger
from ferry.sinks.masters import land_partitions
from ferry.sinks.versions import land_version
from ferry.sources import files, jdbc
from ferry.sources.lake import Lake
from ferry.sources.scans import is_subselect, read_files, scan
from ferry.workspace import new_run_id

log = logging.getLogger(__name__)

# Ends the run id of a master's version, which begins with that of the rows merged last.
_MASTER = "-master"

MANIFEST_SCHEMA = (
    T.StructType()
    .add("source_lake", "string")
    .add("destination_lake", "string")
    .add("table", "string")
    .add("path", "string")
    .add("format", "string")
    .add("rows", "long")
    .add("seconds", "double")
    .add("run_id", "string")
)


@dataclass
class Landed:
    route: Route
    item: Transfer | Archive
    landing: Landing


@dataclass
class Run:
    """What a run landed, in plan order, and what failed."""

    landed: list[Landed] = field(default_factory=list)
    failures: dict[str, BaseException] = field(default_factory=dict)

    def names(self) -> dict[str, dict[str, list[str]]]:
        """Source lake → destination lake → places landed."""
        out: dict[str, dict[str, list[str]]] = {}
        for one in self.landed:
            route = one.route
            places = out.setdefault(route.source_lake, {}).setdefault(route.destination_lake, [])
            places.append(one.landing.path)
        return out

    def manifest(self, spark: SparkSession) -> DataFrame:
        """One row per landing."""
        rows = [
            (
                one.route.source_lake,
                one.route.destination_lake,
                one.landing.name,
                one.landing.path,
                one.landing.format,
                one.landing.rows,
                one.landing.seconds,
                one.landing.run_id,
            )
            for one in self.landed
        ]
        return spark.createDataFrame(rows, MANIFEST_SCHEMA)


class TransferFailed(RuntimeError):
    """Some transfers of a run failed; ``run`` holds the others."""

    def __init__(self, run: Run):
        self.run = run
        what = "; ".join(f"{k}: {type(e).__name__}: {e}" for k, e in run.failures.items())
        super().__init__(f"{len(run.failures)} transfers failed: {what}")


class PlanRefused(RuntimeError):
    """A plan has problems, each a row as ``preflight`` lists them; nothing was moved."""

    def __init__(self, problems: list):
        self.problems = problems
        what = "; ".join(f"{r['source_lake']}/{r['destination_lake']}/{r['table']}: {r['problem']}" for r in problems)
        super().__init__(f"{len(problems)} problems: {what}")


def run(spark: SparkSession, plan: Plan, max_parallel: int = 4, checked: bool = False) -> Run:
    """Run every item of a plan; failures are raised once all items had their turn.

    Routes run in order, since a later one may read what an earlier one wrote. Within a route
    items run side by side as independent Spark jobs, except that those with one destination
    keep their order, and so do all items of a route within one lake.

    A ``checked`` run raises what ``preflight`` finds before a row is moved. It is not for plans whose later
    routes read what is only there after earlier ones.
    """
    if checked and (found := preflight(spark, plan).collect()):
        raise PlanRefused(found)
    lakes = plan.by_name
    activity = ActivityLog.of(spark, plan.lakes, plan.name)
    done = Run()
    for route in plan.routes:
        source, destination = lakes[route.source_lake], lakes[route.destination_lake]
        items = _expanded(spark, plan, route, activity, done)

        def one(item: Transfer | Archive) -> Landed | BaseException:
            try:
                landing = _transfer(spark, plan, source, destination, item, activity)
                return Landed(route, item, landing)
            except Exception as e:
                log.exception("%s from %s to %s failed", item.destination, source.name, destination.name)
                return e

        alone = source.name == destination.name
        for item, result in zip(items, _side_by_side(spark, items, one, 1 if alone else max_parallel)):
            if isinstance(result, Landed):
                done.landed.append(result)
            else:
                done.failures[f"{source.name}/{destination.name}/{item.destination}"] = result
    if done.failures:
        raise TransferFailed(done)
    return done


def _side_by_side(
    spark: SparkSession, items: list, one: Callable, threads: int
) -> Iterable[Landed | BaseException]:
    """Results in the order of ``items``; those that write one table run one after another."""
    by_destination: dict[str, list[int]] = {}
    for i, item in enumerate(items):
        merge = getattr(item, "merge", None)
        written = (merge.master if merge else None) or item.destination
        by_destination.setdefault(written.lower(), []).append(i)
    if threads < 2 or len(by_destination) < 2:
        return [one(item) for item in items]

    def in_order(indexes: list[int]) -> list[tuple[int, Landed | BaseException]]:
        return [(i, one(items[i])) for i in indexes]

    results: dict[int, Landed | BaseException] = {}
    with ThreadPoolExecutor(threads) as pool:
        # Spark's job descriptions and scheduler pools follow the threads.
        task = inheritable_thread_target(spark)(in_order)
        for part in pool.map(task, by_destination.values()):
            results.update(part)
    return [results[i] for i in range(len(items))]


def _expanded(
    spark: SparkSession, plan: Plan, route: Route, activity: ActivityLog | None, done: Run
) -> list[Transfer | Archive]:
    """The plain items of a route, then those that its control queries yield."""
    items = [i for i in route.items if not getattr(i, "control", False)]
    for item in route.items:
        if not getattr(item, "control", False):
            continue
        try:
            asked = plan.by_name[item.control_lake or route.destination_lake]
            items += expand_control(scan(spark, asked, item.source))
        except Exception as e:
            log.exception("control query for %s failed", item.destination)
            done.failures[f"{route.source_lake}/{route.destination_lake}/{item.destination}"] = e
            if activity:
                now = datetime.now(timezone.utc)
                activity.record(item.destination, now, FAILED, run_id=new_run_id(), error=e)
    return items


def source_frame(spark: SparkSession, lake: Lake, item: Transfer | Archive) -> DataFrame:
    """What an item reads, shaped as it is landed."""
    source, inside = item.source, getattr(item, "database_constraints", ())
    if inside and not lake.is_jdbc:
        raise ValueError(f"lake {lake.name} is no database that could check {inside}")
    if inside:
        table = source if source.strip().startswith("(") else f"{source} s"
        source = f"( select * from {table} where {' and '.join(f'({c})' for c in inside)} ) a"
    df = scan(spark, lake, source, item.schema, item.split)
    if isinstance(item, Archive):
        df = day_bucket(constrain(df, item.constraints), item.column, item.fmt, lenient=item.lenient)
    return df


def _transfer(
    spark: SparkSession,
    plan: Plan,
    source: Lake,
    destination: Lake,
    item: Transfer | Archive,
    activity: ActivityLog | None,
) -> Landing:
    run_id, start = new_run_id(), datetime.now(timezone.utc)

    def record(event: str, **more) -> None:
        if activity:
            activity.record(item.destination, start, event, run_id=run_id, **more)

    record(STARTED, configuration=plan.describe())
    try:
        guard_self_overwrite(spark, source, item.source, destination, item.destination)
        df = source_frame(spark, source, item)
        merge = getattr(item, "merge", None)
        lacking = unfit(df, merge)
        if lacking:
            raise ValueError("; ".join(lacking))
        if merge is not None and isinstance(merge, DatabaseMerge) != destination.is_jdbc:
            raise ValueError("DatabaseMerge is for databases and Upsert for files")
        if isinstance(merge, DatabaseMerge) and jdbc.table_exists(spark, destination, item.destination):
            # Rows that an earlier run landed but could not merge would be overwritten below.
            if not jdbc.is_merged(spark, destination, item.destination):
                _merge_in_database(spark, destination, merge, item.destination)
        if isinstance(merge, Upsert):
            # Staged rows get a directory per run, so that none are overwritten unmerged.
            destination = _with_runs(destination)
            MergeLedger(spark, destination, item.destination).stage(run_id, df.schema)
        landing = land(
            df,
            destination,
            item.destination,
            bucket=BUCKET if isinstance(item, Archive) and not destination.is_jdbc else None,
            files_per_table=getattr(item, "files", None),
            column_types=getattr(item, "column_types", None),
            run_id=run_id,
        )
        record(LANDED, landing=landing.to_log(destination))
        if isinstance(merge, DatabaseMerge):
            jdbc.mark_staged(spark, destination, item.destination)
            _merge_in_database(spark, destination, merge, item.destination)
        elif merge is not None:
            _merge_files(spark, destination, item.destination, merge, landing, activity, start)
        record(SUCCESS, landing=landing.to_log(destination))
        return landing
    except Exception as e:
        record(FAILED, error=e)
        raise


def unfit(df: DataFrame, merge: Upsert | DatabaseMerge | None) -> list[str]:
    """Columns that a merge names and the rows do not have, found before any row is moved."""
    if not isinstance(merge, Upsert):
        return []
    held = {c.lower() for c in df.columns}
    named = {"keys": merge.keys, "set_columns": merge.set_columns or (), "order_by": merge.order_by or ()}
    named["partition"] = (merge.partition,) if merge.partition else ()
    return [f"the merge's {k} name {c}, which is no column" for k, cs in named.items() for c in cs if c.lower() not in held]


def guard_self_overwrite(
    spark: SparkSession, source: Lake, text: str, destination: Lake, table: str
) -> None:
    """Refuse to overwrite the table that is being read: its rows would be gone.

    File sinks check the files themselves when they land. In a database both names are looked up as
    its catalog holds them. What a subselect reads cannot be looked up, so it may not mention the
    table's name; and lakes whose urls differ only in parameters count as one database.
    """
    if not (destination.is_jdbc and source.is_jdbc) or destination.write_mode != "overwrite":
        return
    if _database(source.url) != _database(destination.url):
        return
    if is_subselect(text) or text.strip().startswith("("):
        name = jdbc.identity(spark, destination, table)[1]
        mentioned = re.search(rf"(?<!\w){re.escape(name)}(?!\w)", text, re.I) is not None
    else:
        mentioned = jdbc.identity(spark, source, text) == jdbc.identity(spark, destination, table)
    if mentioned:
        raise SelfOverwrite(f"{table} in lake {destination.name} would overwrite its own source")


def _database(url: str) -> str:
    """A database's url without parameters and credentials."""
    return re.split("[;?]", strip_url(url))[0].rstrip("/").lower()


def _merge_in_database(spark: SparkSession, lake: Lake, merge: DatabaseMerge, staging: str) -> None:
    """Merge, and note in the same transaction that the staged rows are merged."""
    if not (merge.create_sql.strip() and merge.merge_sql.strip()):
        return
    if merge.master is None or not jdbc.table_exists(spark, lake, merge.master):
        jdbc.execute(spark, lake, [merge.create_sql])
    jdbc.execute(spark, lake, [merge.merge_sql, *jdbc.merged_statements(spark, lake, staging)])


def _merge_files(
    spark: SparkSession,
    lake: Lake,
    table: str,
    merge: Upsert,
    landing: Landing,
    activity: ActivityLog | None,
    start: datetime,
) -> None:
    """Write the next version of a master beside the current one, then commit it.

    Rows of earlier runs that landed but were not merged come first. Until the commit event
    (without a log, the completion marker of the files) readers see the current version. Then the staging table's
    ledger is told which runs the version has merged.
    """
    schema = read_landing(spark, lake, landing).schema
    ledger = MergeLedger(spark, lake, table)
    leftovers = _leftovers(spark, lake, table, merge, landing, schema, activity, start, ledger)
    frames = [*leftovers.values(), read_landing(spark, lake, landing)]
    keys, run_id = list(merge.keys), landing.run_id + _MASTER
    how = {
        "on_match": merge.on_match,
        "set_columns": merge.set_columns,
        "order_by": merge.order_by,
    }
    if merge.partition is not None:
        version = land_partitions(
            spark, frames, lake, merge.master, keys, merge.partition, run_id=run_id, **how
        )
    else:
        current = _current_master(spark, lake, merge.master, activity)
        version = land_version(
            spark, current, frames, lake, merge.master, keys, run_id=run_id, schema=schema, number=merge.files, **how
        )
    if activity:
        try:
            activity.record(
                merge.master,
                start,
                SUCCESS,
                run_id=version.run_id,
                landing=version.to_log(lake),
                must=True,
            )
        except Exception:
            if merge.partition is None:
                files.uncommit(spark, version.path)
            raise
    ledger.close([*leftovers, landing.run_id], MERGED, version.run_id)


def _with_runs(lake: Lake) -> Lake:
    return replace(lake, snapshots=True, write_mode="overwrite")


def _current_master(
    spark: SparkSession, lake: Lake, name: str, activity: ActivityLog | None
) -> tuple[str, T.StructType | None] | None:
    """Place and types of the version that the log committed; without one, the latest completed run on disk.

    So a log that is switched on later goes on with what is there. Files that are no run are a table
    that this library did not merge, and are refused.
    """
    committed = activity.latest(name, lake.name) if activity else None
    if committed:
        landing = Landing(**json.loads(committed))
        return landing.place(lake), T.StructType.fromJson(json.loads(landing.schema))
    path = lake.path(name)
    current = files.latest_run(spark, path)
    if current is not None:
        return current, None
    loose = [c for c in files.children(spark, path) if not c.rsplit("/", 1)[-1].startswith(files.RUN)]
    if loose:
        raise ValueError(f"{name} in lake {lake.name} holds files that no merge has written")
    return None


def _leftovers(
    spark: SparkSession,
    lake: Lake,
    table: str,
    merge: Upsert,
    landing: Landing,
    schema: T.StructType,
    activity: ActivityLog | None,
    start: datetime,
    ledger: MergeLedger,
) -> dict[str, DataFrame]:
    """What earlier runs landed and could not merge, by run, oldest first.

    The staging table's ledger says so. What landed before there was one is found by the log or, without a log, by the
    run that the master names as merged last. What can never be merged, since it has rows of one key, is given up and
    named, so that it does not stop the runs after it.
    """
    states = ledger.states()
    path, since = lake.path(merge.master), None
    if merge.partition is not None:
        since = files.merged_last(spark, path)
    else:
        current = files.latest_run(spark, path)
        since = files.run_id(current).removesuffix(_MASTER) if current else None
    open_runs = {
        run: read_files(spark, lake, place, types or schema)
        for run, (place, types) in ledger.open_runs(landing.run_id, since).items()
    }
    if activity and not any(state != STAGED for state in states.values()):
        logged = [Landing(**json.loads(x)) for x in activity.leftovers(table, lake.name)]
        # This run's own landing is open as well until it succeeds.
        open_runs |= {x.run_id: read_landing(spark, lake, x) for x in logged if x.run_id != landing.run_id}
    frames = {}
    for run_id, frame in sorted(open_runs.items()):
        try:
            if not merge.order_by:
                require_unique(frame, list(merge.keys))
            frames[run_id] = frame
        except DuplicateKeys as e:
            log.warning("run %s of %s is given up: %s", run_id, table, e)
            ledger.close([run_id], GIVEN_UP)
            if activity:
                activity.record(table, start, ABANDONED, run_id=run_id, error=e)
    return frames


def preflight(spark: SparkSession, plan: Plan) -> DataFrame:
    """What would stop a plan: unreadable sources, unfit columns, unwritable lakes.

    Only schemas are read. Rows of control queries are not looked at.
    """
    found = []
    for name in dict.fromkeys(r.destination_lake for r in plan.routes):
        reason = writable(spark, plan.by_name[name])
        if reason:
            found.append((None, name, None, reason))
    for route in plan.routes:
        source, destination = plan.by_name[route.source_lake], plan.by_name[route.destination_lake]
        for item in route.items:
            if not getattr(item, "control", False):
                reasons = problems(spark, source, item.source, destination, item.destination)
                if not reasons:
                    try:
                        shaped = source_frame(spark, source, replace(item, split=item.split or jdbc.WHOLE))
                        reasons = unfit(shaped, getattr(item, "merge", None))
                    except Exception as e:
                        reasons = [f"cannot shape {item.source}: {without_secrets(str(e).splitlines()[0])}"]
                found += [(source.name, destination.name, item.destination, r) for r in reasons]
    return spark.createDataFrame(
        found, "source_lake string, destination_lake string, table string, problem string"
    )


RECONCILED_SCHEMA = (
    T.StructType()
    .add("source_lake", "string")
    .add("destination_lake", "string")
    .add("table", "string")
    .add("src_rows", "long")
    .add("dst_rows", "long")
    .add("missing", "long")
    .add("extra", "long")
    .add("seconds", "double")
)


class ReconcileFailed(RuntimeError):
    """Some landings could not be compared; ``compared`` holds the results of the others."""

    def __init__(self, compared: DataFrame, failures: dict[str, BaseException]):
        self.compared, self.failures = compared, failures
        what = "; ".join(f"{k}: {type(e).__name__}" for k, e in failures.items())
        super().__init__(f"{len(failures)} landings could not be compared: {what}")


def reconcile_run(
    spark: SparkSession,
    plan: Plan,
    done: Run,
    by_position: bool = False,
    max_parallel: int = 4,
    split: jdbc.Split | None = None,
) -> DataFrame:
    """Read both sides of every landing again and compare all rows: one row per landing.

    Of an archive the days at hand are compared. Rows that were there before an append are left out
    of the counts, by what they added up to then (or, in a lake that is not anchored, by their number). Each comparison is recorded like a run of its own: FAILED if rows differ or cannot be
    read; what cannot be read is raised when all others are done. ``split`` reads landed database
    tables in parallel. Only the four counts of a comparison come to the driver.
    """
    activity = ActivityLog.of(spark, plan.lakes, plan.name)

    def compare(one: Landed) -> tuple | BaseException:
        source, destination = (
            plan.by_name[one.route.source_lake],
            plan.by_name[one.route.destination_lake],
        )
        run_id, start, began = new_run_id(), datetime.now(timezone.utc), time.monotonic()

        def record(event: str, **more) -> None:
            if activity:
                activity.record(one.landing.name, start, event, run_id=run_id, **more)

        record(STARTED, configuration=plan.describe())
        try:
            src = source_frame(spark, source, one.item)
            dst = read_landing(spark, destination, one.landing, split)
            landing = one.landing
            if landing.anchor:
                counts = reconcile_appended(src, dst, landing.anchor, by_position)
            else:
                if isinstance(one.item, Archive) and not destination.is_jdbc and not landing.rows_before:
                    # Other days stay when an archive is run again; they are not this run's.
                    days = src.select(F.col(BUCKET).alias("__day")).distinct()
                    dst = dst.join(days, F.col(BUCKET).eqNullSafe(F.col("__day")), "left_semi")
                same = rows_if_equal(src, dst, by_position) if not landing.rows_before else None
                found = (same, same, 0, 0) if same is not None else reconcile(src, dst, by_position).first()
                src_rows, dst_rows, missing, extra = found
                # Rows that were there before an append are no surplus, and stand in for none that are lost.
                dst_rows -= landing.rows_before
                missing = max(missing, src_rows - dst_rows)
                counts = (src_rows, dst_rows, missing, dst_rows - src_rows + missing)
            missing, extra = counts[2:]
        except Exception as e:
            log.exception("%s in lake %s cannot be compared", one.landing.name, destination.name)
            record(FAILED, error=e)
            return e
        if missing or extra:
            record(FAILED, error=ValueError(f"{missing} missing, {extra} extra"))
        else:
            record(SUCCESS)
        seconds = time.monotonic() - began
        return (source.name, destination.name, one.landing.name, *counts, seconds)

    with ThreadPoolExecutor(max_parallel) as pool:
        results = list(pool.map(inheritable_thread_target(spark)(compare), done.landed))
    compared = spark.createDataFrame([r for r in results if isinstance(r, tuple)], RECONCILED_SCHEMA)
    failures = {
        f"{one.route.source_lake}/{one.route.destination_lake}/{one.landing.name}": r
        for one, r in zip(done.landed, results)
        if not isinstance(r, tuple)
    }
    if failures:
        raise ReconcileFailed(compared, failures)
    return compared
