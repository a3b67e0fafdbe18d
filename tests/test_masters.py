"""Masters, databases and names where runs before left something behind."""

from __future__ import annotations

import json
from dataclasses import replace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ferry.functions.credentials import strip_url
from ferry.operators import ActivityLog, upsert
from ferry.plans import Archive, DatabaseMerge, Plan, ReconcileFailed, Route, Transfer, TransferFailed, Upsert, every_table, reconcile_run, run
from ferry.sinks import SelfOverwrite, land, read_landing
from ferry.sinks.ledger import MergeLedger
from ferry.sinks.versions import Manifest
from ferry.sources import Lake, jdbc, scan
from ferry.sources.files import latest_run
from queries.registry import fresh


def go(spark, source, to, items, name="p", lakes=()):
    return run(spark, Plan(name, (source, to, *lakes), (Route(source.name, to.name, tuple(items)),)))


@pytest.fixture
def staged(spark, lake):
    """Makes a source table of (k, v) rows."""
    made = lake("parquet", "source", snapshots=False)

    def put(data):
        land(spark.createDataFrame(data, "k int, v int"), made, "t")
        return made

    return put


MERGE = Transfer("t", "staging", merge=Upsert("master", ("k",)))


def test_two_lakes_with_one_log_keep_their_masters_apart(spark, lake, staged):
    log, a, b = lake(name="log", activity_log=True), lake(name="a"), lake(name="b")
    go(spark, staged([(1, 1), (2, 2)]), a, [MERGE], lakes=(log,))
    go(spark, staged([(9, 9)]), b, [MERGE], lakes=(log,))
    go(spark, staged([(2, 3)]), a, [MERGE], lakes=(log,))
    assert rows(scan(spark, a, "master")) == [(1, 1), (2, 3)] and rows(scan(spark, b, "master")) == [(9, 9)]


def test_a_log_switched_on_later_goes_on_with_the_master(spark, lake, staged):
    to = lake(name="to")
    go(spark, staged([(1, 1), (2, 2)]), to, [MERGE])
    go(spark, staged([(3, 3)]), replace(to, activity_log=True), [MERGE])
    assert rows(scan(spark, to, "master")) == [(1, 1), (2, 2), (3, 3)]


def test_files_that_no_merge_wrote_are_refused(spark, lake, staged):
    to = lake(name="to")
    land(spark.createDataFrame([(1, 1)], "k int, v int"), replace(to, snapshots=False), "master")
    with pytest.raises(TransferFailed, match="no merge has written"):
        go(spark, staged([(3, 3)]), to, [MERGE])
    assert rows(scan(spark, to, "master")) == [(1, 1)]


def test_masters_of_object_stores_are_read_in_one_version(spark, tmp_path, staged):
    to = Lake("to", f"file:{tmp_path}/s3", driver="s3", format="orc")
    go(spark, staged([(1, 1), (2, 2)]), to, [MERGE])
    go(spark, staged([(2, 5), (3, 3)]), to, [MERGE])
    assert scan(spark, to, "master").columns == ["k", "v"]
    assert rows(scan(spark, to, "master")) == [(1, 1), (2, 5), (3, 3)]


def test_a_version_whose_commit_failed_is_not_shown(spark, lake, staged, monkeypatch):
    to = lake(name="to", activity_log=True)
    go(spark, staged([(1, 1)]), to, [MERGE])
    real = ActivityLog.record

    def broken(self, *args, must=False, **more):
        if must:
            raise OSError("the log is gone")
        return real(self, *args, **more)

    monkeypatch.setattr(ActivityLog, "record", broken)
    with pytest.raises(TransferFailed, match="the log is gone"):
        go(spark, staged([(1, 2)]), to, [MERGE])
    assert rows(scan(spark, to, "master")) == [(1, 1)]


@pytest.mark.parametrize("log", [False, True])
@pytest.mark.parametrize("partition", [None, "k"])
def test_leftovers_are_merged(spark, lake, staged, log, partition, monkeypatch):
    import ferry.plans.runner as runner

    to = lake(name="to", activity_log=log)
    item = replace(MERGE, merge=replace(MERGE.merge, partition=partition))
    go(spark, staged([(1, 1)]), to, [item])
    with monkeypatch.context() as m:
        m.setattr(runner, "_merge_files", lambda *a, **k: (_ for _ in ()).throw(OSError("cut off")))
        with pytest.raises(TransferFailed, match="cut off"):
            go(spark, staged([(2, 2)]), to, [item])
    go(spark, staged([(3, 3)]), to, [item])
    assert sorted((r.k, r.v) for r in scan(spark, to, "master").collect()) == [(1, 1), (2, 2), (3, 3)]


@pytest.mark.parametrize("log", [False, True])
def test_a_leftover_that_cannot_be_merged_is_given_up(spark, lake, staged, log):
    to = lake(name="to", activity_log=log)
    go(spark, staged([(1, 1)]), to, [MERGE])
    with pytest.raises(TransferFailed, match="DuplicateKeys"):
        go(spark, staged([(2, 2), (2, 3)]), to, [MERGE])
    go(spark, staged([(3, 3)]), to, [MERGE])
    go(spark, staged([(4, 4)]), to, [MERGE])
    assert rows(scan(spark, to, "master")) == [(1, 1), (3, 3), (4, 4)]
    if log:
        events = ActivityLog(spark, to, "p").events("staging")
        assert events.where("event = 'ABANDONED'").count() == 1


def test_a_database_table_is_not_copied_onto_itself(spark, db):
    table = fresh("self").lower()
    land(spark.range(7), db, table)
    other = replace(db, name="other", url=db.url + ";traceLevel=0")
    schema = jdbc.identity(spark, db, table)[0]
    for source, text, named in (
        (db, f"{schema}.{table}", table),
        (db, table, f'"{schema}"."{table.upper()}"'),
        (other, table.upper(), table),
        (db, f"( select * from {schema}.{table} ) x", table),
    ):
        lakes = (db,) if source is db else (source, db)
        plan = Plan("p", lakes, (Route(source.name, db.name, (Transfer(text, named),)),))
        with pytest.raises(TransferFailed, match="SelfOverwrite"):
            run(spark, plan)
        assert scan(spark, db, table).count() == 7


def test_append_to_a_quoted_table(spark, db):
    table = f'"{fresh("MixedT")}"'
    for n in (2, 5):
        landing = land(spark.range(n), db, table, mode="append")
        assert landing.rows == n
    assert scan(spark, db, table).count() == 7 and landing.rows_before == 2


def test_database_merges_leave_foreign_changes_alone(spark, lake, db, staged):
    staging, master = fresh("staging").upper(), fresh("master").upper()
    merge = DatabaseMerge(
        f'CREATE TABLE {master} ("k" INTEGER PRIMARY KEY, "v" INTEGER)',
        f'MERGE INTO {master} m USING {staging} s ON m."k" = s."k" WHEN MATCHED THEN UPDATE SET "v" = s."v"'
        f' WHEN NOT MATCHED THEN INSERT ("k", "v") VALUES (s."k", s."v")',
        master,
    )
    item = Transfer("t", staging, merge=merge)
    go(spark, staged([(1, 10)]), db, [item])
    jdbc.execute(spark, db, [f'UPDATE {master} SET "v" = 99'])
    go(spark, staged([(2, 20)]), db, [item])
    assert rows(scan(spark, db, master)) == [(1, 99), (2, 20)]
    # Rows that landed and were not merged still come first.
    with pytest.raises(TransferFailed):
        go(spark, staged([(3, 30)]), db, [replace(item, merge=replace(merge, merge_sql="NO SQL"))])
    go(spark, staged([(4, 40)]), db, [item])
    assert rows(scan(spark, db, master)) == [(1, 99), (2, 20), (3, 30), (4, 40)]


@pytest.mark.parametrize("database", [False, True])
def test_appends_reconcile_run_by_run(spark, lake, db, staged, database):
    to = replace(db, name="to", write_mode="append") if database else lake(name="to", write_mode="append")
    item = Transfer("t", fresh("landed").upper())
    for data in ([(1, 1)], [(1, 1), (2, 2)]):
        source = staged(data)
        plan = Plan("p", (source, to), (Route("source", "to", (item,)),))
        (row,) = reconcile_run(spark, plan, run(spark, plan)).collect()
        assert (row.src_rows, row.dst_rows, row.missing, row.extra) == (len(data), len(data), 0, 0)


def test_archives_reconcile_the_days_at_hand(spark, lake):
    source, to = lake("parquet", "source", snapshots=False), lake(name="to", snapshots=False)
    for days in ((1, 2), (2, 3)):
        df = spark.createDataFrame([(d * 10 + i, f"2024-01-0{d}") for d in days for i in range(3)], "id int, day string")
        land(df, source, "t")
        plan = Plan("p", (source, to), (Route("source", "to", (Archive("t", "day", "days"),)),))
        (row,) = reconcile_run(spark, plan, run(spark, plan)).collect()
        assert (row.src_rows, row.missing, row.extra) == (6, 0, 0)
    assert scan(spark, to, "days").count() == 9


def test_one_unreadable_landing_does_not_hide_the_others(spark, lake, staged):
    source, to = staged([(1, 1)]), lake(name="to")
    plan = Plan("p", (source, to), (Route("source", "to", (Transfer("t", "bad"), Transfer("t", "good"))),))
    done = run(spark, plan)
    done.landed[0].landing = replace(done.landed[0].landing, path=to.path("nowhere"))
    with pytest.raises(ReconcileFailed, match="source/to/bad") as failed:
        reconcile_run(spark, plan, done)
    assert [tuple(r)[2:7] for r in failed.value.compared.collect()] == [("good", 1, 1, 0, 0)]


def test_names_that_collide_raise(spark, lake):
    to = lake("csv", "files", snapshots=False)
    for name in ("sales.2023.csv", "sales.2024.csv"):
        land(spark.range(2), to, name)
    assert {t.destination for t in every_table(spark, to)} == {"sales.2023", "sales.2024"}
    assert scan(spark, to, "( select * from sales_2023 union all select * from sales_2024 ) x").count() == 4
    land(spark.range(2), to, "sales.2024.orc")
    with pytest.raises(ValueError, match="several files"):
        every_table(spark, to)
    with pytest.raises(ValueError, match="several files"):
        scan(spark, to, "( select * from sales_2024 ) x")


@pytest.mark.parametrize(
    ("url", "left"),
    [
        ("s3a://AK:SK@b/t", "s3a://b/t"),
        ("s3a://AK:S/K@b/t", "s3a://b/t"),
        ("jdbc:postgresql://u:p@ss@h/db?x=1", "jdbc:postgresql://h/db?x=1"),
        ("jdbc:postgresql://h/db?ssl=true&sslpassword=x&a=b", "jdbc:postgresql://h/db?ssl=true&a=b"),
        ("jdbc:oracle:thin:scott/tiger@//h:1521/svc", "jdbc:oracle:thin:@//h:1521/svc"),
        ("jdbc:sqlserver://h;user=a;password=b;encrypt=true", "jdbc:sqlserver://h;encrypt=true"),
        ("s3a://bucket/a:b@c", "s3a://bucket/a:b@c"),
    ],
)
def test_urls_lose_credentials(spark, url, left):
    assert strip_url(url) == left
    assert spark.range(1).select(strip_url(F.lit(url))).first()[0] == left


def test_the_log_holds_neither_urls_credentials_nor_secrets(spark, lake, staged, tmp_path):
    source = staged([(1, 1)])
    to = replace(lake(name="to", activity_log=True), password="hunter22")
    bad = Lake("bad", "s3a://AKIA:SECRET@bucket/x", driver="s3", format="orc", options={"fs.key": "hunter23"})
    items = (Transfer("t", "ok"), Transfer("( select raise_error('hunter22 and s3a://AK:SK@b/t') from t ) x", "broken"))
    plan = Plan("p", (source, to, bad), (Route("source", "to", items),))
    with pytest.raises(TransferFailed):
        run(spark, plan)
    held = json.dumps([r.asDict() for r in ActivityLog(spark, to, "p").events().collect()], default=str)
    assert not any(s in held for s in ("hunter22", "hunter23", "AKIA", "SECRET", "AK:SK"))
    assert str(tmp_path) not in json.loads(ActivityLog(spark, to, "p").latest("ok"))["path"]


def test_long_names_reach_a_database_log(spark, db):
    log = ActivityLog(spark, replace(db, name="log", activity_log=True), "i" * 600)
    from datetime import datetime, timezone

    for event in ("STARTED", "SUCCESS"):
        log.record("t" * 900, datetime.now(timezone.utc), event, run_id="r", landing="{}", must=True)
    assert log.events("t" * 900).count() == 2 and log.latest("t" * 900) == "{}"


def test_a_driver_that_refuses_the_url_says_so(spark, db):
    wrong = replace(db, url="jdbc:postgresql://u:pw@h/db")
    with pytest.raises(ValueError, match="does not accept jdbc:postgresql://h/db"):
        jdbc.table_exists(spark, wrong, "t")


@pytest.mark.parametrize("log", [False, True])
@pytest.mark.parametrize("partition", [None, "k"])
@pytest.mark.parametrize("fmt", ["orc", "csv"])
def test_leftovers_of_the_first_runs_are_merged(spark, lake, staged, log, partition, fmt, monkeypatch):
    """No master was ever made, and two runs were cut off; a landing that nobody noted is the third."""
    import ferry.plans.runner as runner

    to = lake(fmt, "to", activity_log=log)
    item = replace(MERGE, merge=replace(MERGE.merge, partition=partition))
    with monkeypatch.context() as m:
        m.setattr(runner, "_merge_files", lambda *a, **k: (_ for _ in ()).throw(OSError("cut off")))
        for data in ([(9, 1), (8, 1)], [(9, 2)]):
            with pytest.raises(TransferFailed, match="cut off"):
                go(spark, staged(data), to, [item])
    land(spark.createDataFrame([(7, 7)], "k int, v int"), to, "staging")
    go(spark, staged([(1, 1)]), to, [item])
    assert sorted((int(r.k), int(r.v)) for r in scan(spark, to, "master").collect()) == [(1, 1), (7, 7), (8, 1), (9, 2)]
    states = MergeLedger(spark, to, "staging").states()
    assert sorted(states.values()) == ["merged"] * 4
    # Nothing is merged again over what a later run brought.
    go(spark, staged([(9, 3)]), to, [item])
    go(spark, staged([(8, 3)]), to, [item])
    assert sorted((int(r.k), int(r.v)) for r in scan(spark, to, "master").collect()) == [(1, 1), (7, 7), (8, 3), (9, 3)]


def test_a_lost_log_does_not_lose_leftovers(spark, lake, staged, monkeypatch):
    """What the log could not record is known by the ledger."""
    import ferry.plans.runner as runner

    to = lake(name="to", activity_log=True)
    go(spark, staged([(1, 1)]), to, [MERGE])
    with monkeypatch.context() as m:
        m.setattr(ActivityLog, "record", lambda *a, **k: None)
        m.setattr(runner, "_merge_files", lambda *a, **k: (_ for _ in ()).throw(OSError("cut off")))
        with pytest.raises(TransferFailed, match="cut off"):
            go(spark, staged([(2, 2)]), to, [MERGE])
    go(spark, staged([(3, 3)]), to, [MERGE])
    assert rows(scan(spark, to, "master")) == [(1, 1), (2, 2), (3, 3)]


@pytest.mark.parametrize("anchored", [True, False])
@pytest.mark.parametrize("kind", ["orc", "jdbc"])
def test_a_lost_row_that_equals_an_earlier_one_is_missing(spark, lake, db, staged, kind, anchored):
    source, name = staged([(1, 1), (2, 2)]), fresh("landed")
    to = replace(db, name="to", write_mode="append", anchored=anchored) if kind == "jdbc" else lake(name="to", write_mode="append", anchored=anchored)
    plan = Plan("p", (source, to), (Route("source", "to", (Transfer("t", name),)),))
    run(spark, plan)
    done = run(spark, plan)
    whole = reconcile_run(spark, plan, done).first()
    assert (whole["src_rows"], whole["dst_rows"], whole["missing"], whole["extra"]) == (2, 2, 0, 0)
    left = read_landing(spark, to, done.landed[0].landing).collect()[:-1]
    less = spark.createDataFrame(left, "k int, v int")
    other = land(less, replace(to, write_mode="overwrite"), name + "_less")
    done.landed[0].landing = replace(done.landed[0].landing, path=other.path)
    found = reconcile_run(spark, plan, done).first()
    assert (found["src_rows"], found["dst_rows"], found["missing"], found["extra"]) == (2, 1, 1, 0)


@pytest.mark.parametrize("fmt", ["orc", "csv"])
@pytest.mark.parametrize("log", [False, True])
@pytest.mark.parametrize("how", [{}, {"on_match": "ignore"}, {"set_columns": ("v",)}])
def test_only_files_that_hold_staged_keys_are_written_again(spark, lake, fmt, log, how):
    made, to = lake("parquet", "source", snapshots=False), lake(fmt, "to", activity_log=log)
    item = replace(MERGE, merge=replace(MERGE.merge, files=16, **how))
    schema = "k int, v int, w string"
    data = [(i, i, "a") for i in range(300)] + [(None, 5, "n")]
    land(spark.createDataFrame(data, schema), made, "t")
    go(spark, made, to, [item])
    first = scan(spark, to, "master")
    held = {r[0] for r in first.select("_metadata.file_path").distinct().collect()}
    assert len(held) == 16
    staged = [(7, -1, "b"), (1000, -2, "b")]
    expected = upsert(spark.createDataFrame(data, schema), spark.createDataFrame(staged, schema), ["k"], **how)
    for n, rows_ in ((2, staged), (0, [])):
        land(spark.createDataFrame(rows_, schema), made, "t")
        go(spark, made, to, [item])
        now = scan(spark, to, "master")
        alike = expected.selectExpr(*[f"cast({c} as {t}) {c}" for c, t in now.dtypes])
        assert rows(now) == rows(alike)
        files_ = {r[0] for r in now.select("_metadata.file_path").distinct().collect()}
        assert len(files_ - held) <= n and len(held - files_) <= n
        held = files_
    assert Manifest.of(spark, latest_run(spark, to.path("master"))).rows == 302


def test_masters_of_other_keys_or_sizes_are_written_whole(spark, lake, staged):
    to = lake(name="to")
    merge = MERGE.merge
    for keys, number, data in ((("k",), 4, [(1, 1), (2, 2)]), (("k", "v"), 4, [(1, 1), (1, 2)]), (("k", "v"), 3, [(3, 3)]), (("k", "v"), None, [(4, 4)])):
        go(spark, staged(data), to, [replace(MERGE, merge=replace(merge, keys=keys, files=number))])
    assert rows(scan(spark, to, "master")) == [(1, 1), (1, 2), (2, 2), (3, 3), (4, 4)]
    found = Manifest.of(spark, latest_run(spark, to.path("master")))
    assert (found.keys, found.buckets, found.rows) == (["k", "v"], 3, 5)


def test_a_version_is_not_seen_before_its_manifest(spark, lake, staged, monkeypatch):
    import ferry.sinks.versions as versions

    to = lake(name="to")
    go(spark, staged([(i, i) for i in range(40)]), to, [MERGE])
    real = versions.files.write_text

    def cut_off(spark, path, text):
        if path.endswith("_manifest"):
            raise OSError("cut off")
        real(spark, path, text)

    with monkeypatch.context() as m:
        m.setattr(versions.files, "write_text", cut_off)
        with pytest.raises(TransferFailed, match="cut off"):
            go(spark, staged([(1, -1)]), to, [MERGE])
    assert scan(spark, to, "master").where("v < 0").count() == 0 and scan(spark, to, "master").count() == 40
    go(spark, staged([(2, -2)]), to, [MERGE])
    assert rows(scan(spark, to, "master").where("v < 0")) == [(1, -1), (2, -2)] and scan(spark, to, "master").count() == 40
