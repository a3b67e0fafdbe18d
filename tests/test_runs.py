from __future__ import annotations

import json
from dataclasses import replace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ferry.operators import ActivityLog, missing_lakes, problems, profile, writable
from ferry.plans import (
    Archive,
    DatabaseMerge,
    Plan,
    Route,
    Transfer,
    TransferFailed,
    Upsert,
    every_table,
    expand_control,
    preflight,
    reconcile_run,
    run,
)
from ferry.sinks import Landing, SelfOverwrite, land, read_landing
from ferry.sources import Lake, files, jdbc, scan
from queries.registry import fresh


def plan(name, lakes, *routes):
    return Plan(name, tuple(lakes), tuple(Route(s, d, tuple(items)) for s, d, items in routes))


@pytest.fixture
def source(spark, lake):
    made = lake("parquet", "source")
    land(spark.range(10).withColumn("v", F.col("id") * 2), made, "numbers")
    land(spark.range(3), made, "few")
    return made


def test_plans_are_checked(lake):
    one, two = lake(name="one"), lake(name="two")
    move = Transfer("a", "b")
    with pytest.raises(ValueError, match="name"):
        plan("", [one], ("one", "one", [move]))
    with pytest.raises(ValueError, match="unknown lakes \\['three'\\]"):
        plan("p", [one, two], ("one", "three", [move]))
    with pytest.raises(ValueError, match="several lakes"):
        plan("p", [one, one], ("one", "one", [move]))
    with pytest.raises(ValueError, match="not both"):
        plan("p", [one, two], ("one", "two", [move, Archive("a", "d", "b")]))


def test_fan_out_lands_in_order_and_reconciles(spark, lake, source):
    a, b = lake("orc", "a"), lake("csv", "b")
    items = [Transfer("numbers", "n"), Transfer("few", "f"), Transfer("( select id from few ) x", "g")]
    p = plan("fan", [source, a, b], ("source", "a", items), ("source", "b", items))
    done = run(spark, p)
    got = [(r["destination_lake"], r["table"], r["rows"]) for r in done.manifest(spark).collect()]
    assert got == [(d, t, n) for d in "ab" for t, n in (("n", 10), ("f", 3), ("g", 3))]
    assert list(done.names()["source"]) == ["a", "b"] and len(done.names()["source"]["a"]) == 3
    compared = reconcile_run(spark, p, done).collect()
    counts = [(r["src_rows"], r["missing"], r["extra"]) for r in compared]
    assert counts == [(10, 0, 0), (3, 0, 0), (3, 0, 0)] * 2


def test_two_sources_to_two_destinations(spark, lake, source, db):
    table = fresh("more")
    land(spark.range(4).withColumn("v", F.col("id")), db, table)
    a, b = lake("orc", "a", write_mode="append"), lake("csv", "b", write_mode="append")
    routes = [
        (s, d, [Transfer(t, "n"), Transfer(f"( select id from {t} where id > 2 ) x", "big")])
        for s, t in (("source", "numbers"), ("database", table))
        for d in "ab"
    ]
    # The database keeps lower-case names only in quotes.
    routes[2:] = [
        (s, d, [i, Transfer(f'( select "id" from {table} where "id" > 2 ) x', "big")])
        for s, d, (i, _) in routes[2:]
    ]
    done = run(spark, plan("p", [source, db, a, b], *routes))
    assert [x.landing.rows for x in done.landed] == [10, 7, 10, 7, 4, 1, 4, 1]
    for to in (a, b):
        assert scan(spark, to, "n").count() == 14 and scan(spark, to, "big").count() == 8


def test_one_failure_does_not_stop_the_others(spark, lake, source):
    to = lake(name="to", activity_log=True)
    items = [Transfer("nowhere", "bad"), Transfer("few", "good")]
    with pytest.raises(TransferFailed, match="source/to/bad") as failed:
        run(spark, plan("mixed", [source, to], ("source", "to", items)))
    assert [x.landing.name for x in failed.value.run.landed] == ["good"]
    status = {r["table_name"]: r for r in ActivityLog(spark, to, "mixed").status().collect()}
    assert status["good"]["result"] == "SUCCESS" and status["good"]["finish"] is not None
    assert status["bad"]["result"] == "FAILED" and "PATH_NOT_FOUND" in status["bad"]["stacktrace"]
    assert json.loads(status["bad"]["configuration"])["name"] == "mixed"


def test_the_log_holds_no_credentials(spark, lake, source, db):
    secret = replace(db, name="db", options={"token": "t0ken"}, password="app")
    to = lake(name="to", activity_log=True)
    run(spark, plan("p", [source, to, secret], ("source", "to", [Transfer("few", "f")])))
    text = ActivityLog(spark, to, "p").status().first()["configuration"]
    config = json.loads(text)
    assert "t0ken" not in text
    assert not {"username", "password", "properties"} & set(config["datalakes"][2])


def test_a_log_that_cannot_be_opened_is_done_without(spark, lake, source, db):
    broken = replace(db, name="log", url="jdbc:derby:/nowhere/at/all", activity_log=True)
    to = lake(name="to")
    done = run(spark, plan("p", [source, broken, to], ("source", "to", [Transfer("few", "f")])))
    assert done.landed[0].landing.rows == 3


def test_database_logs_are_created_and_upgraded(spark, lake, source, db):
    log_lake = replace(db, name="log", activity_log=True)
    if jdbc.table_exists(spark, db, "integration_activity"):
        jdbc.execute(spark, db, ["DROP TABLE integration_activity"])
    ActivityLog(spark, log_lake, "first")
    assert ActivityLog(spark, log_lake, "first").status().count() == 0
    jdbc.execute(spark, db, ["DROP TABLE integration_activity"])
    older = (
        'CREATE TABLE integration_activity ("integration_name" VARCHAR(99), "host_name" VARCHAR(99),'
        ' "table_name" VARCHAR(99), "start" TIMESTAMP, "event" VARCHAR(99), "event_time" TIMESTAMP,'
        ' "run_id" VARCHAR(99))'
    )
    row = (
        "INSERT INTO integration_activity VALUES ('old', 'h', 't', TIMESTAMP('2024-01-01 00:00:00'),"
        " 'STARTED', TIMESTAMP('2024-01-01 00:00:00'), 'r')"
    )
    jdbc.execute(spark, db, [older, row])
    to = lake(name="to")
    run(spark, plan("new", [source, log_lake, to], ("source", "to", [Transfer("few", "f")])))
    status = {r["integration_name"]: r for r in ActivityLog(spark, log_lake, "x").status().collect()}
    assert status["new"]["result"] == "SUCCESS"
    assert status["old"]["result"] is None and status["old"]["configuration"] == "{}"
    assert Landing(**json.loads(ActivityLog(spark, log_lake, "new").latest("f"))).rows == 3


def test_masters_grow_run_by_run_and_recover_leftovers(spark, lake, monkeypatch):
    # Looked at first, the wrong column below would keep its rows from landing at all.
    monkeypatch.setattr("ferry.plans.runner.unfit", lambda df, merge: [])
    source, to = lake("parquet", "source"), lake(name="to", activity_log=True)
    merge = Upsert("master", ("k",))

    def go(data, **changed):
        land(spark.createDataFrame(data, "k int, v int"), source, "t")
        item = Transfer("t", "staging", merge=replace(merge, **changed))
        run(spark, plan("p", [source, to], ("source", "to", [item])))

    def master():
        found = ActivityLog(spark, to, "p").latest("master")
        return rows(read_landing(spark, to, Landing(**json.loads(found))))

    go([(1, 1), (2, 2)])
    assert master() == [(1, 1), (2, 2)]
    # These rows land, but a wrong column keeps them from being merged.
    with pytest.raises(TransferFailed):
        go([(2, 20), (3, 30)], set_columns=("nope",))
    assert master() == [(1, 1), (2, 2)]
    go([(3, 33), (4, 4)])
    assert master() == [(1, 1), (2, 20), (3, 33), (4, 4)]
    go([(4, 44)])
    assert master() == [(1, 1), (2, 20), (3, 33), (4, 44)]


def test_a_wrong_column_is_found_before_rows_are_moved(spark, lake, source):
    to = lake(name="to")
    item = Transfer("few", "staging", merge=Upsert("master", ("id",), set_columns=("nope",)))
    with pytest.raises(TransferFailed, match="set_columns name nope"):
        run(spark, plan("p", [source, to], ("source", "to", [item])))
    assert not files.exists(spark, to.path("staging"))


def test_masters_without_a_log(spark, lake, monkeypatch):
    monkeypatch.setattr("ferry.plans.runner.unfit", lambda df, merge: [])
    source, to = lake("parquet", "source"), lake("csv", "to", snapshots=False)
    for data, wrong in (
        ([(1, "a")], None),
        ([(7, "left over"), (2, "b")], ("nope",)),
        ([(1, "b"), (2, "c")], None),
    ):
        land(spark.createDataFrame(data, "k int, v string"), source, "t")
        item = Transfer("t", "staging", merge=Upsert("master", ("k",), set_columns=wrong))
        try:
            run(spark, plan("p", [source, to], ("source", "to", [item])))
        except TransferFailed:
            assert wrong
    schema = spark.createDataFrame([], "k int, v string").schema
    master = scan(spark, to, "master", schema)
    assert rows(master) == [(1, "b"), (2, "c"), (7, "left over")]


def _merge(staging, master):
    return DatabaseMerge(
        f'CREATE TABLE {master} ("id" BIGINT NOT NULL PRIMARY KEY, "v" BIGINT)',
        f'MERGE INTO {master} m USING {staging} s ON m."id" = s."id"'
        ' WHEN MATCHED THEN UPDATE SET "v" = s."v"'
        ' WHEN NOT MATCHED THEN INSERT ("id", "v") VALUES (s."id", s."v")',
        master,
    )


def test_database_merges_recover_what_an_earlier_run_left(spark, lake, source, db):
    staging, master = fresh("staging"), fresh("master")
    land(spark.sql("select 100L as id, 1L as v"), db, staging)
    item = Transfer("numbers", staging, merge=_merge(staging, master))
    run(spark, plan("p", [source, db], ("source", "database", [item])))
    assert scan(spark, db, master).count() == 11
    assert scan(spark, db, staging).count() == 10


def test_a_failed_merge_fails_the_transfer(spark, lake, source, db):
    to = lake(name="log", activity_log=True)
    staging = fresh("staging")
    bad = replace(_merge(staging, fresh("master")), merge_sql="MERGE NONSENSE")
    item = Transfer("numbers", staging, merge=bad)
    with pytest.raises(TransferFailed):
        run(spark, plan("p", [source, to, db], ("source", "database", [item])))
    assert ActivityLog(spark, to, "p").status().first()["result"] == "FAILED"
    with pytest.raises(TransferFailed, match="for databases"):
        run(spark, plan("p", [source, to], ("source", "log", [Transfer("few", "f", merge=bad)])))


def test_overwriting_a_table_with_itself_is_refused(spark, db):
    table, copy = fresh("t"), fresh("copy")
    land(spark.range(3), db, table)
    for text in (table, table.upper(), f"( select * from {table} where \"id\" > 0 ) x"):
        with pytest.raises(TransferFailed, match="SelfOverwrite"):
            run(spark, plan("p", [db], ("database", "database", [Transfer(text, table)])))
    assert scan(spark, db, table).count() == 3
    run(spark, plan("p", [db], ("database", "database", [Transfer(table, copy)])))
    assert scan(spark, db, copy).count() == 3
    assert SelfOverwrite.__mro__[1] is ValueError


def test_items_of_one_destination_keep_their_order(spark, lake, source):
    to = lake(name="to", write_mode="append")
    items = [Transfer("few", "t"), Transfer("few", "u"), Transfer("( select id from numbers ) x", "t")]
    done = run(spark, plan("p", [source, to], ("source", "to", items)))
    assert [x.landing.rows for x in done.landed] == [3, 3, 10]
    assert scan(spark, to, "t").count() == 13


def test_archives_run_from_files_and_databases(spark, lake, db):
    source, to = lake("parquet", "source"), lake(name="to")
    dated = [("2009-07-15", 1), ("2009-08-15", 2)]
    df = spark.createDataFrame(dated, "IncidentDate string, id int")
    land(df, source, "incidents")
    table = fresh("incidents")
    land(df, db, table, column_types="IncidentDate VARCHAR(10)")
    for where, name in ((source, "incidents"), (db, table)):
        limits = ("\"IncidentDate\"::date <= to_date('08/01/2009', 'MM/dd/yyyy')",)
        item = Archive(name, '"IncidentDate"', f"days_{where.name}", limits)
        done = run(spark, plan("a", [where, to], (where.name, "to", [item])))
        landed = read_landing(spark, to, done.landed[0].landing)
        assert [(r["id"], str(r["bucket_val"])) for r in landed.collect()] == [(1, "2009-07-15")]


def test_control_rows_become_transfers(spark, lake, source):
    control = spark.createDataFrame(
        [("d", "few", "f", "master", "a, b", None), (None, "numbers", "n", None, None, None)],
        "DESCRIPTION string, QUERY string, DESTINATION string, MASTER string, KEYS string, ON_MATCH string",
    )
    one, two = expand_control(control)
    assert one == Transfer("few", "f", "d", Upsert("master", ("a", "b")))
    assert two == Transfer("numbers", "n")
    database = spark.createDataFrame(
        [("d", "q", "t", "CREATE", "MERGE")],
        "description string, query string, destination string, master_sql string, merge_sql string",
    )
    assert expand_control(database)[0].merge == DatabaseMerge("CREATE", "MERGE")
    with pytest.raises(ValueError, match="destination"):
        expand_control(control.drop("DESTINATION"))


def test_control_queries_come_after_plain_items(spark, lake, source, db):
    control = fresh("control")
    rows_ = [("a", "( select id from numbers where id > 4 ) x", "big"), ("b", "few", "all_few")]
    land(spark.createDataFrame(rows_, "description string, query string, destination string"), db, control)
    to = lake(name="to")
    items = [Transfer(control, "c", control=True, control_lake="database"), Transfer("few", "plain")]
    done = run(spark, plan("p", [source, to, db], ("source", "to", items)))
    landed = [(x.landing.name, x.landing.rows) for x in done.landed]
    assert landed[0] == ("plain", 3) and sorted(landed[1:]) == [("all_few", 3), ("big", 5)]
    with pytest.raises(TransferFailed, match="source/to/c"):
        run(spark, plan("p", [source, to], ("source", "to", [Transfer("nowhere", "c", control=True)])))


def test_every_table_of_a_lake(spark, lake, source, db):
    to = lake(name="to")
    assert [t.destination for t in every_table(spark, source)] == ["few", "numbers"]
    run(spark, plan("p", [source, to], ("source", "to", every_table(spark, source))))
    assert scan(spark, to, "numbers").count() == 10

    schema = fresh("s").upper()
    keyed = f'CREATE TABLE {schema}."Mixed Case" ("id" BIGINT NOT NULL PRIMARY KEY)'
    jdbc.execute(spark, db, [f"CREATE SCHEMA {schema}", keyed, f"CREATE TABLE {schema}.B (A INT)"])
    found = every_table(spark, db, schema)
    assert [t.source for t in found] == [f'"{schema}"."B"', f'"{schema}"."Mixed Case"']
    assert jdbc.primary_key(spark, db, found[1].source) == ["id"]
    done = run(spark, plan("p", [db, to], ("database", "to", found)))
    assert [x.landing.name for x in done.landed] == ["b", "mixed case"]


def test_preflight(spark, lake, source, db):
    df = spark.createDataFrame([(1, None, {"a": 1}), (2, "abc", None)], "i int, s string, m map<string,int>")
    land(df, source, "t")
    assert rows(profile(df)) == sorted(
        [
            ("i", "int", True, True, True, 0, None),
            ("s", "string", True, True, True, 1, 3),
            ("m", "map<string,int>", False, True, False, 1, None),
        ],
        key=repr,
    )
    assert problems(spark, source, "t", lake("csv", "c"), "t") == ["csv cannot hold m map<string,int>"]
    assert problems(spark, source, "t", lake("orc", "o"), "t") == []
    assert problems(spark, source, "none", db, "t") == ["cannot read none in lake source: AnalysisException"]
    grown = lake("orc", "grown", write_mode="append")
    land(spark.range(1).withColumn("x", F.lit(1)), grown, "t")
    assert problems(spark, source, "few", grown, "t") == ["t has a column x that the source lacks"]
    assert problems(spark, source, "numbers", grown, "t") == [
        "t lacks the column v",
        "t has a column x that the source lacks",
    ]
    assert writable(spark, grown) is None
    assert "cannot write" in writable(spark, Lake("x", "nofs://x/y", format="orc"))


def test_a_plan_is_checked_without_reading_rows(spark, lake, source, db):
    nowhere = Lake("nowhere", "nofs://x/y", format="orc")
    p = plan(
        "p",
        [source, nowhere, lake("csv", "to")],
        ("source", "to", [Transfer("few", "f"), Transfer("none", "n")]),
        ("source", "nowhere", [Transfer("few", "f")]),
    )
    found = {(r["destination_lake"], r["table"]): r["problem"] for r in preflight(spark, p).collect()}
    assert set(found) == {("nowhere", None), ("to", "n")}


def test_reconciling_a_run_finds_and_records_differences(spark, lake, source):
    to = lake(name="to", activity_log=True)
    p = plan("p", [source, to], ("source", "to", [Transfer("numbers", "n"), Transfer("few", "f")]))
    done = run(spark, p)
    land(spark.range(7).withColumn("v", F.col("id") * 2), source, "numbers")
    got = {r["table"]: r for r in reconcile_run(spark, p, done).collect()}
    assert (got["n"]["missing"], got["n"]["extra"]) == (0, 3) and got["f"]["src_rows"] == 3
    log = ActivityLog(spark, to, "p")
    failed = log.status().where("result = 'FAILED'").collect()
    assert [r["table_name"] for r in failed] == ["n"] and "0 missing, 3 extra" in failed[0]["stacktrace"]
    assert Landing(**json.loads(log.latest("n"))).rows == 10 and log.leftovers("n") == []


def test_missing_lakes(spark):
    p = spark.createDataFrame(
        [(1, "a", "b"), (2, "a", "x"), (3, "y", "y")],
        "id int, source_lake string, destination_lake string",
    )
    lakes = spark.createDataFrame([("a",), ("b",), ("a",)], "name string")
    found = missing_lakes(p, lakes).orderBy("id").select("id", "unknown")
    assert rows(found) == [(2, "x"), (3, "y")]
