from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from ferry.functions import column, fingerprint, quoted_names, redact, strip_url, without_credentials
from ferry.functions.credentials import without_secrets


def prints(df):
    return [tuple(r[0]) for r in df.select(fingerprint(df)).collect()]


def test_column_names_may_be_quoted_and_hold_dots(spark):
    df = spark.createDataFrame([(1, 2)], "`Incident.Date` int, `a b` int")
    assert df.select(column('"Incident.Date"'), column("a b")).first() == (1, 2)


def test_quoted_names_are_columns_of_any_case():
    assert quoted_names("\"A\" = 'x' and \"b\" = 1", ["A", "B"]) == "`A` = 'x' and `B` = 1"
    assert quoted_names('"a" = "A"', ["a", "A"]) == "`a` = `A`"
    assert quoted_names("""s = '"ts"' and t = 'it''s "ts"' and u = '\\'"ts"'""", []).count('"ts"') == 3
    assert quoted_names("""`a"b"` = "x""y\"""", ['x"y']) == """`a"b"` = `x"y`"""
    for text, names in (('"c" = 1', ["a"]), ('"c" = 1', ["C", "cc", "Ć"][1:]), ('"A" = 1', ["a", "a"])):
        with pytest.raises(ValueError, match="of the columns"):
            quoted_names(text, names)


@pytest.mark.parametrize(
    ("schema", "left", "right"),
    [
        ("a string, b string", (None, "x"), ("x", None)),
        ("a string, b string", ("a", "bc"), ("ab", "c")),
        ("a string", ("",), (None,)),
        ("a string", ("null",), (None,)),
        ("a array<string>", ([None, "x"],), (["x", None],)),
        ("a array<int>", ([],), (None,)),
        ("a struct<x:int,y:int>", ((1, None),), ((None, 1),)),
        ("a double", (1.0,), (1.0000000000000002,)),
        ("a double", (float("nan"),), (None,)),
        ("a binary", (b"\x00",), (b"\x00\x00",)),
    ],
)
def test_fingerprints_tell_rows_apart(spark, schema, left, right):
    a, b = prints(spark.createDataFrame([left, right], schema))
    assert a[0] != b[0] and a[1] != b[1] and a[0] != a[1]


def test_fingerprints_of_many_columns_see_every_null(spark):
    names = [f"c{i}" for i in range(130)]
    df = spark.range(131).select(
        *[F.when(F.col("id") != i, F.lit("x")).alias(n) for i, n in enumerate(names)]
    )
    assert len(set(prints(df))) == 131


def test_fingerprints_keep_microseconds(spark):
    df = spark.sql(
        "select timestamp_ntz'2024-01-01 00:00:00.000001' a, timestamp'2024-01-01 00:00:00.000001' b"
        " union all select timestamp_ntz'2024-01-01 00:00:00.000002', timestamp'2024-01-01 00:00:00.000001'"
        " union all select timestamp_ntz'2024-01-01 00:00:00.000001', timestamp'2024-01-01 00:00:00.000002'"
    )
    assert len(set(prints(df))) == 3


def test_fingerprints_ignore_map_order_and_zero_sign(spark):
    schema = "m map<string,double>, x double"
    df = spark.createDataFrame([({"a": 1.0, "b": -0.0}, 0.0), ({"b": 0.0, "a": 1.0}, -0.0)], schema)
    a, b = prints(df)
    assert a == b


def test_redact_structs_and_arrays(spark):
    record = "struct<name:string,url:string,username:string,password:string>"
    lake = ("db", "jdbc:x://u:p@h/db;password=p;ssl=1", "u", "p")
    df = spark.createDataFrame([([lake], lake)], f"many array<{record}>, one {record}")
    out = redact(redact(df, "many"), "one").first()
    clean = {"name": "db", "url": "jdbc:x://h/db;ssl=1"}
    assert json.loads(out["many"]) == [clean] and json.loads(out["one"]) == clean


def test_redaction_of_columns_and_text_agree(spark):
    url = "jdbc:postgresql://me:secret@host:5432/db?ssl=true&user=me&Password=x"
    assert strip_url(url) == "jdbc:postgresql://host:5432/db?ssl=true"
    df = spark.createDataFrame([(url,)], "url string")
    assert df.select(strip_url(F.col("url"))).first()[0] == strip_url(url)


def test_without_credentials_goes_deep():
    config = {"lakes": [{"name": "a", "password": "x", "properties": {"password": "y"}}], "username": "z"}
    assert without_credentials(config) == {"lakes": [{"name": "a"}]}


def test_braced_and_named_secrets_go_whole(spark):
    urls = ["jdbc:sqlserver://h;password={a;b}", "jdbc:sqlserver://h;user=u;password={a}};b c};encrypt=true", "jdbc:sqlserver://h;password={open;x=1"]
    cleaned = [strip_url(u) for u in urls]
    assert cleaned == ["jdbc:sqlserver://h", "jdbc:sqlserver://h;encrypt=true", "jdbc:sqlserver://h;x=1"]
    frame = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in frame.select(strip_url(frame.u)).collect()] == cleaned
    assert without_secrets("login failed: password=x, pwd = 'a b'; token={q;r} keys=3") == "login failed: password=***, pwd = ***; token=*** keys=3"
