"""Every registered query against its SQL in DuckDB, at the smallest scale."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from queries import ORACLES, QUERIES
from tools.check import compare, open_tables

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return open_tables(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, SF_DIR) == ""


def test_entry(spark):
    days = entry(spark)
    assert days.columns == ["bucket_val", "rows"]
    assert days.agg({"rows": "sum"}).first()[0] == 1000
