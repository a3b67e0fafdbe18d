from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from ferry.sources import Lake  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", f"file:{tmp_path_factory.mktemp('shared')}")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(tmp_path):
    """Makes file lakes below the test's own folder."""

    def make(fmt: str = "orc", name: str = "lake", **options) -> Lake:
        return Lake(name, f"file:{tmp_path}/{name}", format=fmt, **options)

    return make


@pytest.fixture
def db(spark):
    from queries.registry import database

    return database(spark)


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
