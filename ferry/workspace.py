"""Where intermediate tables are written: the folder the cluster names, nothing else."""

from __future__ import annotations

import tempfile
import uuid
from datetime import datetime, timezone
from functools import cache

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local session may do without one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if is_single_process(spark):
        return _own_folder()
    raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")


def is_single_process(spark: SparkSession) -> bool:
    """Whether driver and executors are one process on one machine."""
    master = spark.conf.get("spark.master", "")
    return master == "local" or master.startswith("local[")


@cache
def _own_folder() -> str:
    return "file:" + tempfile.mkdtemp(prefix="ferry-")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, whose files go when the driver ends."""
    folder = f"{shared_folder(spark)}/ferry/{label}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return f"{folder}/{label}"


def new_run_id() -> str:
    """Sorts by time, is unique, and has no colon (colons break relative paths)."""
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
