"""Looking at directories of any Hadoop file system; names only, never data."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ferry.sources.lake import join_uri

RUN = "run="
# Left beside partitioned masters before there were ledgers.
_MERGED = "_merged_run="

_EXTENSIONS = re.compile(r"(\.(csv|orc|parquet|tsv|txt|json|gz|gzip|bz2|zst|zstd|snappy|lz4|deflate|zlib))+$", re.I)


def _open(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme and authority, so that two spellings of one place are equal."""
    fs, p = _open(spark, path)
    return fs.makeQualified(p).toString().rstrip("/")


def children(spark: SparkSession, path: str) -> list[str]:
    """Visible entries directly below a directory."""
    fs, p = _open(spark, path)
    if not fs.exists(p) or not fs.getFileStatus(p).isDirectory():
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(join_uri(path, n) for n in names if not n.startswith(("_", ".")))


def table_name(path: str) -> str:
    """The name a file or directory goes by: no directories, no extensions that tell a format.

    Other dots are part of the name.
    """
    return _EXTENSIONS.sub("", path.rsplit("/", 1)[-1])


def named(paths: list[str]) -> dict[str, str]:
    """Paths by table name; two of one name raise, since either would hide the other."""
    found: dict[str, str] = {}
    for path in paths:
        name = table_name(path)
        if name.lower() in (n.lower() for n in found):
            raise ValueError(f"several files are called {name}: give their paths")
        found[name] = path
    return found


def _runs(spark: SparkSession, path: str) -> list[str]:
    names = children(spark, path)
    return [n for n in names if n.rsplit("/", 1)[-1].startswith(RUN)]


def _completed(spark: SparkSession, run: str) -> bool:
    return exists(spark, join_uri(run, "_SUCCESS"))


def run_id(path: str) -> str:
    return path.rsplit("/", 1)[-1].removeprefix(RUN)


def latest_run(spark: SparkSession, path: str) -> str | None:
    """The newest completed run directory of a landing, if it has any."""
    return next((r for r in reversed(_runs(spark, path)) if _completed(spark, r)), None)


def runs_since(spark: SparkSession, path: str, last: str) -> list[str]:
    """Completed run directories that are newer than the run ``last``, oldest first."""
    return [r for r in _runs(spark, path) if run_id(r) > last and _completed(spark, r)]


def completed_runs(spark: SparkSession, path: str) -> dict[str, str]:
    """Run → directory of every completed run, oldest first."""
    return {run_id(r): r for r in _runs(spark, path) if _completed(spark, r)}


def names(spark: SparkSession, path: str) -> list[str]:
    """The names of all entries directly below a directory, hidden ones too."""
    fs, p = _open(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, replaced if it is there."""
    fs, p = _open(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _open(spark, path)
    into = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(into, "UTF-8")
    finally:
        into.close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete one file, if it is there."""
    fs, p = _open(spark, path)
    fs.delete(p, False)


def uncommit(spark: SparkSession, run: str) -> None:
    """Take back a run's completion, so that readers go on with the former one."""
    fs, p = _open(spark, join_uri(run, "_SUCCESS"))
    fs.delete(p, False)


def merged_last(spark: SparkSession, path: str) -> str | None:
    """The run that was merged last into a table that has no runs of its own, where that was noted before there were ledgers."""
    fs, p = _open(spark, path)
    if not fs.exists(p):
        return None
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return max((n.removeprefix(_MERGED) for n in names if n.startswith(_MERGED)), default=None)


def reads_from(df: DataFrame, path: str) -> bool:
    """Whether a DataFrame reads anything at, below or around ``path``.

    The plan's relations say where they begin; their files are not listed.
    """
    spark = df.sparkSession
    place = qualified(spark, path).replace("file:///", "file:/")
    leaves = df._jdf.queryExecution().analyzed().collectLeaves().iterator()
    roots = []
    while leaves.hasNext():
        leaf = leaves.next()
        if leaf.getClass().getSimpleName() != "LogicalRelation":
            continue
        relation = leaf.relation()
        if relation.getClass().getSimpleName() == "HadoopFsRelation":
            found = relation.location().rootPaths().iterator()
            while found.hasNext():
                roots.append(qualified(spark, found.next().toString()).replace("file:///", "file:/"))
    return any(
        root == place or root.startswith(place + "/") or place.startswith(root + "/") and exists(spark, path)
        for root in roots
    )


def probe(spark: SparkSession, path: str) -> None:
    """Create an empty directory and remove it again."""
    fs, p = _open(spark, path)
    if not fs.mkdirs(p):
        raise OSError(f"cannot create {path}")
    fs.delete(p, False)
