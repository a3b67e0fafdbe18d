"""Which staged runs were merged: marks beside the runs, whatever a log or a master says.

A run that is going to be merged is noted before its rows land, and its note is closed after the master's new version
is committed. So what landed and was never merged is known, also if no master was ever made and no log is kept. A job that
dies between commit and closing leaves its run open: it is merged again, which leaves the same master, since no
other version came between.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import SparkSession, types as T

from ferry.sources import files
from ferry.sources.lake import Lake, join_uri

# Hidden from readers, as every name with an underscore is.
_LEDGER = "_merges"
STAGED, MERGED, GIVEN_UP = "staged", "merged", "given_up"


class MergeLedger:
    """The marks of one staging table. Each is a small file named by run and state."""

    def __init__(self, spark: SparkSession, lake: Lake, staging: str):
        self.spark, self.table = spark, lake.path(staging)
        self.place = join_uri(self.table, _LEDGER)

    def states(self) -> dict[str, str]:
        """Run → state, oldest first; a closing state wins over the first one."""
        found: dict[str, str] = {}
        for name in files.names(self.spark, self.place):
            run, _, state = name.rpartition(".")
            if state in (STAGED, MERGED, GIVEN_UP) and found.get(run, STAGED) == STAGED:
                found[run] = state
        return dict(sorted(found.items()))

    def stage(self, run: str, schema: T.StructType) -> None:
        """Note, before anything lands, that a run is to be merged, and which types it has."""
        files.write_text(self.spark, self._mark(run, STAGED), schema.json())

    def close(self, runs: Iterable[str], state: str, version: str = "") -> None:
        """Note that runs were merged into a version of the master, or never will be."""
        for run in runs:
            files.write_text(self.spark, self._mark(run, state), version)
            files.remove(self.spark, self._mark(run, STAGED))

    def open_runs(self, own: str, since: str | None) -> dict[str, tuple[str, T.StructType | None]]:
        """Runs but ``own`` that landed whole and are neither merged nor given up: place and types, oldest first.

        A landing that nobody noted counts as well if it is newer than all that are closed, or than ``since``, the run that a master
        names where nothing is closed. If there is neither, only the last one does: it replaced those before it.
        """
        states, runs = self.states(), files.completed_runs(self.spark, self.table)
        closed = [run for run, state in states.items() if state != STAGED]
        last = max(closed, default=since)
        unknown = [run for run in runs if run not in states and run != own and (last is None or run > last)]
        found: dict[str, tuple[str, T.StructType | None]] = {}
        for run, place in runs.items():
            if run != own and states.get(run) == STAGED:
                found[run] = place, T.StructType.fromJson(json.loads(files.read_text(self.spark, self._mark(run, STAGED))))
            elif run in (unknown if last is not None else unknown[-1:]):
                found[run] = place, None
        return found

    def _mark(self, run: str, state: str) -> str:
        return join_uri(self.place, f"{run}.{state}")
