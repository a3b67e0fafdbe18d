"""Sinks: landing a DataFrame in a lake, and masters that landed rows are merged into."""

from ferry.sinks.landing import Landing, SelfOverwrite, land, read_landing
from ferry.sinks.masters import land_master, land_partitions
from ferry.sinks.versions import land_version

__all__ = ["Landing", "SelfOverwrite", "land", "land_master", "land_partitions", "land_version", "read_landing"]
