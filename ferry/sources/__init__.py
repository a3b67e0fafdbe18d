"""Lakes and the scans over them: files, SQL over files, and databases."""

from ferry.sources.lake import Lake, join_uri
from ferry.sources.scans import is_subselect, scan

__all__ = ["Lake", "is_subselect", "join_uri", "scan"]
