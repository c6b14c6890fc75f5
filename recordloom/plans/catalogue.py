"""All queries of the reference's own operators, with the SQL they must agree with."""

from . import archives, attaching, books, cells, changing, checking, linking, lists, merging, naming, paging, papers, rereading, staged, texts  # noqa: F401  the modules put their queries down when they are imported
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
