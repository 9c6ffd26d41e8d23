"""Queries by name, and the SQL that checks each."""

from . import counts, graph, scoring, words  # noqa: F401  they register their queries
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
