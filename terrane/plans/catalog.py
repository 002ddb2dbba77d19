"""All queries of the engine by name, and their SQL twins."""

from __future__ import annotations

from . import extract_queries, finder_queries, geo_queries, release_queries, search_queries, table_queries  # noqa: F401
from .registry import COVERS, ORACLE_SQL, QUERIES

__all__ = ["COVERS", "ORACLE_SQL", "QUERIES"]
