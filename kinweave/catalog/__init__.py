"""Registered queries with their checking SQL."""

from kinweave.catalog import columns, graphs, vectors, whole  # noqa: F401  (registers the queries)
from kinweave.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
