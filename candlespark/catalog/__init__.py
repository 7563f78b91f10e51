"""Registered queries over the given tables, each with the SQL that must give the same rows."""

from candlespark.catalog import bars, ingest, lake, serving, streams, text, windows  # noqa: F401
from candlespark.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
