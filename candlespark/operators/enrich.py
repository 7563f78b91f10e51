"""Enrichment joins."""

from __future__ import annotations

from pyspark.sql import DataFrame

def join_metadata(df: DataFrame, metadata: DataFrame) -> DataFrame:
    """Left join of coin metadata on the symbol; unmatched rows get nulls. The planner picks the strategy by size."""
    return df.join(metadata, "symbol", "left")


def join_sentiment(df: DataFrame, sentiment: DataFrame, strategy: str | None = None) -> DataFrame:
    """Left join of daily sentiment on date and symbol.

    Without ``strategy`` the planner decides by size, and adaptive execution may split a hot
    ``(date, symbol)``. ``strategy="merge"`` asks for a sort-merge join.
    """
    right = sentiment.hint(strategy) if strategy else sentiment
    return df.join(right, ["partition_date", "symbol"], "left")


def enrich(df: DataFrame, metadata: DataFrame, sentiment: DataFrame) -> DataFrame:
    """Metadata, then sentiment; columns start with ``partition_date, symbol``."""
    return join_sentiment(join_metadata(df, metadata), sentiment)
