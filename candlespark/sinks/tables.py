"""Writes to partitioned Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def _spread(df: DataFrame, by: list[str]) -> DataFrame:
    """Bring rows of a partition together, but let adaptive execution split a large partition.

    ``rebalance`` merges small partitions and cuts large ones to the advisory size, so neither thousands
    of small files nor one task with a third of the data comes out.
    """
    return df.hint("rebalance", *by)


def write_dynamic(df: DataFrame, path: str, by: list[str]) -> None:
    """Replace exactly the partitions present in ``df``; running the same load twice changes nothing."""
    (
        _spread(df, by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def write_full(df: DataFrame, path: str, by: list[str]) -> None:
    """Replace the whole table."""
    (
        _spread(df, by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*by)
        .parquet(path)
    )


def write_split(df: DataFrame, path: str, by: str = "status") -> None:
    """Write the parts of ``df`` to a folder per value of ``by`` in one pass; a later read of one folder opens no other."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(by).parquet(path)
