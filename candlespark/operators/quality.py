"""Validation and retention of candle tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlespark.functions.time import micros, unix_micros
from candlespark.operators.blocks import CANDLES, Series, over_series


def validate_candles(candles: DataFrame, key: tuple[str, ...] = ("symbol", "start_time")) -> DataFrame:
    """Number of rows per broken rule, over the whole table in one row."""
    o, h, lo, c = (F.col(x) for x in ("open", "high", "low", "close"))
    rules = {
        "null_price": o.isNull() | h.isNull() | lo.isNull() | c.isNull(),
        "negative_price": F.least(o, h, lo, c) < 0,
        "high_below_low": h < lo,
        "open_outside": (o < lo) | (o > h),
        "close_outside": (c < lo) | (c > h),
    }
    # Rules are counted per key first, which also counts the rows that share a key.
    per_key = candles.groupBy(*key).agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(test).alias(name) for name, test in rules.items()]
    )
    return per_key.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in rules],
        F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("duplicate_key"),
    )


def candle_gaps(candles: DataFrame, bar: str = "1 hour", series: Series = CANDLES) -> DataFrame:
    """Places where bars are missing: the candle after the gap and the number of missing bars."""
    length = micros(bar)

    def add(rows: DataFrame, w) -> DataFrame:
        step = unix_micros(F.col(series.time)) - unix_micros(F.lag(series.time, 1).over(w))
        return rows.withColumn("missing_bars", F.call_function("div", step, F.lit(length)) - 1)

    found = over_series(candles.select(*series.key, *series.order), series, 1, add)
    return found.where(F.col("missing_bars") > 0).select(*series.key, series.time, "missing_bars")


def retention_keep(df: DataFrame, days: int, by: str = "partition_date") -> DataFrame:
    """Rows of the last ``days`` days before the newest partition.

    The bound is a scalar subquery, so on a day-partitioned table older folders are not read.
    """
    oldest = df.agg(F.date_sub(F.max(by), days)).scalar()
    return df.where(F.col(by) >= oldest)
