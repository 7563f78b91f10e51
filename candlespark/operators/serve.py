"""Serving queries: pages of candles, newest rows, indicator pages, API row shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlespark.functions.numeric import nan_to_null
from candlespark.functions.time import iso_text
from candlespark.operators.blocks import Series
from candlespark.operators.indicators import indicators

# Page size by default and at most, and extra rows read to warm the indicators up.
DEFAULT_LIMIT, MAX_LIMIT, WARMUP = 200, 1000, 50


def _check_limit(limit: int) -> None:
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must lie between 1 and {MAX_LIMIT}")


def _first_rows(candles: DataFrame, order: Column, n: int) -> DataFrame:
    """First ``n`` rows per symbol. Spark cuts each map task's rows to ``n`` per symbol before the shuffle."""
    ranked = candles.withColumn("_rank", F.row_number().over(Window.partitionBy("symbol").orderBy(order)))
    return ranked.where(F.col("_rank") <= n).drop("_rank")


def candles_page(
    candles: DataFrame, limit: int = DEFAULT_LIMIT, newest: bool = False, symbol: str | None = None
) -> DataFrame:
    """The oldest (or newest) ``limit`` candles, of one symbol or of each symbol; one symbol comes sorted."""
    _check_limit(limit)
    time = F.col("start_time")
    if symbol is None:
        return _first_rows(candles, time.desc() if newest else time.asc(), limit)
    page = candles.where(F.col("symbol") == symbol)
    return page.orderBy(time.desc() if newest else time.asc()).limit(limit).orderBy(time.asc())


def latest_candles(candles: DataFrame, k: int = DEFAULT_LIMIT) -> DataFrame:
    return candles_page(candles, k, newest=True)


def api_shape(candles: DataFrame) -> DataFrame:
    """Rows as the API hands them out: ISO time text and no NaN."""
    prices = [nan_to_null(F.col(c)).alias(c) for c in ("open", "high", "low", "close", "volume")]
    return candles.select("symbol", iso_text(F.col("start_time")).alias("time"), *prices)


def sliding_with_indicators(
    candles: DataFrame, limit: int = DEFAULT_LIMIT, warmup: int = WARMUP, symbol: str | None = None
) -> DataFrame:
    """Indicator page: the oldest ``limit + warmup`` candles per symbol, indicators, then the last ``limit``.

    A symbol contributes at most ``limit + warmup`` rows to the windows, so plain ones will do.
    """
    _check_limit(limit)
    if symbol is not None:
        candles = candles.where(F.col("symbol") == symbol)
    oldest = _first_rows(candles, F.col("start_time").asc(), limit + warmup)
    page = _first_rows(indicators(oldest, Series(block_rows=None)), F.col("start_time").desc(), limit)
    cleaned = {c: nan_to_null(F.col(c)) for c in ("sma_7", "bb_middle", "bb_upper", "bb_lower", "rsi")}
    return page.withColumns(cleaned).withColumn("start_time", iso_text(F.col("start_time")))


def symbols(candles: DataFrame) -> DataFrame:
    return candles.select("symbol").distinct()


def latest_price(candles: DataFrame) -> DataFrame:
    return candles.groupBy("symbol").agg(
        F.max("start_time").alias("start_time"), F.max_by("close", "start_time").alias("close")
    )


def price_history(candles: DataFrame, symbol: str | None = None) -> DataFrame:
    history = candles if symbol is None else candles.where(F.col("symbol") == symbol)
    return history.select("symbol", "start_time", "close")
