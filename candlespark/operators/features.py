"""Windowed features over klines, and the hour-by-symbol pivot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from candlespark.functions.numeric import safe_ln
from candlespark.operators.blocks import KLINES, Series, over_series

# The "24h" frame is rows -24..0, that is 25 rows.
FRAME_LO, FRAME_HI = -24, 0


def _check_frame(lo: int, hi: int) -> None:
    if not lo <= hi <= 0:
        raise ValueError("the frame must lie at or before the current row")


def log_return_column(price: str, window: WindowSpec) -> Column:
    """ln(price) - ln(previous price); null on the first row and for prices that are not positive."""
    return safe_ln(F.col(price)) - safe_ln(F.lag(price, 1).over(window))


def log_return(df: DataFrame, series: Series = KLINES, price: str = "close") -> DataFrame:
    return over_series(df, series, 1, lambda rows, w: rows.withColumn("log_return", log_return_column(price, w)))


def sma_rows(
    df: DataFrame, lo: int = FRAME_LO, hi: int = FRAME_HI, series: Series = KLINES, price: str = "close"
) -> DataFrame:
    """Mean over rows ``lo..hi``; the first rows average what is there."""
    _check_frame(lo, hi)
    return over_series(
        df, series, -lo, lambda rows, w: rows.withColumn("sma_24h", F.avg(price).over(w.rowsBetween(lo, hi)))
    )


def rolling_volatility(
    df: DataFrame, lo: int = FRAME_LO, hi: int = FRAME_HI, series: Series = KLINES, price: str = "close"
) -> DataFrame:
    """Sample standard deviation of the log return over rows ``lo..hi``; null below two values."""
    _check_frame(lo, hi)

    def add(rows: DataFrame, w: WindowSpec) -> DataFrame:
        returns = rows.withColumn("log_return", log_return_column(price, w))
        return returns.withColumn("volatility_24h", F.stddev_samp("log_return").over(w.rowsBetween(lo, hi)))

    return over_series(df, series, 1 - lo, add)


def window_features(
    df: DataFrame, lo: int = FRAME_LO, hi: int = FRAME_HI, series: Series = KLINES, price: str = "close"
) -> DataFrame:
    """All three features in one pass over the blocks."""
    _check_frame(lo, hi)

    def add(rows: DataFrame, w: WindowSpec) -> DataFrame:
        frame = w.rowsBetween(lo, hi)
        returns = rows.withColumn("log_return", log_return_column(price, w))
        return returns.withColumns(
            {"sma_24h": F.avg(price).over(frame), "volatility_24h": F.stddev_samp("log_return").over(frame)}
        )

    return over_series(df, series, 1 - lo, add)


def hourly_pivot(
    df: DataFrame, symbols: list[str] | None = None, time: str = "open_datetime", price: str = "close"
) -> DataFrame:
    """Mean price per date and hour, one column per symbol.

    Without ``symbols`` Spark runs an extra job that collects the distinct ones; with them other symbols have no column.
    """
    return (
        df.withColumn("hour", F.hour(time))
        .groupBy("partition_date", "hour")
        .pivot("symbol", sorted(symbols) if symbols is not None else None)
        .agg(F.avg(price))
    )
