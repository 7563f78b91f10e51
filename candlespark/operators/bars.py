"""Candles: open, high, low, close, volume and trade count per symbol and time window."""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlespark.functions.time import micros, unix_micros
from candlespark.operators.quantiles import join_on

_CANDLE_COLUMNS = ("symbol", "start_time", "end_time", "open", "high", "low", "close", "volume", "trade_count")


def _flatten(agg: DataFrame, symbol: str, size: int, extra=()) -> DataFrame:
    return agg.select(
        F.col(symbol).alias("symbol"),
        F.col("_start").alias("start_time"),
        F.timestamp_add("MICROSECOND", F.lit(size), "_start").alias("end_time"),
        *_CANDLE_COLUMNS[3:],
        *extra,
    )


def _with_start(df: DataFrame, ts: str, window: str, slide: str | None = None) -> DataFrame:
    """One row per window that ``ts`` falls into, with the window's ``_start``.

    Grouping by the start alone, a plain timestamp, sorts and hashes faster than by the window struct.
    """
    windows = df.withColumn("_window", F.window(ts, window, slide))
    return windows.withColumn("_start", F.col("_window.start")).drop("_window")


def ohlcv(
    trades: DataFrame,
    window: str = "1 minute",
    slide: str | None = None,
    *,
    ts: str = "timestamp",
    symbol: str = "symbol",
    price: str = "price",
    quantity: str = "quantity",
    tie: str | list[str] = "trade_id",
    sums: dict[str, Column] | None = None,
    dense: bool = True,
) -> DataFrame:
    """Tumbling (or, with ``slide``, sliding) candles.

    Open and close belong to the first and last trade by ``(ts, tie)``, so that neither arrival order
    nor shuffle order can change them.

    Batch input with one integral tie column goes through panes in one pass (see ``_paned``). With several tie columns, a
    tie that is no integer, or ids that are not ``dense`` (hashed, say), the extreme times are found first and ties only
    among the trades at them (see ``_staged``). Streams use one aggregation ordered by a struct. ``sums`` adds further
    summed columns by name.
    """
    sums = sums or {}
    ties = [tie] if isinstance(tie, str) else list(tie)
    columns = (ts, symbol, price, quantity)
    if trades.isStreaming:
        return _ordered(trades, window, slide, *columns, ties, sums)
    integral = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    if dense and len(ties) == 1 and isinstance(trades.schema[ties[0]].dataType, integral):
        return _paned(trades, window, slide, *columns, ties[0], sums)
    return _staged(trades, window, slide, *columns, ties, sums)


def _ordered(
    trades: DataFrame, window: str, slide: str | None, ts: str, symbol: str, price: str, quantity: str, ties: list[str], sums: dict[str, Column]
) -> DataFrame:
    """Candles in one aggregation, whose state is released by the window struct."""
    order = F.struct(F.col(ts), *[F.col(c) for c in ties])
    agg = trades.groupBy(F.window(ts, window, slide).alias("_window"), F.col(symbol)).agg(
        F.min_by(price, order).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, order).alias("close"),
        F.sum(quantity).alias("volume"),
        F.count(F.lit(1)).alias("trade_count"),
        *[F.sum(c).alias(name) for name, c in sums.items()],
    )
    return _flatten(agg.withColumn("_start", F.col("_window.start")), symbol, micros(window), sums)


def _staged(
    trades: DataFrame, window: str, slide: str | None, ts: str, symbol: str, price: str, quantity: str, ties: list[str], sums: dict[str, Column]
) -> DataFrame:
    """Candles in two looks at the trades: first the extreme times of each pane, then the ties at them.

    The first look has primitive buffers only, so it is a hash aggregation with map-side combine, whatever orders the ties.
    The second reads time, symbol, price and ties and keeps the trades at a pane's first or last time, which are few; only
    these are ordered by the ties. The planner broadcasts the panes or filters the trades by them before the shuffle.
    """
    size = micros(window)
    pane = gcd(size, micros(slide) if slide else size)
    names = [f"_tie{i}" for i in range(len(ties))]
    source = trades.select(
        F.window(ts, f"{pane} microseconds").getField("start").alias("_pane"),
        F.col(ts).alias("_ts"),
        F.col(symbol).alias("_symbol"),
        F.col(price).alias("_price"),
        F.col(quantity).alias("_quantity"),
        *[F.col(c).alias(name) for c, name in zip(ties, names)],
        *[c.alias(name) for name, c in sums.items()],
    )
    figures = {
        "_high": F.max("_price"), "_low": F.min("_price"), "_volume": F.sum("_quantity"), "_count": F.count(F.lit(1)),
        **{name: F.sum(name) for name in sums},
    }
    panes = source.groupBy("_pane", "_symbol").agg(
        F.min("_ts").alias("_first"), F.max("_ts").alias("_last"), *[c.alias(name) for name, c in figures.items()]
    )
    ends = join_on(source.select("_pane", "_symbol", "_ts", "_price", *names), panes, ["_pane", "_symbol"], "inner")
    at = {"first": F.col("_ts") == F.col("_first"), "last": F.col("_ts") == F.col("_last")}
    order = F.struct(*names)
    # A pane's figures are the same on all its rows.
    panes = ends.where(at["first"] | at["last"]).groupBy("_pane", "_symbol").agg(
        F.min_by("_price", F.when(at["first"], order)).alias("_open"),
        F.max_by("_price", F.when(at["last"], order)).alias("_close"),
        *[F.max(name).alias(name) for name in figures],
    )
    agg = _with_start(panes, "_pane", window, slide).groupBy("_start", "_symbol").agg(
        F.min_by("_open", "_pane").alias("open"),
        F.max("_high").alias("high"),
        F.min("_low").alias("low"),
        F.max_by("_close", "_pane").alias("close"),
        F.sum("_volume").alias("volume"),
        F.sum("_count").alias("trade_count"),
        *[F.sum(name).alias(name) for name in sums],
    )
    return _flatten(agg, "_symbol", size, sums)


def _paned(
    trades: DataFrame,
    window: str,
    slide: str | None,
    ts: str,
    symbol: str,
    price: str,
    quantity: str,
    tie: str,
    sums: dict[str, Column],
) -> DataFrame:
    """Candles in two steps: raw trades into non-overlapping panes, panes into windows.

    A struct-ordered ``min_by`` has a buffer that hash aggregation cannot update in place, so Spark
    would sort every raw trade by window and symbol in each map task. Here the pane step orders by one
    long: the time within the pane in the high bits, the low bits of the tie column below. The tie's
    remaining high bits are a grouping column, which makes the packed order exact for any tie value, and
    all buffers are primitive, so the pane step is a hash aggregation with map-side combine. The merge
    step sees panes only. Sliding windows gain once more: a trade enters one pane, and only panes are
    copied into the windows that overlap them.
    """
    size = micros(window)
    step = micros(slide) if slide else size
    pane = gcd(size, step)
    tie_bits = 63 - pane.bit_length()

    source = trades.select(
        F.window(ts, f"{pane} microseconds").getField("start").alias("_pane"),
        F.col(ts).alias("_ts"),
        F.col(symbol).alias("_symbol"),
        F.col(price).alias("_price"),
        F.col(quantity).alias("_quantity"),
        F.col(tie).cast("long").alias("_tie"),
        *[c.alias(name) for name, c in sums.items()],
    )
    offset = unix_micros(F.col("_ts")) - unix_micros(F.col("_pane"))
    tie_low = F.coalesce(F.col("_tie").bitwiseAND(F.lit((1 << tie_bits) - 1)), F.lit(0))
    packed = F.shiftleft(offset, tie_bits).bitwiseOR(tie_low)
    panes = source.groupBy("_pane", "_symbol", F.shiftright("_tie", tie_bits).alias("_tie_high")).agg(
        F.min_by("_price", packed).alias("_open"),
        F.max_by("_price", packed).alias("_close"),
        F.shiftright(F.min(packed), tie_bits).alias("_first"),
        F.shiftright(F.max(packed), tie_bits).alias("_last"),
        F.max("_price").alias("_high"),
        F.min("_price").alias("_low"),
        F.sum("_quantity").alias("_volume"),
        F.count(F.lit(1)).alias("_count"),
        *[F.sum(name).alias(name) for name in sums],
    )
    agg = _with_start(panes, "_pane", window, slide).groupBy("_start", "_symbol").agg(
        F.min_by("_open", F.struct("_pane", "_first", "_tie_high")).alias("open"),
        F.max("_high").alias("high"),
        F.min("_low").alias("low"),
        F.max_by("_close", F.struct("_pane", "_last", "_tie_high")).alias("close"),
        F.sum("_volume").alias("volume"),
        F.sum("_count").alias("trade_count"),
        *[F.sum(name).alias(name) for name in sums],
    )
    return _flatten(agg, "_symbol", size, sums)


def rollup(candles: DataFrame, window: str = "1 hour") -> DataFrame:
    """Coarser candles from finer non-overlapping ones (one candle per symbol and start time)."""
    agg = _with_start(candles, "start_time", window).groupBy("_start", "symbol").agg(
        F.min_by("open", "start_time").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "start_time").alias("close"),
        F.sum("volume").alias("volume"),
        F.sum("trade_count").alias("trade_count"),
    )
    return _flatten(agg, "symbol", micros(window))


def vwap(trades: DataFrame, window: str = "1 hour", ts: str = "timestamp") -> DataFrame:
    """Volume-weighted average price per bucket; null where nothing was traded."""
    agg = _with_start(trades, ts, window).groupBy("_start", "symbol").agg(
        F.try_divide(F.sum(F.col("price") * F.col("quantity")), F.sum("quantity")).alias("vwap")
    )
    return agg.select("symbol", F.col("_start").alias("start_time"), "vwap")


def taker_buy_quantity() -> Column:
    """Quantity of a trade whose buyer was the taker (the buyer is not the maker), else zero."""
    return F.when(~F.col("is_buyer_maker"), F.col("quantity")).otherwise(F.lit(0.0))
