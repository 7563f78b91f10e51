"""Candles, roll-ups, volume-weighted prices, pivots and daily statistics."""

from __future__ import annotations

from candlespark.catalog import bindings as b
from candlespark.catalog.registry import CANDLE_COLUMNS, KLINES, TRADES, candles, query, r6, sliding
from candlespark.operators import bars, features, stats


@query("ohlcv_tumbling", f"WITH {TRADES}, {candles()} SELECT {CANDLE_COLUMNS} FROM candles")
def ohlcv_tumbling(spark, folder):
    return b.hourly_candles(spark, folder)


@query("ohlcv_sliding", f"WITH {TRADES}, {sliding()} SELECT {CANDLE_COLUMNS} FROM candles")
def ohlcv_sliding(spark, folder):
    return b.sliding_candles(spark, folder)


@query("ohlcv_tumbling_minute", f"WITH {TRADES}, {candles(size='1 minute')} SELECT {CANDLE_COLUMNS} FROM candles")
def ohlcv_tumbling_minute(spark, folder):
    return bars.ohlcv(b.trades(spark, folder), "1 minute")


@query(
    "ohlcv_sliding_minute",
    f"WITH {TRADES}, {sliding(size='1 minute', slide='30 seconds')} SELECT {CANDLE_COLUMNS} FROM candles",
)
def ohlcv_sliding_minute(spark, folder):
    return bars.ohlcv(b.trades(spark, folder), "1 minute", "30 seconds")


_WIDE = """trades AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS symbol, l_orderkey, l_linenumber, l_shipdate AS "timestamp",
         l_extendedprice / l_quantity AS price, l_quantity AS quantity FROM lineitem)"""


@query(
    "ohlcv_daily_wide",
    f"""WITH {_WIDE}
SELECT symbol, time_bucket(INTERVAL '1 day', "timestamp") AS start_time,
       time_bucket(INTERVAL '1 day', "timestamp") + INTERVAL '1 day' AS end_time,
       arg_min(price, ("timestamp", l_orderkey, l_linenumber, price)) AS open, max(price) AS high, min(price) AS low,
       arg_max(price, ("timestamp", l_orderkey, l_linenumber, price)) AS close, sum(quantity) AS volume,
       count(*) AS trade_count FROM trades GROUP BY symbol, time_bucket(INTERVAL '1 day', "timestamp")""",
)
def ohlcv_daily_wide(spark, folder):
    """Many symbols; an order and line number may repeat, so the price is the last tie-break."""
    return bars.ohlcv(b.wide_trades(spark, folder), "1 day", tie=["trade_id", "line", "price"])


@query(
    "candle_rollup",
    f"""WITH {TRADES}, {candles()}
SELECT symbol, time_bucket(INTERVAL '1 day', start_time) AS start_time,
       time_bucket(INTERVAL '1 day', start_time) + INTERVAL '1 day' AS end_time, arg_min(open, start_time) AS open,
       max(high) AS high, min(low) AS low, arg_max(close, start_time) AS close, sum(volume) AS volume,
       CAST(sum(trade_count) AS BIGINT) AS trade_count
FROM candles GROUP BY symbol, time_bucket(INTERVAL '1 day', start_time)""",
)
def candle_rollup(spark, folder):
    return bars.rollup(b.hourly_candles(spark, folder), "1 day")


@query(
    "vwap",
    f"""WITH {TRADES}
SELECT symbol, time_bucket(INTERVAL '1 hour', "timestamp") AS start_time,
       CASE WHEN sum(quantity) <> 0 THEN {r6("sum(price * quantity) / sum(quantity)")} END AS vwap
FROM trades GROUP BY symbol, time_bucket(INTERVAL '1 hour', "timestamp")""",
)
def vwap(spark, folder):
    return b.rounded(bars.vwap(b.trades(spark, folder), "1 hour"), "vwap")


_PIVOT = ", ".join(r6(f"avg(close) FILTER (WHERE symbol = '{s}')") + f" AS {s}" for s in b.EVENT_SYMBOLS)


@query(
    "hourly_pivot",
    f"""WITH {KLINES}
SELECT partition_date, CAST(hour(open_datetime) AS INTEGER) AS hour, {_PIVOT} FROM klines GROUP BY 1, 2""",
)
def hourly_pivot(spark, folder):
    return b.rounded(features.hourly_pivot(b.hourly_klines(spark, folder), list(b.EVENT_SYMBOLS)), *b.EVENT_SYMBOLS)


@query(
    "daily_stats",
    f"""WITH {TRADES}
SELECT symbol, CAST("timestamp" AS DATE) AS date, count(price) AS n, {r6("avg(price)")} AS mean,
       {r6("stddev_samp(price)")} AS stddev, min(price) AS min, max(price) AS max,
       {r6("quantile_cont(price, 0.05)")} AS p05, {r6("quantile_cont(price, 0.5)")} AS p50,
       {r6("quantile_cont(price, 0.95)")} AS p95
FROM trades GROUP BY 1, 2""",
)
def daily_stats(spark, folder):
    return b.rounded(stats.daily_stats(b.trades(spark, folder)), "mean", "stddev", "p05", "p50", "p95")
