"""Query registry and the SQL fragments the queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from candlespark.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function ``(spark, folder) -> DataFrame`` under ``name``."""

    def register(build):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(configure(spark), folder)

        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return build

    return register


# Sums of doubles differ in their last bits with the order of addition. Six digits hide that, except where
# the exact value ends in a 5 at the seventh digit; a small shift moves such values off the edge.
NUDGE = 1e-8


def r6(expression: str) -> str:
    """Rounded to six digits, without a negative zero; ``bindings.rounded`` does the same in Spark."""
    value = f"round(({expression}) + CAST({NUDGE} AS DOUBLE), 6)"
    return f"CASE WHEN {value} = 0 THEN CAST(0 AS DOUBLE) ELSE {value} END"


def safe_ln(x: str) -> str:
    return f"CASE WHEN {x} > 0 THEN ln({x}) END"


TRADES = """trades AS (
  SELECT event_type AS symbol, event_id AS trade_id, ts AS "timestamp", value AS price,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS quantity, user_id % 2 = 0 AS is_buyer_maker
  FROM events)"""


def candles(name: str = "candles", size: str = "1 hour", source: str = "trades") -> str:
    bucket = f"""time_bucket(INTERVAL '{size}', "timestamp")"""
    return f"""{name} AS (
  SELECT symbol, {bucket} AS start_time, {bucket} + INTERVAL '{size}' AS end_time,
         arg_min(price, ("timestamp", trade_id)) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, ("timestamp", trade_id)) AS close, sum(quantity) AS volume, count(*) AS trade_count,
         sum(price * quantity) AS quote_asset_volume,
         sum(CASE WHEN is_buyer_maker THEN 0 ELSE quantity END) AS taker_buy_volume,
         sum(CASE WHEN is_buyer_maker THEN 0 ELSE price * quantity END) AS taker_buy_quote
  FROM {source} GROUP BY ALL)"""


def sliding(name: str = "candles", size: str = "1 hour", slide: str = "30 minutes") -> str:
    """Sliding candles whose window is twice the slide: every trade lies in two windows."""
    return f"""doubled AS (
  SELECT *, unnest([time_bucket(INTERVAL '{slide}', "timestamp"),
                    time_bucket(INTERVAL '{slide}', "timestamp") - INTERVAL '{slide}']) AS start_time FROM trades),
{name} AS (
  SELECT symbol, start_time, start_time + INTERVAL '{size}' AS end_time,
         arg_min(price, ("timestamp", trade_id)) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, ("timestamp", trade_id)) AS close, sum(quantity) AS volume, count(*) AS trade_count
  FROM doubled GROUP BY symbol, start_time)"""


KLINES = f"""{TRADES},
{candles()},
klines AS (
  SELECT symbol, start_time AS open_datetime, CAST(start_time AS DATE) AS partition_date,
         epoch_us(start_time) * 1000 AS open_time, open, high, low, close, volume, quote_asset_volume,
         trade_count AS number_of_trades, taker_buy_volume AS taker_buy_base_asset_volume,
         taker_buy_quote AS taker_buy_quote_asset_volume
  FROM candles)"""

CANDLE_COLUMNS = "symbol, start_time, end_time, open, high, low, close, volume, trade_count"
