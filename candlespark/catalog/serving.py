"""Serving queries, validation and movers."""

from __future__ import annotations

from candlespark.catalog import bindings as b
from candlespark.catalog.registry import CANDLE_COLUMNS, KLINES, TRADES, candles, query, r6, sliding
from candlespark.catalog.windows import full_frame, rsi_ctes
from candlespark.operators import indicators, quality, serve, stats
from candlespark.sources import lake

_C = f"{TRADES}, {candles()}"
_W = "PARTITION BY symbol ORDER BY start_time"


def _candles(spark, folder):
    return b.hourly_candles(spark, folder)


@query("candles_for_symbol", f"WITH {_C} SELECT {CANDLE_COLUMNS} FROM candles WHERE symbol = 'click'")
def candles_for_symbol(spark, folder):
    """The keyed read: the symbol test reaches the scan."""
    return lake.candles_for_symbol(_candles(spark, folder), "click")


@query(
    "candles_page",
    f"WITH {_C} SELECT {CANDLE_COLUMNS} FROM candles QUALIFY row_number() OVER ({_W}) <= 200",
)
def candles_page(spark, folder):
    return serve.candles_page(_candles(spark, folder))


@query(
    "latest_candles",
    f"WITH {_C} SELECT {CANDLE_COLUMNS} FROM candles QUALIFY row_number() OVER ({_W} DESC) <= 200",
)
def latest_candles(spark, folder):
    return serve.latest_candles(_candles(spark, folder))


@query(
    "candles_api_shape",
    f"""WITH {_C}
SELECT symbol, strftime(start_time, '%Y-%m-%dT%H:%M:%S') AS "time", open, high, low, close, volume FROM candles""",
)
def candles_api_shape(spark, folder):
    return serve.api_shape(_candles(spark, folder))


@query(
    "sliding_with_indicators",
    f"""WITH {TRADES}, {sliding("bars")},
candles AS (SELECT * FROM bars QUALIFY row_number() OVER ({_W}) <= 250),
{rsi_ctes("candles")},
bands AS (SELECT *, {full_frame("avg", 7)} AS s7, {full_frame("avg", 20)} AS m,
                 {full_frame("stddev_samp", 20)} AS d FROM rsi),
page AS (SELECT * FROM bands QUALIFY row_number() OVER ({_W} DESC) <= 200)
SELECT symbol, strftime(start_time, '%Y-%m-%dT%H:%M:%S') AS start_time, end_time, open, high, low, close, volume,
       trade_count, {r6("s7")} AS sma_7, {r6("m")} AS bb_middle, {r6("m + 2 * d")} AS bb_upper,
       {r6("m - 2 * d")} AS bb_lower, {r6("rsi_value")} AS rsi FROM page""",
)
def sliding_with_indicators(spark, folder):
    page = serve.sliding_with_indicators(b.sliding_candles(spark, folder))
    return b.rounded(page, "sma_7", "bb_middle", "bb_upper", "bb_lower", "rsi")


@query("symbols", f"WITH {_C} SELECT DISTINCT symbol FROM candles")
def symbols(spark, folder):
    return serve.symbols(b.trades(spark, folder))


@query(
    "latest_price",
    f"WITH {_C} SELECT symbol, max(start_time) AS start_time, arg_max(close, start_time) AS close FROM candles GROUP BY symbol",
)
def latest_price(spark, folder):
    return serve.latest_price(_candles(spark, folder))


@query("price_history", f"WITH {_C} SELECT symbol, start_time, close FROM candles")
def price_history(spark, folder):
    return serve.price_history(_candles(spark, folder))


@query(
    "price_alerts",
    f"""WITH {_C}, p AS (SELECT symbol, start_time, close, lag(close) OVER ({_W}) AS previous FROM candles)
SELECT symbol, start_time, close, previous, CASE WHEN previous < 50 THEN 'up' ELSE 'down' END AS direction FROM p
WHERE (previous < 50 AND close >= 50) OR (previous >= 50 AND close < 50)""",
)
def price_alerts(spark, folder):
    return indicators.price_alerts(b.stored_candles(spark, folder).select("symbol", "start_time", "close"), 50.0)


# The checks run on the candles and on spoilt copies of them, so that every rule counts something.
_SPOILT = f"""{_C}, c AS (SELECT symbol, start_time, open, high, low, close FROM candles),
all_rows AS (SELECT * FROM c UNION ALL SELECT symbol, start_time, open, low, high, -close FROM c
             UNION ALL SELECT symbol, start_time, open, high, low, NULL FROM c)"""


@query(
    "validate_candles",
    f"""WITH {_SPOILT}
SELECT count(*) AS "rows",
       count(*) FILTER (WHERE open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL) AS null_price,
       count(*) FILTER (WHERE least(open, high, low, close) < 0) AS negative_price,
       count(*) FILTER (WHERE high < low) AS high_below_low,
       count(*) FILTER (WHERE open < low OR open > high) AS open_outside,
       count(*) FILTER (WHERE close < low OR close > high) AS close_outside,
       count(*) - (SELECT count(*) FROM c) AS duplicate_key
FROM all_rows""",
)
def validate_candles(spark, folder):
    c = _candles(spark, folder).select("symbol", "start_time", "open", "high", "low", "close")
    crossed = c.selectExpr("symbol", "start_time", "open", "low AS high", "high AS low", "-close AS close")
    missing = c.selectExpr("symbol", "start_time", "open", "high", "low", "CAST(NULL AS DOUBLE) AS close")
    return quality.validate_candles(c.unionByName(crossed).unionByName(missing))


@query(
    "candle_gaps",
    f"""WITH {_C}, p AS (SELECT symbol, start_time, lag(start_time) OVER ({_W}) AS previous FROM candles)
SELECT symbol, start_time, (epoch_us(start_time) - epoch_us(previous)) // 3600000000 - 1 AS missing_bars
FROM p WHERE start_time - previous > INTERVAL '1 hour'""",
)
def candle_gaps(spark, folder):
    return quality.candle_gaps(b.stored_candles(spark, folder), "1 hour")


@query(
    "retention_keep",
    f"""WITH {KLINES}
SELECT symbol, open_datetime, partition_date, close FROM klines
WHERE partition_date >= (SELECT max(partition_date) - 7 FROM klines)""",
)
def retention_keep(spark, folder):
    klines = b.hourly_klines(spark, folder).select("symbol", "open_datetime", "partition_date", "close")
    return quality.retention_keep(klines, 7)


_DAYS = f"""{_C}, d AS (
  SELECT symbol, CAST(start_time AS DATE) AS date, arg_min(open, start_time) AS first_open,
         arg_max(close, start_time) AS last_close FROM candles GROUP BY 1, 2),
change AS (SELECT *, CASE WHEN first_open <> 0 THEN (last_close / first_open - 1) * 100 END AS pct FROM d)"""


@query(
    "market_heatmap",
    f"""WITH {_DAYS}
SELECT symbol, date, first_open, last_close, {r6("pct")} AS change_pct,
       CAST(row_number() OVER (PARTITION BY date ORDER BY pct DESC NULLS LAST, symbol) AS INTEGER) AS rank FROM change""",
)
def market_heatmap(spark, folder):
    return b.rounded(stats.market_heatmap(_candles(spark, folder)), "change_pct")


@query(
    "top_movers",
    f"""WITH {_DAYS}, r AS (
  SELECT *, row_number() OVER (PARTITION BY date ORDER BY pct DESC, symbol) AS g,
         row_number() OVER (PARTITION BY date ORDER BY pct, symbol) AS l FROM change WHERE pct IS NOT NULL)
SELECT symbol, date, first_open, last_close, {r6("pct")} AS change_pct, CAST(g AS INTEGER) AS rank, 'gain' AS side
FROM r WHERE g <= 3
UNION ALL
SELECT symbol, date, first_open, last_close, {r6("pct")}, CAST(l AS INTEGER), 'loss' FROM r WHERE l <= 3""",
)
def top_movers(spark, folder):
    return b.rounded(stats.top_movers(_candles(spark, folder)), "change_pct")
