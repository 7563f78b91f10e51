"""Windowed features, indicators, joins and risk figures."""

from __future__ import annotations


from pyspark.sql import functions as F

from candlespark.catalog import bindings as b
from candlespark.catalog.registry import KLINES, NUDGE, TRADES, candles, query, r6, safe_ln
from candlespark.operators import enrich, features, indicators, stats
from candlespark.operators.bars import ohlcv, taker_buy_quantity
from candlespark.operators.blocks import CANDLES, Series
from candlespark.plans import klines as kline_plans
from candlespark.plans.prediction import next_bar_prediction as predict
from candlespark.plans.prediction import walk_forward
from candlespark.session import materialize

_K = "symbol, open_datetime, close"
_RETURN = f"{safe_ln('close')} - {safe_ln('lag(close) OVER w')}"
_RETURNS = f"""{KLINES}, returns AS (
  SELECT *, {_RETURN} AS log_return FROM klines WINDOW w AS (PARTITION BY symbol ORDER BY open_datetime)),
features AS (
  SELECT *, avg(close) OVER f AS sma_24h, stddev_samp(log_return) OVER f AS volatility_24h FROM returns
  WINDOW f AS (PARTITION BY symbol ORDER BY open_datetime ROWS BETWEEN 24 PRECEDING AND CURRENT ROW))"""


def _klines(spark, folder):
    return b.stored_klines(spark, folder)


@query("log_return", f"WITH {_RETURNS} SELECT {_K}, {r6('log_return')} AS log_return FROM returns")
def log_return(spark, folder):
    df = features.log_return(_klines(spark, folder).select("symbol", "open_datetime", "close"))
    return b.rounded(df, "log_return")


@query("sma_rows", f"WITH {_RETURNS} SELECT {_K}, {r6('sma_24h')} AS sma_24h FROM features")
def sma_rows(spark, folder):
    df = features.sma_rows(_klines(spark, folder).select("symbol", "open_datetime", "close"))
    return b.rounded(df, "sma_24h")


@query(
    "rolling_volatility",
    f"""WITH {_RETURNS}
SELECT {_K}, {r6('log_return')} AS log_return, {r6('volatility_24h')} AS volatility_24h FROM features""",
)
def rolling_volatility(spark, folder):
    df = features.rolling_volatility(_klines(spark, folder).select("symbol", "open_datetime", "close"))
    return b.rounded(df, "log_return", "volatility_24h")


_META = """metadata AS (SELECT * FROM (VALUES ('click', 'Bitcoin', 'PoW'), ('purchase', 'Ethereum', 'PoS'),
  ('view', 'Solana', 'PoS')) AS v(symbol, coin_name, consensus))"""
_SENT = """sentiment AS (SELECT * FROM (VALUES (DATE '2024-01-01', 'click', CAST(0.35 AS DOUBLE)),
  (DATE '2024-01-01', 'purchase', 0.21), (DATE '2024-01-02', 'view', -0.1))
  AS v(partition_date, symbol, sentiment_score))"""
_BASE = "symbol, open_datetime, partition_date, open, high, low, close, volume, number_of_trades"


def _base(spark, folder):
    return _klines(spark, folder).select(*[c.strip() for c in _BASE.split(",")])


@query(
    "join_metadata",
    f"WITH {KLINES}, {_META} SELECT {_BASE}, coin_name, consensus FROM klines LEFT JOIN metadata USING (symbol)",
)
def join_metadata(spark, folder):
    return enrich.join_metadata(_base(spark, folder), b.event_metadata(spark))


@query(
    "join_sentiment",
    f"""WITH {KLINES}, {_SENT}
SELECT {_BASE}, sentiment_score FROM klines LEFT JOIN sentiment USING (partition_date, symbol)""",
)
def join_sentiment(spark, folder):
    return enrich.join_sentiment(_base(spark, folder), b.event_sentiment(spark), strategy="merge")


@query(
    "join_daily_average",
    f"""WITH daily AS (
  SELECT CAST(o_orderdate AS DATE) AS partition_date, o_orderpriority AS symbol, avg(o_totalprice) AS sentiment_score
  FROM orders GROUP BY 1, 2)
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS partition_date, o_orderpriority AS symbol, o_totalprice,
       {r6("sentiment_score")} AS sentiment_score
FROM orders LEFT JOIN daily ON CAST(o_orderdate AS DATE) = daily.partition_date AND o_orderpriority = daily.symbol""",
)
def join_daily_average(spark, folder):
    """The date and symbol join with a large right side: every order against its day's average."""
    orders = b.table(spark, folder, "orders").select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("partition_date"),
        F.col("o_orderpriority").alias("symbol"),
        "o_totalprice",
    )
    daily = orders.groupBy("partition_date", "symbol").agg(F.avg("o_totalprice").alias("sentiment_score"))
    return b.rounded(enrich.join_sentiment(orders, daily), "sentiment_score")


@query(
    "feature_enriched",
    f"""WITH {_RETURNS}, {_META}, {_SENT}
SELECT {_BASE}, {r6('log_return')} AS log_return, {r6('sma_24h')} AS sma_24h,
       {r6('volatility_24h')} AS volatility_24h, coin_name, consensus, sentiment_score
FROM features LEFT JOIN metadata USING (symbol) LEFT JOIN sentiment USING (partition_date, symbol)
WHERE partition_date >= DATE '2024-01-01'""",
)
def feature_enriched(spark, folder):
    rows = kline_plans.feature_rows(_base(spark, folder), b.event_metadata(spark), b.event_sentiment(spark))
    return b.rounded(rows, "log_return", "sma_24h", "volatility_24h")


# --- indicators over hourly candles ------------------------------------------------------------------

_C = f"{TRADES}, {candles()}"
_KEY = "symbol, start_time, close"
_W = "PARTITION BY symbol ORDER BY start_time"


def _candles(spark, folder):
    return b.stored_candles(spark, folder)


def _closes(spark, folder):
    return _candles(spark, folder).select("symbol", "start_time", "close")


def full_frame(agg: str, n: int, value: str = "close") -> str:
    frame = f"OVER ({_W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({value}) {frame} = {n} THEN {agg}({value}) {frame} END"


@query("sma_7", f"WITH {_C}, s AS (SELECT *, {full_frame('avg', 7)} AS x FROM candles) SELECT {_KEY}, {r6('x')} AS sma_7 FROM s")
def sma_7(spark, folder):
    return b.rounded(indicators.sma(_closes(spark, folder), 7), "sma_7")


@query(
    "bollinger",
    f"""WITH {_C}, s AS (SELECT *, {full_frame('avg', 20)} AS m, {full_frame('stddev_samp', 20)} AS d FROM candles)
SELECT {_KEY}, {r6('m')} AS bb_middle, {r6('m + 2 * d')} AS bb_upper, {r6('m - 2 * d')} AS bb_lower FROM s""",
)
def bollinger(spark, folder):
    return b.rounded(indicators.bollinger(_closes(spark, folder)), "bb_middle", "bb_upper", "bb_lower")


def rsi_ctes(source: str) -> str:
    frame = f"OVER ({_W} ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)"
    return f"""changes AS (SELECT *, close - lag(close) OVER ({_W}) AS change FROM {source}),
moves AS (SELECT *, CASE WHEN change > 0 THEN change ELSE 0 END AS gain,
                 CASE WHEN change < 0 THEN -change ELSE 0 END AS loss FROM changes),
means AS (SELECT *, count(gain) {frame} AS n, avg(gain) {frame} AS ag, avg(loss) {frame} AS al,
                 max(gain) {frame} AS mg, max(loss) {frame} AS ml FROM moves),
rsi AS (SELECT *, CASE WHEN n < 14 OR (mg = 0 AND ml = 0) THEN NULL WHEN ml = 0 THEN 100
                       ELSE 100 - 100 / (1 + ag / al) END AS rsi_value FROM means)"""


@query("rsi_14", f"WITH {_C}, {rsi_ctes('candles')} SELECT {_KEY}, {r6('rsi_value')} AS rsi FROM rsi")
def rsi_14(spark, folder):
    return b.rounded(indicators.rsi(_closes(spark, folder)), "rsi")


@query(
    "macd",
    f"""WITH RECURSIVE {_C},
s AS (SELECT symbol, start_time, close, row_number() OVER ({_W}) AS i FROM candles),
e AS (
  SELECT symbol, start_time, close, i, close AS f, close AS g, CAST(0 AS DOUBLE) AS sig FROM s WHERE i = 1
  UNION ALL
  SELECT s.symbol, s.start_time, s.close, s.i, s.close * (2 / 13) + e.f * (11 / 13),
         s.close * (2 / 27) + e.g * (25 / 27),
         ((s.close * (2 / 13) + e.f * (11 / 13)) - (s.close * (2 / 27) + e.g * (25 / 27))) * 0.2::DOUBLE
           + e.sig * 0.8::DOUBLE
  FROM e JOIN s ON s.symbol = e.symbol AND s.i = e.i + 1)
SELECT {_KEY}, {r6('f')} AS ema_fast, {r6('g')} AS ema_slow, {r6('f - g')} AS macd, {r6('sig')} AS macd_signal,
       {r6('f - g - sig')} AS macd_hist FROM e""",
)
def macd(spark, folder):
    names = ("ema_fast", "ema_slow", "macd", "macd_signal", "macd_hist")
    return b.rounded(indicators.macd(_closes(spark, folder)), *names)


@query(
    "trend",
    f"""WITH {_C},
s AS (SELECT *, row_number() OVER ({_W}) AS i, {full_frame('avg', 7)} AS fast, {full_frame('avg', 20)} AS slow FROM candles),
t AS (SELECT *, CAST(CASE WHEN abs(fast - slow) <= 1e-12 * greatest(abs(fast), abs(slow)) THEN 0 ELSE sign(fast - slow) END AS INTEGER) AS state FROM s),
u AS (SELECT *, state <> lag(state) OVER ({_W}) AS crossed, count(close) OVER f AS n, regr_slope(close, i) OVER f AS x
      FROM t WINDOW f AS ({_W} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))
SELECT {_KEY}, state, crossed AS "cross", CASE WHEN n >= 2 THEN {r6('x')} END AS slope FROM u""",
)
def trend(spark, folder):
    return b.rounded(indicators.trend(_closes(spark, folder)), "slope")


@query(
    "return_anomalies",
    f"""WITH {_C},
r AS (SELECT *, {_RETURN} AS r FROM candles WINDOW w AS ({_W})),
m AS (SELECT *, count(r) OVER f AS n, avg(r) OVER f AS m, stddev_samp(r) OVER f AS d FROM r
      WINDOW f AS ({_W} ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)),
z AS (SELECT *, CASE WHEN n >= 24 AND d > 0 THEN (r - m) / d END AS z FROM m)
SELECT {_KEY}, {r6('r')} AS log_return, {r6('z')} AS z_score, abs(z) > 3 AS is_anomaly FROM z""",
)
def return_anomalies(spark, folder):
    return b.rounded(indicators.return_anomalies(_closes(spark, folder)), "log_return", "z_score")


_OHLC = ["symbol", "start_time", "open", "high", "low", "close"]


@query(
    "candle_patterns",
    f"""WITH {_C},
p AS (SELECT *, lag(open) OVER w AS po, lag(close) OVER w AS pc, abs(close - open) AS body, high - low AS span,
             least(open, close) - low AS lower, high - greatest(open, close) AS upper FROM candles WINDOW w AS ({_W}))
SELECT symbol, start_time, open, high, low, close,
       coalesce(body <= CAST(0.1 AS DOUBLE) * span AND span > 0, false) AS doji,
       coalesce(lower >= 2 * body AND upper <= body AND body > 0, false) AS hammer,
       coalesce(pc < po AND close > open AND open <= pc AND close >= po, false) AS bullish_engulfing,
       coalesce(pc > po AND close < open AND open >= pc AND close <= po, false) AS bearish_engulfing FROM p""",
)
def candle_patterns(spark, folder):
    return indicators.candle_patterns(_candles(spark, folder).select(*_OHLC))


@query(
    "volume_analysis",
    f"""WITH {_C}
SELECT symbol, start_time, volume,
       CASE WHEN avg(volume) OVER f <> 0 THEN {r6("volume / avg(volume) OVER f")} END AS volume_ratio,
       CASE WHEN volume <> 0 THEN {r6("taker_buy_volume / volume")} END AS taker_buy_share
FROM candles WINDOW f AS ({_W} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)""",
)
def volume_analysis(spark, folder):
    bars = b.stored_candles(spark, folder, {"taker_buy_volume": taker_buy_quantity()})
    df = indicators.volume_analysis(bars.select("symbol", "start_time", "volume", "taker_buy_volume"))
    return b.rounded(df, "volume_ratio", "taker_buy_share").drop("taker_buy_volume")


@query(
    "risk_metrics",
    f"""WITH {_C},
r AS (SELECT symbol, close / max(close) OVER (w ROWS UNBOUNDED PRECEDING) - 1 AS dd, {_RETURN} AS r
      FROM candles WINDOW w AS ({_W}))
SELECT symbol, {r6('min(dd)')} AS max_drawdown, {r6('stddev_samp(r)')} AS volatility,
       {r6('quantile_cont(r, 0.05)')} AS var_5 FROM r GROUP BY symbol""",
)
def risk_metrics(spark, folder):
    return b.rounded(stats.risk_metrics(_closes(spark, folder)), "max_drawdown", "volatility", "var_5")


_LR = f"{_C}, r AS (SELECT symbol, start_time, {_RETURN} AS r FROM candles WINDOW w AS ({_W}))"


@query(
    "return_correlation",
    f"""WITH {_LR}
SELECT a.symbol AS symbol_a, b.symbol AS symbol_b, count(*) AS common_bars, {r6('corr(a.r, b.r)')} AS correlation
FROM r a JOIN r b ON a.start_time = b.start_time AND a.symbol < b.symbol
WHERE a.r IS NOT NULL AND b.r IS NOT NULL GROUP BY 1, 2""",
)
def return_correlation(spark, folder):
    returns = features.log_return(_closes(spark, folder), CANDLES)
    return b.rounded(stats.return_correlation(returns), "correlation")


_PRICES = """p AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS symbol, l_shipdate AS start_time, max(l_extendedprice / l_quantity) AS price
  FROM lineitem GROUP BY 1, 2)"""


@query(
    "sparse_correlation",
    f"""WITH {_PRICES}
SELECT a.symbol AS symbol_a, b.symbol AS symbol_b, count(*) AS common_bars,
       CASE WHEN stddev_pop(a.price) > 0 AND stddev_pop(b.price) > 0 THEN {r6('corr(a.price, b.price)')} END AS correlation
FROM p a JOIN p b ON a.start_time = b.start_time AND a.symbol < b.symbol GROUP BY 1, 2""",
)
def sparse_correlation(spark, folder):
    """Correlation of prices for all pairs of many symbols that share few days, about a year to a stretch."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    prices = lines.groupBy("l_suppkey", F.col("l_shipdate").alias("start_time")).agg(
        F.max(F.col("l_extendedprice") / F.col("l_quantity")).alias("price")
    )
    prices = prices.select(F.col("l_suppkey").cast("string").alias("symbol"), "start_time", "price")
    # Rounded where the pairs are made: over 18,000 symbols rounding behind them took about a third of the CPU time.
    return stats.return_correlation(prices, value="price", stretch="365 days", digits=6, shift=NUDGE)


@query(
    "portfolio_return",
    f"""WITH {_LR}
SELECT start_time, {r6('avg(r)')} AS portfolio_return, count(r) AS symbols FROM r GROUP BY start_time""",
)
def portfolio_return(spark, folder):
    returns = features.log_return(_closes(spark, folder), CANDLES)
    return b.rounded(stats.portfolio_return(returns), "portfolio_return")


@query("next_bar_prediction")
def next_bar_prediction(spark, folder):
    """Fitted from Gram sums over all candles; compared with a direct solution in the tests, and for one lag with SQL."""
    return predict(_candles(spark, folder))


_LAGGED = f"""{_LR}, x AS (SELECT *, lag(r) OVER (PARTITION BY symbol ORDER BY start_time) AS lag_1 FROM r),
p AS (SELECT *, epoch_us(start_time) AS us FROM x WHERE r IS NOT NULL AND lag_1 IS NOT NULL)"""


@query(
    "one_lag_prediction",
    f"""WITH {_LAGGED},
s AS (SELECT *, us <= min(us) OVER () + CAST(floor((max(us) OVER () - min(us) OVER ()) * 0.8::DOUBLE) AS BIGINT) AS train FROM p),
f AS (SELECT regr_intercept(r, lag_1) AS intercept, regr_slope(r, lag_1) AS lag_1 FROM s WHERE train)
SELECT {r6('f.intercept')} AS intercept, {r6('f.lag_1')} AS lag_1, {r6('sqrt(avg((r - f.intercept - f.lag_1 * s.lag_1) ** 2))')} AS rmse
FROM s, f WHERE NOT train GROUP BY f.intercept, f.lag_1""",
)
def one_lag_prediction(spark, folder):
    return b.rounded(predict(_candles(spark, folder), lags=1), "intercept", "lag_1", "rmse")


@query(
    "walk_forward_prediction",
    f"""WITH {_LAGGED}, d AS (SELECT *, us // 86400000000 AS part FROM p),
f AS (
  SELECT t.part, regr_intercept(d.r, d.lag_1) AS intercept, regr_slope(d.r, d.lag_1) AS lag_1, count(*) AS n_train
  FROM (SELECT DISTINCT part FROM d) t JOIN d ON d.part < t.part GROUP BY t.part HAVING count(*) >= 4)
SELECT part, n_train, count(*) AS n, {r6('f.intercept')} AS intercept, {r6('f.lag_1')} AS lag_1,
  {r6('sqrt(avg((r - f.intercept - f.lag_1 * d.lag_1) ** 2))')} AS rmse
FROM d JOIN f USING (part) GROUP BY part, n_train, f.intercept, f.lag_1""",
)
def walk_forward_prediction(spark, folder):
    """Every day predicted from all days before it, with one lag."""
    return b.rounded(walk_forward(_candles(spark, folder), lags=1), "intercept", "lag_1", "rmse")


_WIDE_DAYS = """wide AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS symbol, l_shipdate AS start_time,
         arg_max(l_extendedprice / l_quantity, (l_orderkey, l_linenumber, l_extendedprice / l_quantity)) AS close
  FROM lineitem GROUP BY 1, 2)"""


@query(
    "features_wide",
    f"""WITH {_WIDE_DAYS}, r AS (SELECT *, {_RETURN} AS lr FROM wide WINDOW w AS ({_W}))
SELECT {_KEY}, {r6('lr')} AS log_return, {r6('avg(close) OVER f')} AS sma_24h,
       {r6('stddev_samp(lr) OVER f')} AS volatility_24h
FROM r WINDOW f AS ({_W} ROWS BETWEEN 24 PRECEDING AND CURRENT ROW)""",
)
def features_wide(spark, folder):
    """Windowed features over daily bars of many symbols; a year is numbered at a time."""
    bars = ohlcv(b.wide_trades(spark, folder), "1 day", tie=["trade_id", "line", "price"])
    bars = materialize(bars.select("symbol", "start_time", "close"), "bars")
    df = features.window_features(bars, series=Series(chunk="365 days"))
    return b.rounded(df, "log_return", "sma_24h", "volatility_24h")


