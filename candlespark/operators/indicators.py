"""Technical indicators over candles."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlespark.operators.blocks import CANDLES, ROW_INDEX, Series, over_series, own_rows, spread_blocks
from candlespark.operators.features import log_return_column
from candlespark.session import materialize


def _full_frame(value: str, n: int, w: WindowSpec, agg) -> Column:
    """``agg`` over the last ``n`` rows; null until the frame holds ``n`` non-null values."""
    frame = w.rowsBetween(1 - n, 0)
    return F.when(F.count(value).over(frame) == n, agg(value).over(frame))


def _add_sma(rows: DataFrame, w: WindowSpec, n: int, price: str) -> DataFrame:
    return rows.withColumn(f"sma_{n}", _full_frame(price, n, w, F.avg))


def _add_bollinger(rows: DataFrame, w: WindowSpec, n: int, k: float, price: str) -> DataFrame:
    rows = rows.withColumns(
        {"bb_middle": _full_frame(price, n, w, F.avg), "_std": _full_frame(price, n, w, F.stddev_samp)}
    )
    return rows.withColumns(
        {
            "bb_upper": F.col("bb_middle") + k * F.col("_std"),
            "bb_lower": F.col("bb_middle") - k * F.col("_std"),
        }
    ).drop("_std")


def _add_rsi(rows: DataFrame, w: WindowSpec, n: int, price: str) -> DataFrame:
    """Simple-mean variant. A missing change counts as no change, so the first value is at row ``n``."""
    frame = w.rowsBetween(1 - n, 0)
    change = F.col(price) - F.lag(price, 1).over(w)
    rows = rows.withColumn("_change", change)
    rows = rows.withColumns(
        {
            "_gain": F.when(F.col("_change") > 0, F.col("_change")).otherwise(F.lit(0.0)),
            "_loss": F.when(F.col("_change") < 0, -F.col("_change")).otherwise(F.lit(0.0)),
        }
    )
    rows = rows.withColumns(
        {
            "_rows": F.count("_gain").over(frame),
            "_avg_gain": F.avg("_gain").over(frame),
            "_avg_loss": F.avg("_loss").over(frame),
            "_max_gain": F.max("_gain").over(frame),
            "_max_loss": F.max("_loss").over(frame),
        }
    )
    flat = (F.col("_max_gain") == 0) & (F.col("_max_loss") == 0)
    ratio = F.try_divide("_avg_gain", "_avg_loss")
    rsi = (
        F.when((F.col("_rows") < n) | flat, F.lit(None).cast("double"))
        .when(F.col("_max_loss") == 0, F.lit(100.0))
        .otherwise(100 - F.try_divide(F.lit(100.0), 1 + ratio))
    )
    return rows.withColumn("rsi", rsi).drop(
        "_change", "_gain", "_loss", "_rows", "_avg_gain", "_avg_loss", "_max_gain", "_max_loss"
    )


def sma(candles: DataFrame, n: int = 7, series: Series = CANDLES, price: str = "close") -> DataFrame:
    return over_series(candles, series, n - 1, lambda rows, w: _add_sma(rows, w, n, price))


def bollinger(
    candles: DataFrame, n: int = 20, k: float = 2.0, series: Series = CANDLES, price: str = "close"
) -> DataFrame:
    """Middle band (mean), upper and lower band (``k`` sample standard deviations away)."""
    return over_series(candles, series, n - 1, lambda rows, w: _add_bollinger(rows, w, n, k, price))


def rsi(candles: DataFrame, n: int = 14, series: Series = CANDLES, price: str = "close") -> DataFrame:
    return over_series(candles, series, n, lambda rows, w: _add_rsi(rows, w, n, price))


def indicators(
    candles: DataFrame,
    series: Series = CANDLES,
    price: str = "close",
    sma_n: int = 7,
    bb_n: int = 20,
    bb_k: float = 2.0,
    rsi_n: int = 14,
) -> DataFrame:
    """SMA, Bollinger bands and RSI in one pass over the blocks."""

    def add(rows: DataFrame, w: WindowSpec) -> DataFrame:
        rows = _add_sma(rows, w, sma_n, price)
        rows = _add_bollinger(rows, w, bb_n, bb_k, price)
        return _add_rsi(rows, w, rsi_n, price)

    return over_series(candles, series, max(sma_n - 1, bb_n - 1, rsi_n), add)


def macd(
    candles: DataFrame,
    fast: int = 12,
    slow: int = 26,
    signal: int = 9,
    series: Series = CANDLES,
    price: str = "close",
) -> DataFrame:
    """EMA fast and slow, MACD line, signal line and histogram.

    The recursion over the whole series is exact, whatever prices are missing: what a block of rows does to the three
    averages is a linear map of the averages before it. The maps are computed block by block, composed over the few
    blocks of a key, and each block then runs from the averages it starts with. A missing price keeps the averages.
    """
    if series.block_rows is None:
        series = Series(series.key, series.time, series.tie, series.chunk, 2**62)
    key = list(series.key)
    spread = materialize(spread_blocks(candles, series, 0).where(own_rows(series)), "macd-blocks")
    added = ["ema_fast", "ema_slow", "macd", "macd_signal", "macd_hist"]
    states = ["_f", "_s", "_g"]

    def run(x: np.ndarray, start: tuple) -> tuple:
        def mean(values, span, first):
            extended = pd.Series(np.concatenate([[first], values]))
            return extended.ewm(span=span, adjust=False, ignore_na=True).mean().to_numpy()[1:]

        f, s = mean(x, fast, start[0]), mean(x, slow, start[1])
        return f, s, mean(f - s, signal, start[2])

    def summarize(block: pd.DataFrame) -> pd.DataFrame:
        x = block.sort_values(ROW_INDEX, kind="stable")[price].to_numpy("float64")
        empty, zero = np.where(np.isnan(x), np.nan, 0.0), (0.0, 0.0, 0.0)
        ends = [run(x, (np.nan,) * 3), run(x, zero), *[run(empty, tuple(np.eye(3)[i])) for i in range(3)]]
        out = block[[*key, "_block"]].iloc[:1].copy()
        out["map"] = [np.array([[part[-1] for part in end] for end in ends]).ravel()]
        return out

    def compose(blocks: pd.DataFrame) -> pd.DataFrame:
        blocks = blocks.sort_values("_block")
        state, before = np.full(3, np.nan), []
        for flat in blocks["map"]:
            before.append(state)
            own, shift, *columns = np.asarray(flat).reshape(5, 3)
            state = own if np.isnan(state).any() else shift + np.stack(columns, axis=1) @ state
        out = blocks[[*key, "_block"]].copy()
        out[states] = np.stack(before)
        return out

    def compute(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(ROW_INDEX, kind="stable")
        start = tuple(block[c].iloc[0] for c in states)
        block["ema_fast"], block["ema_slow"], block["macd_signal"] = run(block[price].to_numpy("float64"), start)
        block["macd"] = block["ema_fast"] - block["ema_slow"]
        block["macd_hist"] = block["macd"] - block["macd_signal"]
        return block.drop(columns=states)

    fields = {f.name: f for f in spread.schema.fields}
    names = T.StructType([fields[c] for c in (*key, "_block")])
    doubles = [T.StructField(c, T.DoubleType()) for c in states]
    maps = spread.select(*key, "_block", ROW_INDEX, price).groupBy(*key, "_block")
    maps = maps.applyInPandas(summarize, T.StructType([*names.fields, T.StructField("map", T.ArrayType(T.DoubleType()))]))
    starts = maps.groupBy(*key).applyInPandas(compose, T.StructType([*names.fields, *doubles]))
    schema = T.StructType(spread.schema.fields + [T.StructField(c, T.DoubleType()) for c in added])
    result = spread.join(starts, [*key, "_block"]).select(*spread.columns, *states)
    return result.groupBy(*key, "_block").applyInPandas(compute, schema).drop("_block", ROW_INDEX)


def trend(candles: DataFrame, fast: int = 7, slow: int = 20, series: Series = CANDLES, price: str = "close") -> DataFrame:
    """SMA crossover state (-1, 0, 1), whether it changed on this row, and the slope per row."""

    def add(rows: DataFrame, w: WindowSpec) -> DataFrame:
        frame = w.rowsBetween(1 - slow, 0)
        rows = rows.withColumns(
            {"_fast": _full_frame(price, fast, w, F.avg), "_slow": _full_frame(price, slow, w, F.avg)}
        )
        # Averages of equal prices may differ in the last bits, in proportion to the price.
        apart = F.col("_fast") - F.col("_slow")
        same = F.abs(apart) <= 1e-12 * F.greatest(F.abs("_fast"), F.abs("_slow"))
        rows = rows.withColumn("state", F.when(same, 0).otherwise(F.signum(apart)).cast("int"))
        return rows.withColumns(
            {
                "cross": F.col("state") != F.lag("state", 1).over(w),
                "slope": F.when(
                    F.count(price).over(frame) >= 2,
                    F.regr_slope(F.col(price), F.col(ROW_INDEX).cast("double")).over(frame),
                ),
            }
        ).drop("_fast", "_slow")

    return over_series(candles, series, slow, add)


def return_anomalies(
    candles: DataFrame, n: int = 24, k: float = 3.0, series: Series = CANDLES, price: str = "close"
) -> DataFrame:
    """Z-score of the log return against the ``n`` rows before; flagged beyond ``k``."""

    def add(rows: DataFrame, w: WindowSpec) -> DataFrame:
        frame = w.rowsBetween(-n, -1)
        rows = rows.withColumn("log_return", log_return_column(price, w))
        rows = rows.withColumns(
            {
                "_n": F.count("log_return").over(frame),
                "_m": F.avg("log_return").over(frame),
                "_s": F.stddev_samp("log_return").over(frame),
            }
        )
        z = F.when((F.col("_n") >= n) & (F.col("_s") > 0), (F.col("log_return") - F.col("_m")) / F.col("_s"))
        return rows.withColumn("z_score", z).withColumn("is_anomaly", F.abs("z_score") > k).drop("_n", "_m", "_s")

    return over_series(candles, series, n + 1, add)


def candle_patterns(candles: DataFrame, series: Series = CANDLES) -> DataFrame:
    """Doji, hammer, bullish and bearish engulfing."""

    def add(rows: DataFrame, w: WindowSpec) -> DataFrame:
        o, h, lo, c = (F.col(x) for x in ("open", "high", "low", "close"))
        body, span = F.abs(c - o), h - lo
        lower, upper = F.least(o, c) - lo, h - F.greatest(o, c)
        rows = rows.withColumns({"_po": F.lag("open", 1).over(w), "_pc": F.lag("close", 1).over(w)})
        po, pc = F.col("_po"), F.col("_pc")
        known = lambda test: F.coalesce(test, F.lit(False))
        return rows.withColumns(
            {
                "doji": known((body <= 0.1 * span) & (span > 0)),
                "hammer": known((lower >= 2 * body) & (upper <= body) & (body > 0)),
                "bullish_engulfing": known((pc < po) & (c > o) & (o <= pc) & (c >= po)),
                "bearish_engulfing": known((pc > po) & (c < o) & (o >= pc) & (c <= po)),
            }
        ).drop("_po", "_pc")

    return over_series(candles, series, 1, add)


def volume_ratio(candles: DataFrame, n: int = 20, series: Series = CANDLES) -> DataFrame:
    """Volume over the mean volume of the ``n`` rows before."""

    def add(rows: DataFrame, w: WindowSpec) -> DataFrame:
        return rows.withColumn("volume_ratio", F.try_divide("volume", F.avg("volume").over(w.rowsBetween(-n, -1))))

    return over_series(candles, series, n, add)


def volume_analysis(candles: DataFrame, n: int = 20, series: Series = CANDLES) -> DataFrame:
    """Volume ratio, and the takers' share of the volume (needs ``taker_buy_volume`` per candle)."""
    return volume_ratio(candles, n, series).withColumn("taker_buy_share", F.try_divide("taker_buy_volume", "volume"))


def crossing(price: str, threshold: float) -> Column:
    """"up" or "down" where ``price`` crosses the threshold after ``previous``, else null."""
    up = (F.col("previous") < threshold) & (F.col(price) >= threshold)
    down = (F.col("previous") >= threshold) & (F.col(price) < threshold)
    return F.when(up, "up").when(down, "down")


def price_alerts(candles: DataFrame, threshold: float, series: Series = CANDLES, price: str = "close") -> DataFrame:
    """Rows where the price crosses the threshold, with the direction."""

    def add(rows: DataFrame, w: WindowSpec) -> DataFrame:
        return rows.withColumn("previous", F.lag(price, 1).over(w)).withColumn("direction", crossing(price, threshold))

    return over_series(candles, series, 1, add).where(F.col("direction").isNotNull())
