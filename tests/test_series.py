import datetime as dt
import math
import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from candlespark.operators import features, indicators, quality, stats
from candlespark.operators.blocks import Series, running_max, with_row_index
from candlespark.operators.serve import candles_page, sliding_with_indicators

START = dt.datetime(2024, 1, 1)
PLAIN = Series(block_rows=None)


def walk(n, seed=3, symbol="A", gap=0.3, nulls=0.0):
    """Random prices with gaps of up to a few days between bars."""
    rng = random.Random(seed)
    at, price, out = START, 100.0, []
    for _ in range(n):
        at += dt.timedelta(hours=rng.choice([1, 1, 1, 30, 90]) if rng.random() < gap else 1)
        price = max(1.0, price + rng.choice([-2.0, -1.0, 0.0, 1.0, 2.0]))
        close = None if rng.random() < nulls else price
        low, high = price - rng.random(), price + rng.random()
        out.append((symbol, at, price, high, low, close, float(rng.randrange(1, 9))))
    return out


SCHEMA = "symbol string, start_time timestamp, open double, high double, low double, close double, volume double"


@pytest.fixture(scope="module")
def candles(spark):
    data = walk(700, 1, "HOT") + walk(3, 2, "TINY") + walk(90, 3, "MID", nulls=0.1) + walk(1, 4, "ONE")
    return spark.createDataFrame(data, SCHEMA).repartition(5).cache()


def frame(df):
    return df.orderBy("symbol", "start_time").toPandas()


BLOCKED = [Series(block_rows=30, chunk="1 day"), Series(block_rows=64, chunk="1 hour"), Series(block_rows=5000, chunk="7 days")]

OPERATORS = {
    "indicators": lambda df, s: indicators.indicators(df, s),
    "sma": lambda df, s: indicators.sma(df, 7, s),
    "trend": lambda df, s: indicators.trend(df, series=s),
    "anomalies": lambda df, s: indicators.return_anomalies(df, series=s),
    "patterns": lambda df, s: indicators.candle_patterns(df, s),
    "volume": lambda df, s: indicators.volume_ratio(df, series=s),
    "alerts": lambda df, s: indicators.price_alerts(df, 100.0, s),
    "features": lambda df, s: features.window_features(df, series=s),
    "volatility": lambda df, s: features.rolling_volatility(df, series=s),
    "gaps": lambda df, s: quality.candle_gaps(df, "1 hour", s),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_blocks_equal_plain_windows(candles, name):
    expected = frame(OPERATORS[name](candles, PLAIN))
    assert len(expected) > 0
    for series in BLOCKED:
        pd.testing.assert_frame_equal(frame(OPERATORS[name](candles, series)), expected, rtol=1e-12, atol=1e-12)


def test_row_index_is_dense(candles):
    got = with_row_index(candles, Series(chunk="1 hour")).toPandas().sort_values(["symbol", "start_time"])
    for _, part in got.groupby("symbol"):
        assert list(part["_row_index"]) == list(range(len(part)))


def test_rows_without_a_position_fail_loudly(spark):
    df = spark.createDataFrame([("A", None, 1.0), (None, START, 1.0)], "symbol string, start_time timestamp, close double")
    with pytest.raises(Exception, match="non-null key and time"):
        indicators.sma(df, 2).collect()


def test_running_max(candles):
    got = frame(running_max(candles, Series(chunk="1 day"), "close", "peak"))
    for _, part in got.groupby("symbol"):
        assert np.allclose(part["peak"], part["close"].cummax().ffill(), equal_nan=True)


# --- against pandas ----------------------------------------------------------------------------------


def pandas_indicators(close: pd.Series) -> pd.DataFrame:
    """The definitions, written down independently."""
    up, down = [], []
    for before, now in zip([None, *close[:-1]], close, strict=True):
        step = 0.0 if before is None or math.isnan(before) or math.isnan(now) else now - before
        up.append(max(step, 0.0))
        down.append(max(-step, 0.0))
    out = {"sma_7": [], "bb_middle": [], "bb_upper": [], "bb_lower": [], "rsi": []}
    for i in range(len(close)):
        last7, last20 = close[max(0, i - 6) : i + 1], close[max(0, i - 19) : i + 1]
        out["sma_7"].append(np.mean(last7) if len(last7) == 7 and not np.isnan(last7).any() else np.nan)
        full = len(last20) == 20 and not np.isnan(last20).any()
        mean, std = (np.mean(last20), np.std(last20, ddof=1)) if full else (np.nan, np.nan)
        out["bb_middle"].append(mean)
        out["bb_upper"].append(mean + 2 * std)
        out["bb_lower"].append(mean - 2 * std)
        gain, loss = np.mean(up[max(0, i - 13) : i + 1]), np.mean(down[max(0, i - 13) : i + 1])
        if i < 13 or (gain == 0 and loss == 0):
            out["rsi"].append(np.nan)
        else:
            out["rsi"].append(100.0 if loss == 0 else 100 - 100 / (1 + gain / loss))
    return pd.DataFrame(out)


@pytest.mark.parametrize("series", [PLAIN, Series(block_rows=25)])
def test_indicators_match_their_definition(spark, series):
    rising, flat, falling = [float(i) for i in range(1, 31)], [30.0] * 30, [float(i) for i in range(30, 0, -1)]
    closes = [None if i == 5 else c for i, c in enumerate(rising + flat + falling)] + [r[5] for r in walk(60, 9, nulls=0.05)]
    data = [("A", START + dt.timedelta(minutes=i), c) for i, c in enumerate(closes)]
    df = spark.createDataFrame(data, "symbol string, start_time timestamp, close double")
    got = frame(indicators.indicators(df, series))
    want = pandas_indicators(np.array([np.nan if c is None else c for c in closes]))
    for name in want:
        assert list(got[name].isna()) == list(want[name].isna()), name
        assert np.allclose(got[name], want[name], equal_nan=True, atol=1e-9), name
    assert got["rsi"].isna().sum() >= 13 and (got["rsi"] == 100).any() and (got["rsi"] == 0).any()


def test_first_rsi_is_on_row_fourteen(spark):
    df = spark.createDataFrame(walk(20, 5, gap=0), SCHEMA)
    got = frame(indicators.rsi(df))["rsi"]
    assert got[:13].isna().all() and got[13:].notna().all()


def test_macd_matches_the_recursion_over_all_rows(spark):
    series = Series(block_rows=1000)
    df = spark.createDataFrame(walk(4200, 11, "A") + walk(5, 12, "B"), SCHEMA)
    got = frame(indicators.macd(df, series=series))
    assert len(got) == 4205

    def ema(x, n):
        a, out = 2 / (n + 1), [x[0]]
        for v in x[1:]:
            out.append(a * v + (1 - a) * out[-1])
        return np.array(out)

    for _, part in got.groupby("symbol"):
        x = part["close"].to_numpy()
        line = ema(x, 12) - ema(x, 26)
        assert np.allclose(part["macd"], line, rtol=0, atol=1e-11)
        assert np.allclose(part["macd_signal"], ema(line, 9), rtol=0, atol=1e-11)
        assert np.allclose(part["macd_hist"], line - ema(line, 9), rtol=0, atol=1e-11)
    pd.testing.assert_frame_equal(frame(indicators.macd(df, series=PLAIN)), got, atol=1e-11)


def test_macd_over_missing_prices_equals_the_plain_form(spark):
    missing = lambda i: 150 <= i < 1990 or i % 5 == 0
    rows = [(*row[:5], None if missing(i) else row[5], row[6]) for i, row in enumerate(walk(2500, 3, "A"))]
    df = spark.createDataFrame(rows, SCHEMA)
    got = frame(indicators.macd(df, series=Series(block_rows=300)))
    pd.testing.assert_frame_equal(got, frame(indicators.macd(df, series=PLAIN)), rtol=1e-12, atol=1e-11)
    assert got["ema_slow"].notna().iloc[1:].all()


def test_trend_does_not_depend_on_the_size_of_prices(spark):
    rising = [("A", START + dt.timedelta(hours=i), 1.12e-6 + i * 1e-9) for i in range(40)]
    df = spark.createDataFrame(rising, "symbol string, start_time timestamp, close double")
    assert set(frame(indicators.trend(df))["state"].dropna()) == {1}


def test_log_return_edges(spark):
    data = [("A", START + dt.timedelta(hours=i), c) for i, c in enumerate([1.0, math.e, 0.0, 5.0, 5.0])]
    df = spark.createDataFrame(data, "symbol string, start_time timestamp, close double")
    got = [r.log_return for r in features.log_return(df, Series()).orderBy("start_time").collect()]
    assert got == [None, pytest.approx(1.0), None, None, 0.0]


def test_sma_frame_is_25_rows_and_volatility_needs_two_returns(spark):
    df = spark.createDataFrame(walk(40, 6, gap=0), SCHEMA)
    got = frame(features.window_features(df, series=Series()))
    assert got["sma_24h"][0] == got["close"][0]
    assert got["sma_24h"][30] == pytest.approx(got["close"][6:31].mean())
    assert got["volatility_24h"][:2].isna().all() and got["volatility_24h"][2:].notna().all()


def test_frames_must_not_look_ahead(candles):
    with pytest.raises(ValueError):
        features.sma_rows(candles, -3, 1, Series())
    with pytest.raises(ValueError):
        features.sma_rows(candles, -50, 0, Series(block_rows=10)).collect()


def test_pages(spark):
    df = spark.createDataFrame(walk(300, 7, "A", gap=0) + walk(20, 8, "B", gap=0), SCHEMA)
    order = [r.start_time for r in df.where("symbol = 'A'").orderBy("start_time").collect()]
    oldest = [r.start_time for r in candles_page(df, 200, symbol="A").collect()]
    assert oldest == order[:200]
    newest = [r.start_time for r in candles_page(df, 200, newest=True, symbol="A").collect()]
    assert newest == order[100:]
    every = candles_page(df, 200).groupBy("symbol").count().collect()
    assert {r.symbol: r["count"] for r in every} == {"A": 200, "B": 20}
    page = sliding_with_indicators(df, 200).where("symbol = 'A'").orderBy("start_time").collect()
    assert [r.start_time for r in page] == [t.strftime("%Y-%m-%dT%H:%M:%S") for t in order[50:250]]
    assert all(r.bb_middle is not None and r.rsi is not None for r in page)
    for limit in (0, -1, 1001):
        with pytest.raises(ValueError):
            candles_page(df, limit)


# --- statistics --------------------------------------------------------------------------------------


def test_risk_metrics(spark):
    df = spark.createDataFrame(walk(500, 13, "A") + walk(2, 14, "B"), SCHEMA)
    got = {r.symbol: r for r in stats.risk_metrics(df, Series(chunk="1 day", block_rows=50)).collect()}
    close = frame(df.where("symbol = 'A'"))["close"]
    returns = np.log(close).diff().dropna()
    assert got["A"].max_drawdown == pytest.approx((close / close.cummax() - 1).min())
    assert got["A"].volatility == pytest.approx(returns.std())
    assert got["A"].var_5 == pytest.approx(np.quantile(returns, 0.05))
    assert got["B"].volatility is None


@pytest.mark.parametrize("block", [2, 256])
def test_return_correlation_with_a_large_mean_and_blocks(spark, block):
    random = np.random.default_rng(3)
    values = random.normal(0, 1e-3, (300, 5)) + 1e6
    start = dt.datetime(2024, 1, 1)
    rows = [(f"S{j}", start + dt.timedelta(minutes=10 * i), float(values[i, j])) for i in range(300) for j in range(5)]
    df = spark.createDataFrame(rows, "symbol string, start_time timestamp, log_return double")
    got = {(r.symbol_a, r.symbol_b): r.correlation for r in stats.return_correlation(df, block=block).collect()}
    centred = values - values.mean(axis=0)
    want = np.corrcoef(centred.T)
    assert len(got) == 10 and all(got[f"S{i}", f"S{j}"] == pytest.approx(want[i, j], abs=1e-6) for i in range(5) for j in range(i + 1, 5))


def test_return_correlation_over_common_bars(spark):
    rng = np.random.default_rng(5)
    wide = pd.DataFrame(rng.normal(size=(200, 4)), columns=list("ABCD"))
    wide = wide.mask(rng.random(wide.shape) < 0.2)
    wide["E"] = 1.0
    data = [
        (s, START + dt.timedelta(hours=i), float(v)) for s in wide for i, v in enumerate(wide[s]) if not math.isnan(v)
    ]
    df = spark.createDataFrame(data, "symbol string, start_time timestamp, log_return double")
    got = {(r.symbol_a, r.symbol_b): r for r in stats.return_correlation(df).collect()}
    assert len(got) == 10
    for (a, b), row in got.items():
        both = wide[[a, b]].dropna()
        assert row.common_bars == len(both)
        want = both[a].corr(both[b]) if "E" not in (a, b) else None
        assert row.correlation == (None if want is None else pytest.approx(want))


@pytest.mark.parametrize("stretch", ["1 hour", "1 day", "365 days"])
def test_return_correlation_ignores_times_of_one_symbol_only(spark, stretch):
    """Values beside the common times, however large, and constants cost no digits."""
    random = np.random.default_rng(9)
    a, b = random.normal(size=(2, 200))
    at = [START + dt.timedelta(minutes=17 * i) for i in range(202)]
    rows = [(s, t, float(v)) for s, x in (("A", a), ("B", b), ("C", np.full(200, 1 / 3))) for t, v in zip(at, x)]
    # D is far away except where it meets the others, E only meets F, in one bar.
    rows += [("A", at[200], -1e6), ("E", at[201], 1.0), ("F", at[201], 2.0)]
    rows += [("D", t, float(v)) for t, v in zip(at, a * 1e-3)] + [("D", t + dt.timedelta(seconds=1), 1e9) for t in at[:200] for _ in range(1)]
    df = spark.createDataFrame(rows, "symbol string, start_time timestamp, log_return double")
    got = {(r.symbol_a, r.symbol_b): r for r in stats.return_correlation(df, stretch=stretch).collect()}
    assert got["A", "B"].correlation == pytest.approx(np.corrcoef(a, b)[0, 1], abs=1e-12)
    assert got["A", "D"].correlation == pytest.approx(1, abs=1e-6) and got["A", "D"].common_bars == 200
    assert got["A", "C"].correlation is None and got["E", "F"].correlation is None and got["E", "F"].common_bars == 1
    assert ("A", "E") not in got


@pytest.mark.parametrize("rows_to_a_tile", [1, 30, 1_000_000])
def test_correlations_of_many_blocks_equal_those_of_one_and_shuffle_no_pairs(spark, plan, monkeypatch, rows_to_a_tile):
    """Also for missing times, constants, large means and symbols that meet once or never."""
    random = np.random.default_rng(12)
    names, rows = [f"S{j}" for j in range(40)], []
    for j, name in enumerate(names):
        at = [*random.choice(120, 40 if j % 2 else 8, replace=False).tolist(), *([None] if j % 3 == 0 else [])]
        rows += [(name, None if i is None else START + dt.timedelta(hours=i), 1 / 3 if j == 5 else float(random.normal() + 10.0 ** (j % 7))) for i in at]
    df = spark.createDataFrame(rows, "symbol string, start_time timestamp, log_return double")
    want = {(r.symbol_a, r.symbol_b): r for r in stats.return_correlation(df, stretch="1 day").collect()}
    monkeypatch.setattr(stats, "TILE_ROWS", rows_to_a_tile)
    many = stats.return_correlation(df, stretch="1 day", block=3)
    if rows_to_a_tile > 30:
        after = plan(many).split("CartesianProduct")
        assert len(after) == 2 and "Exchange" not in after[0] and "FlatMapGroups" not in after[0]
    got = {(r.symbol_a, r.symbol_b): r for r in many.collect()}
    assert got.keys() == want.keys() and len(want) < 780 and any(r.common_bars == 1 for r in want.values())
    for pair, row in got.items():
        assert row.common_bars == want[pair].common_bars
        assert row.correlation == (None if want[pair].correlation is None else pytest.approx(want[pair].correlation, abs=1e-8))
    with pytest.raises(Exception, match="two values at one time|duplicate"):
        stats.return_correlation(df.unionByName(df.where("symbol = 'S1'")), block=3).collect()


def test_many_pairs_are_finished_where_they_are_made(spark, plan, tmp_path):
    """Nothing is computed behind the product, not even the rounding, and all rows equal the SQL."""
    import duckdb

    from __spark_entry__ import oracle_sql, queries

    path = f"{tmp_path}/lineitem.parquet"
    duckdb.sql(f"""COPY (
        SELECT i % 1100 AS l_suppkey, TIMESTAMP '2024-01-01' + INTERVAL 1 DAY * (hash(i) % 9)::INT AS l_shipdate, 1.0 + i % 7 AS l_quantity,
               CASE WHEN i % 1100 = 5 THEN l_quantity ELSE (hash(i, 1) % 100000)::DOUBLE END AS l_extendedprice
        FROM range(7700) r(i)) TO '{path}' (FORMAT parquet)""")
    df = queries()["sparse_correlation"](spark, str(tmp_path))
    text = plan(df)
    assert "MapInArrow" in text and "CartesianProduct" in text
    assert not re.search("round|sqrt|rint", text.split("MapInArrow")[0], re.IGNORECASE)
    got = df.toArrow()  # noqa: F841
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{path}'")
    con.execute(f"CREATE TABLE want AS {oracle_sql()['sparse_correlation']}")
    con.register("got", got)
    rows, bars, apart, nulls, single = con.execute("""
        SELECT count(*) FILTER (w.symbol_a IS NULL OR g.symbol_a IS NULL), count(*) FILTER (w.common_bars <> g.common_bars),
               count(*) FILTER (w.correlation IS DISTINCT FROM g.correlation AND coalesce(abs(w.correlation - g.correlation) > 2e-6, true)),
               count(*) FILTER (g.correlation IS NULL), count(*) FILTER (g.common_bars = 1)
        FROM want w FULL JOIN got g USING (symbol_a, symbol_b)""").fetchone()
    assert (rows, bars, apart) == (0, 0, 0) and nulls > single > 0 and got.num_rows > 500_000


@pytest.mark.parametrize("wide", [1, 3])
def test_wide_tiles_hold_each_pair_once_and_are_packed_once(spark, monkeypatch, wide):
    random = np.random.default_rng(4)
    rows = [(f"S{j}", START + dt.timedelta(hours=int(i)), float(random.normal())) for j in range(30) for i in random.choice(60, 30, replace=False)]
    df = spark.createDataFrame(rows, "symbol string, start_time timestamp, log_return double")
    written, real = [], stats.materialize
    monkeypatch.setattr(stats, "materialize", lambda df, name: (written.append(name), real(df, name))[1])
    monkeypatch.setattr(stats, "MANY_TILES", 3)
    monkeypatch.setattr(stats, "WIDE_TILE", wide)
    want = {(r.symbol_a, r.symbol_b): r for r in stats.return_correlation(df, digits=3, shift=1e-8).collect()}
    got = stats.return_correlation(df, block=2, digits=3, shift=1e-8)
    rows = got.collect()
    assert written == ["correlation-returns", "correlation-returns", "correlation-tiles"]
    assert len(rows) == len(want) == 435 and {(r.symbol_a, r.symbol_b): r for r in rows} == want


def test_next_bar_prediction_matches_direct_least_squares(spark):
    from candlespark.plans.prediction import lagged_returns, next_bar_prediction

    df = spark.createDataFrame(walk(400, 21, "A", gap=0), SCHEMA)
    got = next_bar_prediction(df).first()
    rows = lagged_returns(df).orderBy("start_time").toPandas()
    at = rows["start_time"]
    cut = at.min() + (at.max() - at.min()) * 0.8
    train, test = rows[at <= cut], rows[at > cut]
    x = lambda t: np.column_stack([np.ones(len(t)), *[t[f"lag_{i}"] for i in range(1, 6)]])
    beta, *_ = np.linalg.lstsq(x(train), train["log_return"], rcond=None)
    rmse = float(np.sqrt(np.mean((x(test) @ beta - test["log_return"]) ** 2)))
    assert [got.intercept, *[got[f"lag_{i}"] for i in range(1, 6)]] == pytest.approx(list(beta), abs=1e-8)
    assert got.rmse == pytest.approx(rmse, abs=1e-9)


def test_walk_forward_equals_a_fit_per_day(spark):
    from candlespark.plans.prediction import lagged_returns, next_bar_prediction, walk_forward

    df = spark.createDataFrame(walk(900, 22, "A", gap=0) + walk(700, 23, "B", gap=0), SCHEMA)
    got = {r.part: r for r in walk_forward(df, "6 hours", lags=3, series=Series(block_rows=100)).collect()}
    rows = lagged_returns(df, 3).toPandas()
    part = (rows["start_time"] - pd.Timestamp(0)) // pd.Timedelta(hours=6)
    x = lambda t: np.column_stack([np.ones(len(t)), *[t[f"lag_{i}"] for i in range(1, 4)]])
    expected = [p for p in sorted(set(part)) if (part < p).sum() >= 6]
    assert sorted(got) == expected and len(expected) > 1
    for p in expected:
        train, test = rows[part < p], rows[part == p]
        beta, *_ = np.linalg.lstsq(x(train), train["log_return"], rcond=None)
        row = got[p]
        assert (row.n_train, row.n) == (len(train), len(test))
        assert [row.intercept, row.lag_1, row.lag_2, row.lag_3] == pytest.approx(list(beta), abs=1e-8)
        assert row.rmse == pytest.approx(float(np.sqrt(np.mean((x(test) @ beta - test["log_return"]) ** 2))), abs=1e-9)
    assert next_bar_prediction(df.limit(0)).count() == 0 == walk_forward(df.limit(0)).count()


def test_validation_counts(spark):
    data = [("A", START, 1.0, 2.0, 0.5, 1.5), ("A", START, 1.0, 0.5, 2.0, -1.0), ("B", START, None, 2.0, 0.5, 3.0)]
    df = spark.createDataFrame(data, "symbol string, start_time timestamp, open double, high double, low double, close double")
    got = quality.validate_candles(df).first().asDict()
    assert got == {
        "rows": 3, "null_price": 1, "negative_price": 1, "high_below_low": 1, "open_outside": 1, "close_outside": 2,
        "duplicate_key": 1,
    }
    empty = quality.validate_candles(df.where(F.lit(False))).first().asDict()
    assert set(empty.values()) == {0}


def test_retention_keeps_the_newest_days(spark):
    df = spark.range(30).select(F.date_add(F.lit(START.date()), F.col("id").cast("int")).alias("partition_date"))
    assert quality.retention_keep(df, 7).count() == 8
