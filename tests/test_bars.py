import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from candlespark.operators.bars import _ordered, ohlcv, rollup, vwap


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_ties_are_broken_by_trade_id_in_any_arrival_order(trades):
    data = [(5, 2, 20.0, 1.0), (5, 1, 10.0, 1.0), (5, 3, 15.0, 1.0)]
    for order in (data, data[::-1]):
        (candle,) = ohlcv(trades(order)).collect()
        assert (candle.open, candle.high, candle.low, candle.close) == (10.0, 20.0, 10.0, 15.0)
        assert (candle.volume, candle.trade_count) == (3.0, 3)


def test_a_trade_on_the_edge_starts_the_next_window(trades):
    first, second = sorted(ohlcv(trades([(59, 1, 1.0, 1.0), (60, 2, 2.0, 1.0)])).collect(), key=lambda r: r.start_time)
    assert (first.close, second.open) == (1.0, 2.0)
    assert second.start_time - first.start_time == dt.timedelta(minutes=1)
    assert second.end_time - second.start_time == dt.timedelta(minutes=1)


def test_sliding_membership(trades):
    df = ohlcv(trades([(45, 1, 1.0, 2.0)]), "1 minute", "30 seconds")
    assert sorted(r.start_time.second for r in df.collect()) == [0, 30]


def _random_trades(spark, n=4000, seed=1):
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    ids = [rng.choice([rng.randrange(-5, 5), rng.randrange(2**62, 2**62 + 9), rng.randrange(2**31), -(2**61), None]) for _ in range(n)]
    data = [
        (rng.choice(["A", "A", "B", None]), i, start + dt.timedelta(milliseconds=rng.randrange(0, 600_000, 250)),
         rng.choice([None, float(rng.randrange(1, 50))]), float(rng.randrange(1, 5)), j)
        for j, i in enumerate(ids)
    ]
    schema = "symbol string, trade_id long, timestamp timestamp, price double, quantity double, n long"
    # Equal (symbol, time, id) would leave the order open: keep one.
    return spark.createDataFrame(data, schema).dropDuplicates(["symbol", "timestamp", "trade_id"]).cache()


def test_panes_and_stages_equal_one_step_aggregation(spark):
    trades = _random_trades(spark)
    for window, slide in (("1 minute", None), ("1 minute", "30 seconds"), ("90 seconds", "1 minute"), ("1 hour", None)):
        direct = _ordered(trades, window, slide, "timestamp", "symbol", "price", "quantity", ["trade_id", "n"], {}).cache()
        for found in (ohlcv(trades, window, slide), ohlcv(trades, window, slide, dense=False), ohlcv(trades, window, slide, tie=["trade_id", "n"])):
            assert found.exceptAll(direct).count() == 0 and direct.exceptAll(found).count() == 0
            assert found.count() == direct.count() > 0


@pytest.mark.parametrize("how", [{"dense": False}, {"tie": ["trade_id", "n"]}])
def test_hashed_ids_and_several_ties_sort_no_trades(spark, plan, how):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(ohlcv(_random_trades(spark), "1 minute", **how))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    first_look = text[text.index("partial_min(_ts") :]
    assert "SortAggregate" not in first_look and "HashAggregate" in first_look
    # The one sort of order structs lies above the join that keeps the trades at extreme times.
    assert text.index("partial_min_by") < text.index("SortMergeJoin")


def test_pane_step_is_a_hash_aggregation(spark, plan):
    text = plan(ohlcv(_random_trades(spark), "1 minute", "30 seconds"))
    below_merge = text[text.rindex("SortAggregate") :]
    assert "partial_min_by(_price" in below_merge and "HashAggregate" in below_merge


def test_rollup_of_minutes_equals_hours(spark):
    trades = _random_trades(spark).where("price IS NOT NULL AND symbol IS NOT NULL")
    assert rows(rollup(ohlcv(trades, "1 minute"), "5 minutes")) == rows(ohlcv(trades, "5 minutes"))


def test_extra_sums(trades):
    df = ohlcv(trades([(0, 1, 2.0, 3.0), (1, 2, 5.0, 1.0)]), sums={"quote": F.col("price") * F.col("quantity")})
    assert df.first().quote == 11.0


def test_vwap_without_volume_is_null(trades):
    assert vwap(trades([(0, 1, 2.0, 0.0)])).first().vwap is None
    assert vwap(trades([(0, 1, 2.0, 1.0), (1, 2, 4.0, 3.0)])).first().vwap == 3.5
