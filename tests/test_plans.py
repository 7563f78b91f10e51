"""Shapes of physical plans that the run time at scale depends on."""

import re

import pytest

from candlespark.catalog import QUERIES
from candlespark.catalog import bindings as b
from candlespark.operators import features, indicators, ingest, serve, stats
from candlespark.operators.blocks import Series

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def candles(spark):
    return b.stored_candles(spark, FOLDER)


def exchanges(text):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)


@pytest.mark.parametrize("build", [indicators.indicators, lambda c: features.window_features(c, series=Series())])
def test_all_frames_share_one_shuffle_of_the_blocks(candles, plan, build):
    keys = exchanges(plan(build(candles)))
    assert len([k for k in keys if "_block" in k]) == 1
    # Rows move twice (numbering, blocks); the per-symbol shuffle carries one row per symbol and day.
    text = plan(build(candles))
    assert len(re.findall(r"FileScan parquet", text)) == 2
    assert "ReadSchema: struct<symbol:string,start_time:timestamp_ntz>" in text  # the counting scan


def test_symbol_filter_reaches_the_scan(spark, plan):
    text = plan(QUERIES["candles_for_symbol"](spark, FOLDER))
    assert "EqualTo(event_type,click)" in text


def test_candles_read_only_what_they_need(spark, plan):
    text = plan(b.hourly_candles(spark, FOLDER))
    (schema,) = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert {c.split(":")[0] for c in schema.split(",")} == {"event_id", "ts", "event_type", "value", "props"}


def test_pages_are_cut_before_the_shuffle(candles, plan):
    text = plan(serve.candles_page(candles, 10))
    assert re.search(r"WindowGroupLimit .*Partial", text) and re.search(r"WindowGroupLimit .*Final", text)


def test_one_symbol_page_is_a_top_n(candles, plan):
    assert "TakeOrderedAndProject" in plan(serve.candles_page(candles, 10, symbol="click"))


def test_gate_counts_before_it_joins(candles, plan):
    days = candles.withColumn("partition_date", candles.start_time.cast("date"))
    text = plan(ingest.full_day_gate(days, expected=24))
    assert "LeftSemi" in text and "partial_count(1)" in text and "Window" not in text


def test_no_operator_uses_a_cross_join(spark, plan, candles):
    trades = b.trades(spark, FOLDER)
    returns = features.log_return(candles, Series())
    for df in (stats.daily_stats(trades), stats.return_correlation(returns), stats.market_heatmap(candles)):
        text = plan(df)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_statistics_read_their_input_twice(spark, plan, monkeypatch):
    """Moments and sketch in one scan, placed values in another; all else reads what was written."""
    from candlespark.operators import quantiles

    written, real = [], quantiles.materialize
    for module in (quantiles, stats):
        monkeypatch.setattr(module, "materialize", lambda df, name: (written.append((name, plan(df))), real(df, name))[1])
    scans = lambda text, folder: len(re.findall(rf"FileScan parquet [^\n]*{folder}", text))
    trades = b.trades(spark, FOLDER)
    final = plan(stats.daily_stats(trades))
    assert [name for name, _ in written] == ["percentile-cuts", "percentile-values"]
    assert sum(scans(text, "events.parquet") for _, text in written) == 2 and scans(final, "events.parquet") == 0
    written.clear()
    candles = b.stored_candles(spark, FOLDER)
    source = candles.inputFiles()[0].split("/")[-2]
    final = plan(stats.risk_metrics(candles))
    assert sum(scans(text, source) for _, text in written) == 2 and scans(final, source) == 0
