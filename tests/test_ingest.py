import json

import pytest
from pyspark.sql import functions as F

from candlespark.functions.time import is_valid_epoch, micros
from candlespark.operators import ingest
from candlespark.plans import klines as plans
from candlespark.sources.messages import trades_to_json


def message(**data):
    base = {"e": "trade", "E": 1700000000123, "s": "BTCUSDT", "t": 7, "p": "1.5", "q": "2", "T": 1700000000100, "m": True, "M": False}
    return json.dumps({"stream": "btcusdt@trade", "data": {**base, **data}})


def parse(spark, *texts):
    return ingest.parse_trades(spark.createDataFrame([(t,) for t in texts], "value string")).collect()


def test_case_variant_keys_stay_apart(spark):
    (row,) = parse(spark, message())
    assert (row.event_type, row.event_time, row.trade_id, row.trade_time) == ("trade", 1700000000123, 7, 1700000000100)
    assert row.is_buyer_maker is True
    assert (row.price, row.quantity) == (1.5, 2.0)
    assert (str(row.date), row.hour) == ("2023-11-14", 22)
    assert row.timestamp.microsecond == 100_000


def test_malformed_message_gives_nulls_and_bad_price_keeps_the_row(spark):
    bad, odd = parse(spark, "{bad", message(p="x"))
    assert all(v is None for v in bad)
    assert odd.price is None and odd.price_str == "x" and odd.symbol == "BTCUSDT"


def test_quarantine_splits_every_message(spark):
    texts = [message(), "{bad", "", None, "{}", "[1", message(p="x")]
    good, bad = ingest.quarantine(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert sorted(r.value for r in good.collect()) == sorted([message(), "{}", message(p="x")])
    assert good.count() + bad.count() == len(texts)


def test_binary_values_are_read(spark):
    df = spark.createDataFrame([(bytearray(message().encode()),)], "value binary")
    assert ingest.parse_trades(df).first().symbol == "BTCUSDT"


def test_messages_parse_back(spark, trades):
    source = trades([(0, 1, 10.25, 3.0), (1, 2, 0.1, 7.0)])
    back = ingest.parse_trades(trades_to_json(source)).select(*source.columns)
    assert sorted(back.collect()) == sorted(source.collect())


def test_timestamp_bounds(spark):
    ticks = [None, 946684799999999999, 946684800000000000, 4102444800000000000, 4102444800000000001, 1700000000123]
    df = spark.createDataFrame([(t,) for t in ticks], "open_time long")
    kept = [r.open_time for r in ingest.valid_timestamps(df).collect()]
    assert kept == [946684800000000000, 4102444800000000000]
    assert [r.open_time for r in ingest.valid_timestamps(df, unit="ms").collect()] == [1700000000123]
    stats = ingest.reject_stats(df, is_valid_epoch(F.col("open_time"), "ns")).first()
    assert tuple(stats) == (6, 2, 4, 66.67)


def test_reject_stats_of_nothing(spark):
    df = spark.createDataFrame([], "open_time long")
    assert tuple(ingest.reject_stats(df, is_valid_epoch(F.col("open_time"), "ns")).first()) == (0, 0, 0, None)


def test_open_datetime_is_whole_seconds(spark):
    df = spark.createDataFrame([(1700000000123456789,), (1700000000999999999,), (None,)], "open_time long")
    rows = ingest.with_open_datetime(df).select(F.date_format("open_datetime", "HH:mm:ss.SSS").alias("x")).collect()
    assert [r.x for r in rows] == ["22:13:20.000", "22:13:20.000"]


def test_status_splits_in_one_pass(spark, plan):
    from candlespark.session import shared_dir
    from candlespark.sinks.tables import write_split

    texts = ['{"stream": "a"}', "{bad", "", None, "[1]", '{"data": {}}']
    marked = ingest.with_status(spark.createDataFrame([(t,) for t in texts], "value string"))
    path = shared_dir(spark, "split")
    for _ in range(2):  # a retry replaces both parts
        write_split(marked, path)
    good, bad = ingest.quarantine(marked)
    for status, part in (("good", good), ("bad", bad)):
        read = spark.read.parquet(f"{path}/status={status}").select("value")
        assert sorted(read.collect(), key=str) == sorted(part.select("value").collect(), key=str)
    assert good.count() + bad.count() == len(texts)


def test_a_day_per_payload_is_gated_by_its_size(spark, plan):
    import json

    def day(symbol, n):
        return symbol, json.dumps([[i * 60_000, *["1.5"] * 5, 0, "1", 3, "1", "1", "0"] for i in range(n)])

    payloads = spark.createDataFrame([day("A", 24), day("B", 23), day("C", 25), day("D", 0), ("E", None), ("F", "{bad"), day("G", 24)], "symbol string, payload string")
    rows = plans.lake_rows(payloads, 24, daily=True)
    assert {(r.symbol, r["count"]) for r in rows.groupBy("symbol").count().collect()} == {("A", 24), ("G", 24)}
    text = plan(rows)
    assert "Exchange" not in text and text.count("from_json") == 1
    counted = plans.lake_rows(payloads, 24)
    assert sorted(map(tuple, counted.collect())) == sorted(map(tuple, rows.collect()))


def test_full_day_gate(spark):
    days = spark.createDataFrame([("A", 1439), ("B", 1440), ("C", 1441)], "symbol string, n int")
    rows = days.select("symbol", F.lit("2024-01-01").cast("date").alias("partition_date"), F.explode(F.sequence(F.lit(1), "n")))
    kept = ingest.full_day_gate(rows)
    assert {(r.symbol, r["count"]) for r in kept.groupBy("symbol").count().collect()} == {("B", 1440)}
    assert {(r.symbol, r.kline_count) for r in ingest.incomplete_days(rows).collect()} == {("A", 1439), ("C", 1441)}


def test_normalize_klines_positions_and_bad_numbers(spark):
    kline = ["1700000040000", "1", "2", "0.5", "x", "10", "1700000099999", "15", "3", "4", "6", "0"]
    short = ["1700000100000", "1"]
    payload = json.dumps([kline, short])
    rows = ingest.normalize_klines(spark.createDataFrame([("A", payload)], "symbol string, payload string")).collect()
    first, second = sorted(rows, key=lambda r: r.open_time)
    assert (first.open, first.high, first.low, first.close, first.volume) == (1, 2, 0.5, None, 10)
    assert (first.quote_asset_volume, first.number_of_trades) == (15, 3)
    assert (first.taker_buy_base_asset_volume, first.taker_buy_quote_asset_volume) == (4, 6)
    assert (second.open, second.close, second.number_of_trades) == (1, None, None)


def test_dedup_removes_repeats_only(spark, trades):
    one = trades([(0, 1, 1.0, 1.0), (0, 2, 1.0, 1.0)])
    assert sorted(ingest.dedup_trades(one.union(one)).collect()) == sorted(one.collect())


@pytest.mark.parametrize("text", ["", "minute", "0 minutes", "1 month", "-1 second", "1.5 hours"])
def test_bad_durations(text):
    with pytest.raises(ValueError):
        micros(text)
