"""Explicit schemas of every table and message the library reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T

# A trade message is JSON whose keys differ by letter case only (e/E, t/T, m/M). Reading the payload
# as a map keeps them apart without a session-wide case-sensitivity switch.
TRADE_MESSAGE = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("data", T.MapType(T.StringType(), T.StringType())),
        T.StructField("_corrupt_record", T.StringType()),
    ]
)

FLAT_TRADE = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("event_time", T.LongType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("trade_id", T.LongType()),
        T.StructField("price_str", T.StringType()),
        T.StructField("quantity_str", T.StringType()),
        T.StructField("trade_time", T.LongType()),
        T.StructField("is_buyer_maker", T.BooleanType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("date", T.DateType()),
        T.StructField("hour", T.IntegerType()),
    ]
)

CANDLE = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("end_time", T.TimestampType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
        T.StructField("trade_count", T.LongType()),
    ]
)
CANDLE_KEY = ("symbol", "start_time", "end_time")

# Positions of one kline in the exchange payload; fixed values.
KLINE_POSITIONS = (
    "open_time",
    "open",
    "high",
    "low",
    "close",
    "volume",
    "close_time",
    "quote_asset_volume",
    "number_of_trades",
    "taker_buy_base",
    "taker_buy_quote",
    "ignore",
)
KLINE_PAYLOAD = T.ArrayType(T.ArrayType(T.StringType()))

# Columns inside a lake file; symbol, year, month and day come from the directory names.
LAKE_KLINE_FILE = T.StructType(
    [
        T.StructField("open_time", T.LongType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
        T.StructField("quote_asset_volume", T.DoubleType()),
        T.StructField("number_of_trades", T.LongType()),
        T.StructField("taker_buy_base_asset_volume", T.DoubleType()),
        T.StructField("taker_buy_quote_asset_volume", T.DoubleType()),
    ]
)
LAKE_PARTITIONS = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
    ]
)
LAKE_KLINE = T.StructType(LAKE_KLINE_FILE.fields + LAKE_PARTITIONS.fields)

WAREHOUSE_KLINE = T.StructType(
    LAKE_KLINE_FILE.fields
    + [
        T.StructField("symbol", T.StringType()),
        T.StructField("open_datetime", T.TimestampType()),
        T.StructField("year", T.StringType()),
        T.StructField("month", T.StringType()),
        T.StructField("day", T.StringType()),
        T.StructField("partition_date", T.DateType()),
    ]
)

COIN_METADATA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("coin_name", T.StringType()),
        T.StructField("consensus", T.StringType()),
    ]
)
SENTIMENT = T.StructType(
    [
        T.StructField("partition_date", T.DateType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("sentiment_score", T.DoubleType()),
    ]
)
HIGH_WATER_MARK = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("first_day", T.DateType()),
        T.StructField("next_day", T.DateType()),
        T.StructField("rows", T.LongType()),
    ]
)
