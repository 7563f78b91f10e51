"""How the given tables play the roles of trades, candles, klines and dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlespark.catalog.registry import NUDGE
from candlespark.functions.numeric import to_double
from candlespark.functions.time import unix_micros
from candlespark.operators.bars import ohlcv, taker_buy_quantity
from candlespark.session import materialize
from candlespark.sources.reference_data import coin_metadata, sentiment, symbol_universe

# Event types stand for symbols; the dimensions cover some of them, so that left joins find no match too.
EVENT_SYMBOLS = ("click", "error", "purchase", "signup", "view")
EVENT_METADATA = (("click", "Bitcoin", "PoW"), ("purchase", "Ethereum", "PoS"), ("view", "Solana", "PoS"))
EVENT_SENTIMENT = (
    (dt.date(2024, 1, 1), "click", 0.35),
    (dt.date(2024, 1, 1), "purchase", 0.21),
    (dt.date(2024, 1, 2), "view", -0.1),
)
EVENT_UNIVERSE = (*EVENT_SYMBOLS, "refund", "LEOUSD")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def trades(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("event_type").alias("symbol"),
        F.col("event_id").alias("trade_id"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("price"),
        to_double(F.get_json_object("props", "$.k")).alias("quantity"),
        (F.col("user_id") % 2 == 0).alias("is_buyer_maker"),
    )


def wide_trades(spark: SparkSession, folder: str) -> DataFrame:
    """Many symbols: line items as trades of their supplier."""
    return table(spark, folder, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("symbol"),
        F.col("l_orderkey").alias("trade_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_shipdate").alias("timestamp"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("quantity"),
    )


def hourly_candles(spark: SparkSession, folder: str, sums: dict[str, Column] | None = None) -> DataFrame:
    return ohlcv(trades(spark, folder), "1 hour", sums=sums)


def sliding_candles(spark: SparkSession, folder: str) -> DataFrame:
    return ohlcv(trades(spark, folder), "1 hour", "30 minutes")


def hourly_klines(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly candles in the columns of a kline table; the open time counts nanoseconds."""
    quote = F.col("price") * F.col("quantity")
    bars = hourly_candles(
        spark,
        folder,
        {
            "quote_asset_volume": quote,
            "taker_buy_base_asset_volume": taker_buy_quantity(),
            "taker_buy_quote_asset_volume": taker_buy_quantity() * F.col("price"),
        },
    )
    return bars.select(
        "symbol",
        F.col("start_time").alias("open_datetime"),
        F.to_date("start_time").alias("partition_date"),
        (unix_micros(F.col("start_time")) * 1000).alias("open_time"),
        *["open", "high", "low", "close", "volume", "quote_asset_volume"],
        F.col("trade_count").alias("number_of_trades"),
        *["taker_buy_base_asset_volume", "taker_buy_quote_asset_volume"],
    )


def stored_candles(spark: SparkSession, folder: str, sums: dict[str, Column] | None = None) -> DataFrame:
    """Hourly candles as a table: series operators read their input twice (row counts, then rows)."""
    return materialize(hourly_candles(spark, folder, sums), "candles")


def stored_klines(spark: SparkSession, folder: str) -> DataFrame:
    return materialize(hourly_klines(spark, folder), "klines")


def kline_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly klines as exchange payloads: JSON arrays of text, open time in milliseconds."""
    k = hourly_klines(spark, folder)
    text = lambda c: c.cast("string")
    millis = F.call_function("div", F.col("open_time"), F.lit(1_000_000))
    kline = F.array(
        text(millis),
        *[text(F.col(c)) for c in ("open", "high", "low", "close", "volume")],
        text(millis + 3_599_999),
        *[
            text(F.col(c))
            for c in (
                "quote_asset_volume",
                "number_of_trades",
                "taker_buy_base_asset_volume",
                "taker_buy_quote_asset_volume",
            )
        ],
        F.lit("0"),
    )
    return k.select("symbol", F.to_json(F.array(kline)).alias("payload"))


def daily_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """The klines of a symbol's day as one payload: at most 24 hourly bars."""
    bars = kline_payloads(spark, folder).withColumn("at", F.get_json_object("payload", "$[0][0]").cast("long"))
    days = bars.groupBy("symbol", F.to_date(F.timestamp_millis("at")).alias("day")).agg(F.sort_array(F.collect_list(F.struct("at", "payload"))).alias("bars"))
    # Each payload is a list of one bar: take off its brackets and join.
    inner = F.transform("bars", lambda bar: F.substring(bar["payload"], F.lit(2), F.length(bar["payload"]) - 2))
    return days.select("symbol", F.concat(F.lit("["), F.array_join(inner, ","), F.lit("]")).alias("payload"))


def event_metadata(spark: SparkSession) -> DataFrame:
    return coin_metadata(spark, EVENT_METADATA)


def event_sentiment(spark: SparkSession) -> DataFrame:
    return sentiment(spark, EVENT_SENTIMENT)


def event_universe(spark: SparkSession) -> DataFrame:
    return symbol_universe(spark, EVENT_UNIVERSE)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """Six digits, for comparing sums, means and logarithms."""
    return df.withColumns({c: F.round(F.col(c) + F.lit(NUDGE), 6) for c in names})


def naive(df: DataFrame, *names: str) -> DataFrame:
    """Timestamps without time zone, as the given tables have them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in names})
