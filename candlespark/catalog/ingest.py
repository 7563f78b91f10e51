"""Parsing, casting, filtering, gating and duplicate removal."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlespark.catalog import bindings as b
from candlespark.catalog.registry import KLINES, TRADES, query, r6
from candlespark.functions.time import is_valid_epoch, unix_micros
from candlespark.operators import ingest, stats
from candlespark.session import shared_dir
from candlespark.sinks.tables import write_split
from candlespark.sources.messages import trades_to_json

_FLAT = f"""WITH {TRADES}
SELECT lower(symbol) || '@trade' AS stream, 'trade' AS event_type, epoch_us("timestamp") // 1000 AS event_time, symbol, trade_id,
       epoch_us("timestamp") // 1000 AS trade_time, is_buyer_maker, price, quantity,
       time_bucket(INTERVAL '1 millisecond', "timestamp") AS "timestamp", CAST("timestamp" AS DATE) AS date,
       CAST(hour("timestamp") AS INTEGER) AS hour
FROM trades"""


@query("parse_trades", _FLAT)
def parse_trades(spark, folder):
    messages = trades_to_json(b.trades(spark, folder))
    return b.naive(ingest.parse_trades(messages).drop("price_str", "quantity_str"), "timestamp")


@query(
    "trades_to_json",
    f"""WITH {TRADES}
SELECT symbol AS key, lower(symbol) || '@trade' AS stream, 'trade' AS e, epoch_us("timestamp") // 1000 AS event_ms, symbol AS s,
       trade_id AS t, price AS p, quantity AS q, is_buyer_maker AS m FROM trades""",
)
def trades_to_json_back(spark, folder):
    at = lambda path: F.get_json_object("value", f"$.{path}")
    return trades_to_json(b.trades(spark, folder)).select(
        "key",
        at("stream").alias("stream"),
        at("data.e").alias("e"),
        at("data.E").cast("long").alias("event_ms"),
        at("data.s").alias("s"),
        at("data.t").cast("long").alias("t"),
        at("data.p").cast("double").alias("p"),
        at("data.q").cast("double").alias("q"),
        at("data.m").cast("boolean").alias("m"),
    )


@query(
    "quarantine_json",
    f"""WITH {TRADES}
SELECT trade_id, status FROM trades, (VALUES ('good'), ('bad')) AS v(status)""",
)
def quarantine_json(spark, folder):
    """Every message twice, as it is and cut off before its last brace; split by one write, each part read from its folder."""
    messages = trades_to_json(b.trades(spark, folder)).select(
        F.get_json_object("value", "$.data.t").cast("long").alias("trade_id"),
        F.explode(F.array("value", F.expr("substring(value, 1, length(value) - 1)"))).alias("value"),
    )
    path = shared_dir(spark, "quarantine")
    write_split(ingest.with_status(messages), path)
    parts = [spark.read.parquet(f"{path}/status={status}").select("trade_id", F.lit(status).alias("status")) for status in ("good", "bad")]
    return parts[0].unionByName(parts[1])


@query(
    "cast_prices",
    f"""WITH {TRADES}, texts AS (
  SELECT trade_id, CAST(price AS VARCHAR) AS price_str, CAST(quantity AS VARCHAR) AS quantity_str FROM trades
  UNION ALL SELECT trade_id, 'n/a', '' FROM trades)
SELECT trade_id, TRY_CAST(price_str AS DOUBLE) AS price, TRY_CAST(quantity_str AS DOUBLE) AS quantity FROM texts""",
)
def cast_prices(spark, folder):
    trades = b.trades(spark, folder)
    good = trades.select(
        "trade_id", F.col("price").cast("string").alias("price_str"), F.col("quantity").cast("string").alias("quantity_str")
    )
    bad = trades.select("trade_id", F.lit("n/a").alias("price_str"), F.lit("").alias("quantity_str"))
    return ingest.cast_prices(good.union(bad)).select("trade_id", "price", "quantity")


@query(
    "trade_time_parts",
    f"""WITH {TRADES}
SELECT trade_id, time_bucket(INTERVAL '1 millisecond', "timestamp") AS "timestamp", CAST("timestamp" AS DATE) AS date,
       CAST(hour("timestamp") AS INTEGER) AS hour FROM trades""",
)
def trade_time_parts(spark, folder):
    ticks = b.trades(spark, folder).select("trade_id", F.unix_millis(F.col("timestamp").cast("timestamp")).alias("trade_time"))
    return b.naive(ingest.with_time_parts(ticks).drop("trade_time"), "timestamp")


# Open times as nanoseconds, plus the same ones in a wrong unit (milliseconds) and missing ones.
_TICKS = f"""{TRADES}, ticks AS (
  SELECT trade_id, epoch_us("timestamp") * 1000 AS open_time FROM trades
  UNION ALL SELECT trade_id, epoch_us("timestamp") // 1000 FROM trades
  UNION ALL SELECT trade_id, NULL FROM trades)"""
_VALID = "open_time BETWEEN 946684800000000000 AND 4102444800000000000"


def _ticks(spark, folder):
    trades = b.trades(spark, folder).select("trade_id", unix_micros(F.col("timestamp")).alias("us"))
    return trades.select(
        "trade_id",
        F.explode(
            F.array(F.col("us") * 1000, F.call_function("div", F.col("us"), F.lit(1000)), F.lit(None).cast("long"))
        ).alias("open_time"),
    )


@query("valid_timestamps", f"WITH {_TICKS} SELECT trade_id, open_time FROM ticks WHERE {_VALID}")
def valid_timestamps(spark, folder):
    return ingest.valid_timestamps(_ticks(spark, folder))


@query(
    "open_datetime",
    f"""WITH {_TICKS}
SELECT trade_id, open_time, make_timestamp(open_time // 1000000000 * 1000000) AS open_datetime,
       CAST(make_timestamp(open_time // 1000000000 * 1000000) AS DATE) AS partition_date
FROM ticks WHERE {_VALID}""",
)
def open_datetime(spark, folder):
    kept = ingest.with_open_datetime(ingest.valid_timestamps(_ticks(spark, folder)))
    return b.naive(ingest.with_partition_date(kept), "open_datetime")


@query(
    "reject_stats",
    f"""WITH {_TICKS}, n AS (SELECT count(*) AS original_count, count(*) FILTER (WHERE {_VALID}) AS kept_count FROM ticks)
SELECT original_count, kept_count, original_count - kept_count AS rejected_count,
       round((original_count - kept_count) * 100 / original_count, 2) AS rejected_pct FROM n""",
)
def reject_stats(spark, folder):
    return ingest.reject_stats(_ticks(spark, folder), is_valid_epoch(F.col("open_time"), "ns"))


@query(
    "normalize_klines",
    f"""WITH {KLINES}
SELECT symbol, open_time // 1000000 AS open_time, open, high, low, close, volume,
       {r6("quote_asset_volume")} AS quote_asset_volume, number_of_trades,
       CAST(taker_buy_base_asset_volume AS DOUBLE) AS taker_buy_base_asset_volume,
       {r6("taker_buy_quote_asset_volume")} AS taker_buy_quote_asset_volume FROM klines""",
)
def normalize_klines(spark, folder):
    klines = ingest.normalize_klines(b.kline_payloads(spark, folder))
    return b.rounded(klines, "quote_asset_volume", "taker_buy_quote_asset_volume")


# Bars of one hour: a full day has 24 of them.
@query(
    "full_day_gate",
    f"""WITH {KLINES}, n AS (SELECT *, count(*) OVER (PARTITION BY symbol, partition_date) AS bars FROM klines)
SELECT symbol, open_datetime, partition_date, open, high, low, close, volume, number_of_trades FROM n WHERE bars = 24""",
)
def full_day_gate(spark, folder):
    return ingest.full_day_gate(b.hourly_klines(spark, folder), expected=24).select(
        "symbol", "open_datetime", "partition_date", "open", "high", "low", "close", "volume", "number_of_trades"
    )


@query(
    "incomplete_days",
    f"""WITH {KLINES}
SELECT symbol, partition_date, count(*) AS kline_count FROM klines GROUP BY ALL HAVING count(*) <> 24""",
)
def incomplete_days(spark, folder):
    return ingest.incomplete_days(b.hourly_klines(spark, folder), expected=24)


@query(
    "dedup_trades",
    f"""WITH {TRADES}, sent AS (SELECT * FROM trades UNION ALL SELECT * FROM trades) SELECT DISTINCT * FROM sent""",
)
def dedup_trades(spark, folder):
    """All trades sent twice."""
    trades = b.trades(spark, folder)
    return ingest.dedup_trades(trades.unionByName(trades))


@query("source_count", f"WITH {TRADES} SELECT count(*) AS row_count FROM trades")
def source_count(spark, folder):
    return stats.source_count(b.trades(spark, folder))
