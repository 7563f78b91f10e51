"""Parsing, typing, filtering and gating of raw trades and klines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlespark import schemas
from candlespark.functions.numeric import to_double
from candlespark.functions.time import epoch_to_timestamp, epoch_to_whole_seconds, is_valid_epoch


def _message(value: str) -> Column:
    return F.from_json(
        F.col(value).cast("string"),
        schemas.TRADE_MESSAGE,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"},
    )


def _flag(text: Column) -> Column:
    return F.when(text == "true", True).when(text == "false", False)


def parse_trades(messages: DataFrame, value: str = "value") -> DataFrame:
    """JSON messages to flat trades; a malformed message becomes a row of nulls."""
    field = lambda k: F.element_at("data", F.lit(k))
    flat = messages.select(_message(value).alias("m")).select("m.stream", "m.data")
    trades = flat.select(
        "stream",
        field("e").alias("event_type"),
        field("E").try_cast("long").alias("event_time"),
        field("s").alias("symbol"),
        field("t").try_cast("long").alias("trade_id"),
        field("p").alias("price_str"),
        field("q").alias("quantity_str"),
        field("T").try_cast("long").alias("trade_time"),
        _flag(field("m")).alias("is_buyer_maker"),
    )
    return with_time_parts(cast_prices(trades))


def cast_prices(trades: DataFrame) -> DataFrame:
    """Price and quantity text to double; bad text gives null, the row stays."""
    return trades.withColumns({"price": to_double(F.col("price_str")), "quantity": to_double(F.col("quantity_str"))})


def with_time_parts(trades: DataFrame, ticks: str = "trade_time", unit: str = "ms") -> DataFrame:
    """Adds ``timestamp``, ``date`` and ``hour`` from an epoch count."""
    ts = epoch_to_timestamp(F.col(ticks), unit)
    return trades.withColumns({"timestamp": ts, "date": F.to_date(ts), "hour": F.hour(ts)})


def is_malformed(value: str = "value") -> Column:
    """True where the text is no JSON object at all."""
    parsed = _message(value)
    return parsed.isNull() | parsed["_corrupt_record"].isNotNull()


def with_status(messages: DataFrame, value: str = "value", name: str = "status") -> DataFrame:
    """Adds ``good`` or ``bad`` to every message, from one parse; a sink splits by it (see ``sinks.tables.write_split``)."""
    return messages.withColumn(name, F.when(is_malformed(value), "bad").otherwise("good"))


def quarantine(messages: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Split into readable messages and unreadable ones; every message is in exactly one part.

    Each part parses its input. To have both from one scan and one parse, write ``with_status`` split by status.
    """
    return messages.where(~is_malformed(value)), messages.where(is_malformed(value))


def normalize_klines(payloads: DataFrame, payload: str = "payload", expected: int | None = None) -> DataFrame:
    """Kline arrays to named columns. ``payload`` is JSON text: an array of 12-item arrays.

    Numeric text that does not parse becomes null. ``open_time`` stays in the payload's milliseconds. With ``expected`` only
    payloads of that many klines count: the gate for payloads that hold a day each, without a shuffle.
    """
    parsed = F.from_json(payload, schemas.KLINE_PAYLOAD)
    if expected is not None:
        # Inside the generator, where the payload is parsed once; a filter would be pushed down and parse it again.
        parsed = F.get(F.filter(F.array(parsed), lambda klines: F.size(klines) == expected), F.lit(0))
    klines = payloads.withColumn("_k", F.explode(parsed))
    at = {name: F.get("_k", F.lit(i)) for i, name in enumerate(schemas.KLINE_POSITIONS)}
    number = lambda name: to_double(at[name]).alias(name)
    return klines.select(
        "symbol",
        at["open_time"].try_cast("long").alias("open_time"),
        *[number(c) for c in ("open", "high", "low", "close", "volume", "quote_asset_volume")],
        at["number_of_trades"].try_cast("long").alias("number_of_trades"),
        to_double(at["taker_buy_base"]).alias("taker_buy_base_asset_volume"),
        to_double(at["taker_buy_quote"]).alias("taker_buy_quote_asset_volume"),
    )


def with_lake_partitions(klines: DataFrame, unit: str = "ms") -> DataFrame:
    """Adds ``year, month, day`` of the open time, and turns the open time into lake nanoseconds."""
    ts = epoch_to_timestamp(F.col("open_time"), unit)
    return klines.withColumns(
        {
            "year": F.year(ts),
            "month": F.month(ts),
            "day": F.dayofmonth(ts),
            "open_time": F.unix_micros(ts) * 1_000,
        }
    )


def valid_timestamps(df: DataFrame, ticks: str = "open_time", unit: str = "ns") -> DataFrame:
    return df.where(is_valid_epoch(F.col(ticks), unit))


def with_open_datetime(df: DataFrame, ticks: str = "open_time", unit: str = "ns") -> DataFrame:
    """Adds ``open_datetime`` in whole seconds and drops rows where the conversion gives null."""
    ts = epoch_to_whole_seconds(F.col(ticks), unit)
    return df.withColumn("open_datetime", ts).where(F.col("open_datetime").isNotNull())


def with_partition_date(df: DataFrame, ts: str = "open_datetime") -> DataFrame:
    return df.withColumn("partition_date", F.to_date(ts))


def reject_stats(df: DataFrame, keep: Column, by: list[str] | None = None) -> DataFrame:
    """Rows before and after a filter in one aggregate pass: counts and the rejected share in percent."""
    kept = F.count_if(keep)
    total = F.count(F.lit(1))
    share = F.when(total > 0, F.round((total - kept) * 100 / total, 2))
    return df.groupBy(*(by or [])).agg(
        total.alias("original_count"),
        kept.alias("kept_count"),
        (total - kept).alias("rejected_count"),
        share.alias("rejected_pct"),
    )


def rows_per_day(df: DataFrame, key: str = "symbol", day: str = "partition_date") -> DataFrame:
    return df.groupBy(key, day).agg(F.count(F.lit(1)).alias("kline_count"))


def full_day_gate(df: DataFrame, key: str = "symbol", day: str = "partition_date", expected: int = 1440) -> DataFrame:
    """Keep the symbol-days with exactly ``expected`` rows.

    The counts are aggregated first (a few bytes per symbol-day) and semi-joined back, so the rows
    themselves need no sort, and a symbol-day with far too many rows is never gathered in one task.
    """
    complete = rows_per_day(df, key, day).where(F.col("kline_count") == expected)
    return df.join(complete.select(key, day), [key, day], "left_semi")


def incomplete_days(df: DataFrame, key: str = "symbol", day: str = "partition_date", expected: int = 1440) -> DataFrame:
    return rows_per_day(df, key, day).where(F.col("kline_count") != expected)


def dedup_trades(trades: DataFrame, watermark: str | None = None) -> DataFrame:
    """One row per ``(symbol, trade_id)``: removes messages a producer sent twice (the copies are equal).

    On a stream with a watermark the remembered keys are dropped after the watermark delay.
    """
    if trades.isStreaming and watermark:
        return trades.withWatermark("timestamp", watermark).dropDuplicatesWithinWatermark(["symbol", "trade_id"])
    return trades.dropDuplicates(["symbol", "trade_id"])
