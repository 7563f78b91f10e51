"""Trade message sources and sinks: broker options, and files as the offline stand-in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_OFFSETS_PER_TRIGGER = 50_000  # fixed value: default admission limit of the broker source


def broker_read_options(servers: str, topic: str, max_offsets: int | None = MAX_OFFSETS_PER_TRIGGER) -> dict[str, str]:
    """Options of ``readStream.format("kafka")``; ``max_offsets=None`` admits all that waits.

    The connector is not part of plain Spark.
    """
    limit = {} if max_offsets is None else {"maxOffsetsPerTrigger": str(max_offsets)}
    return {
        **limit,
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }


def broker_write_options(servers: str, topic: str) -> dict[str, str]:
    """Options of ``writeStream.format("kafka")``: compressed batches, short linger, retries."""
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.linger.ms": "20",
        "kafka.batch.size": str(32 * 1024),
        "kafka.compression.type": "gzip",
        "kafka.retries": "5",
    }


def read_broker(spark: SparkSession, servers: str, topic: str, max_offsets: int | None = MAX_OFFSETS_PER_TRIGGER) -> DataFrame:
    return spark.readStream.format("kafka").options(**broker_read_options(servers, topic, max_offsets)).load()


def read_message_files(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stream of ``value`` rows, one JSON message per text line."""
    reader = spark.readStream.schema("value string")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(files_per_trigger))
    return reader.format("text").load(path)


def trades_to_json(trades: DataFrame, *extra: Column) -> DataFrame:
    """Trades as broker rows: ``key`` is the symbol, ``value`` the JSON message; ``extra`` columns of the trades after them."""
    text = lambda c: F.col(c).cast("string")
    millis = F.unix_millis(F.col("timestamp").cast("timestamp"))
    data = F.struct(
        F.lit("trade").alias("e"),
        millis.alias("E"),
        F.col("symbol").alias("s"),
        F.col("trade_id").alias("t"),
        text("price").alias("p"),
        text("quantity").alias("q"),
        millis.alias("T"),
        F.col("is_buyer_maker").alias("m"),
        F.lit(True).alias("M"),
    )
    stream = F.concat(F.lower(F.trim("symbol")), F.lit("@trade"))
    return trades.select(
        F.col("symbol").alias("key"),
        F.to_json(F.struct(stream.alias("stream"), data.alias("data"))).alias("value"),
        *extra,
    )
