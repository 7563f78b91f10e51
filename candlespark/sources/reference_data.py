"""Inline relations: the symbol universe, coin metadata and sample sentiment."""

from __future__ import annotations

import datetime as dt

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from candlespark import schemas

# Symbols of the batch jobs.
BATCH_SYMBOLS = (
    "BTCUSDT", "ETHUSDT", "SOLUSDT", "BNBUSDT", "DOGEUSDT",
    "XRPUSDT", "PEPEUSDT", "TONUSDT", "SHIBUSDT", "DOTUSDT",
    "ADAUSDT", "AVAXUSDT", "LINKUSDT", "TRXUSDT", "MATICUSDT",
    "BCHUSDT", "ICPUSDT", "NEARUSDT", "LTCUSDT", "LEOUSD",
    "UNIUSDT", "FETUSDT", "RNDRUSDT", "ATOMUSDT", "INJUSDT",
    "WIFUSDT", "OPUSDT", "ARBUSDT", "ETCUSDT", "FILUSDT",
)
# The stream carries no LEOUSD.
STREAM_SYMBOLS = tuple(s for s in BATCH_SYMBOLS if s != "LEOUSD")

# Coin metadata rows.
COIN_ROWS = (
    ("BTCUSDT", "Bitcoin", "PoW"),
    ("ETHUSDT", "Ethereum", "PoS"),
    ("SOLUSDT", "Solana", "PoS"),
    ("BNBUSDT", "BNB", "PoSA"),
)
# Sentiment rows.
SENTIMENT_ROWS = (
    (dt.date(2024, 1, 1), "BTCUSDT", 0.35),
    (dt.date(2024, 1, 1), "ETHUSDT", 0.21),
)


def inline(spark: SparkSession, rows, schema: T.StructType) -> DataFrame:
    """A few literal rows as a relation of known size (rows given as tuples would have no size estimate)."""
    columns = zip(*rows, strict=True) if rows else [() for _ in schema.names]
    table = pa.table(
        [pa.array(list(values), to_arrow_type(f.dataType)) for f, values in zip(schema.fields, columns, strict=True)],
        schema.names,
    )
    return spark.createDataFrame(table, schema)


def symbol_universe(spark: SparkSession, symbols=BATCH_SYMBOLS) -> DataFrame:
    return inline(spark, [(s,) for s in symbols], T.StructType([T.StructField("symbol", T.StringType())]))


def coin_metadata(spark: SparkSession, rows=COIN_ROWS) -> DataFrame:
    return inline(spark, rows, schemas.COIN_METADATA)


def sentiment(spark: SparkSession, rows=SENTIMENT_ROWS) -> DataFrame:
    return inline(spark, rows, schemas.SENTIMENT)


def stream_names(symbols=STREAM_SYMBOLS) -> list[str]:
    """Subscription names such as ``btcusdt@trade``."""
    return [f"{s.strip().lower()}@trade" for s in symbols]
