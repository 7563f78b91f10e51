"""Lake, warehouse and feature tables: written in full, then read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from candlespark import schemas
from candlespark.catalog import bindings as b
from candlespark.catalog.registry import KLINES, TRADES, query, r6
from candlespark.catalog.windows import _BASE, _META, _RETURNS, _SENT
from candlespark.operators import ingest
from candlespark.plans import klines as plans
from candlespark.session import shared_dir
from candlespark.sinks import tables
from candlespark.sources import lake

# The whole accepted range, so that the range scans cover every row.
FIRST_DAY, LAST_DAY = dt.date(2000, 1, 1), dt.date(2100, 1, 1)
_GATED = f"""{KLINES}, gated AS (
  SELECT * FROM klines QUALIFY count(*) OVER (PARTITION BY symbol, partition_date) = 24)"""
_LAKE = f"""open_time, open, high, low, close, volume, {r6("quote_asset_volume")} AS quote_asset_volume,
  number_of_trades, CAST(taker_buy_base_asset_volume AS DOUBLE) AS taker_buy_base_asset_volume,
  {r6("taker_buy_quote_asset_volume")} AS taker_buy_quote_asset_volume, symbol"""
_PARTS = """CAST(year(open_datetime) AS INTEGER) AS year, CAST(month(open_datetime) AS INTEGER) AS month,
  CAST(day(open_datetime) AS INTEGER) AS day"""
_SUMS = ("quote_asset_volume", "taker_buy_quote_asset_volume")


def _landed(spark, folder, expected: int) -> str:
    root = shared_dir(spark, "lake")
    plans.land_klines(b.kline_payloads(spark, folder), root, expected)
    return root


def _all_days(spark, folder) -> str:
    """A lake with incomplete days as well."""
    root = shared_dir(spark, "lake")
    rows = ingest.with_lake_partitions(ingest.normalize_klines(b.kline_payloads(spark, folder)))
    tables.write_dynamic(rows, root, plans.LAKE_KEYS)
    return root


@query("land_klines", f"WITH {_GATED} SELECT {_LAKE}, {_PARTS} FROM gated")
def land_klines(spark, folder):
    """Payloads, full-day gate (24 hourly bars), partitioned write; landed twice, as a retry would."""
    root = _landed(spark, folder, 24)
    plans.land_klines(b.kline_payloads(spark, folder), root, 24)
    return b.rounded(lake.scan_klines(spark, root), *_SUMS)


@query("land_daily", f"WITH {_GATED} SELECT {_LAKE}, {_PARTS} FROM gated")
def land_daily(spark, folder):
    """Payloads of a symbol's day each: the gate is the number of klines in the payload."""
    root = shared_dir(spark, "lake")
    plans.land_klines(b.daily_payloads(spark, folder), root, 24, daily=True)
    return b.rounded(lake.scan_klines(spark, root), *_SUMS)


@query("lake_scan_day", f"WITH {KLINES} SELECT {_LAKE}, {_PARTS} FROM klines")
def lake_scan_day(spark, folder):
    """The day-range scan over the whole lake; single days and symbols are tested on their pruning."""
    root = _all_days(spark, folder)
    return b.rounded(lake.scan_klines(spark, root, FIRST_DAY, LAST_DAY), *_SUMS)


@query(
    "lake_roundtrip",
    f"""WITH {TRADES}
SELECT symbol, count(*) AS row_count, CAST(sum(CAST(price AS DECIMAL(18, 2))) AS DOUBLE) AS price_sum
FROM trades GROUP BY symbol""",
)
def lake_roundtrip(spark, folder):
    """All trades to a table partitioned by symbol, and counted from there."""
    path = shared_dir(spark, "roundtrip")
    tables.write_full(b.trades(spark, folder), path, ["symbol"])
    price = F.sum(F.col("price").cast("decimal(18,2)")).cast("double").alias("price_sum")
    counts = spark.read.parquet(path).groupBy("symbol").agg(F.count(F.lit(1)).alias("row_count"), price)
    return counts.withColumn("symbol", F.col("symbol").cast("string"))


@query(
    "missing_symbols",
    f"""WITH {KLINES}, universe AS (
  SELECT unnest(['click', 'error', 'purchase', 'signup', 'view', 'refund', 'LEOUSD']) AS symbol)
SELECT symbol FROM universe WHERE symbol NOT IN (SELECT symbol FROM klines)""",
)
def missing_symbols(spark, folder):
    return lake.missing_symbols(b.trades(spark, folder), b.event_universe(spark))


_WAREHOUSE = f"""{_LAKE}, open_datetime, CAST(year(open_datetime) AS VARCHAR) AS year,
  CAST(month(open_datetime) AS VARCHAR) AS month, CAST(day(open_datetime) AS VARCHAR) AS day, partition_date"""


def _loaded(spark, folder) -> str:
    root, target = _all_days(spark, folder), shared_dir(spark, "warehouse")
    plans.load_range(spark, root, target, FIRST_DAY, LAST_DAY, symbols=None)
    return target


@query("load_klines", f"WITH {KLINES} SELECT {_WAREHOUSE} FROM klines")
def load_klines(spark, folder):
    return b.naive(b.rounded(lake.table_since(spark, _loaded(spark, folder), FIRST_DAY, schemas.WAREHOUSE_KLINE), *_SUMS), "open_datetime")


class _FailsOnce(plans.HighWaterMark):
    """A mark whose second record is lost once, as if the job had ended between the write and the record."""

    lost: list = []

    def write(self, next_day, first_day=None, rows=None):
        if first_day is not None and self.records().count() == 2 and self.path not in self.lost:
            self.lost.append(self.path)
            raise OSError("the job ended before its commit")
        super().write(next_day, first_day, rows)


@query("incremental_load", f"WITH {KLINES} SELECT {_WAREHOUSE} FROM klines")
def incremental_load(spark, folder):
    """All days of the lake in ranges of ten days: one range fails before its commit, a second run goes on, a named day is loaded again."""
    root, table = _all_days(spark, folder), shared_dir(spark, "warehouse")
    mark = _FailsOnce.beside(spark, table)
    days = b.hourly_klines(spark, folder).agg(F.min("partition_date").alias("a"), F.max("partition_date").alias("z")).first()
    mark.write(days["a"])
    today = days["z"] + dt.timedelta(days=1)
    try:
        plans.run_incremental(spark, root, table, mark, today, days_per_write=10)
    except OSError:
        plans.run_incremental(spark, root, table, mark, today, days_per_write=10)
    plans.run_incremental(spark, root, table, mark, today, only_day=days["z"])
    return b.naive(b.rounded(lake.table_since(spark, table, days["a"], schemas.WAREHOUSE_KLINE), *_SUMS), "open_datetime")


@query(
    "load_commits",
    f"""WITH {KLINES}, span AS (SELECT min(partition_date) AS a, max(partition_date) AS z FROM klines),
ranges AS (SELECT CAST(unnest(generate_series(a, z, INTERVAL '10 days')) AS DATE) AS first_day, z FROM span)
SELECT first_day, CAST(least(first_day + 10, z + 1) AS DATE) AS next_day, count(symbol) AS rows, CAST(0 AS BIGINT) AS lost
FROM ranges LEFT JOIN klines ON partition_date >= first_day AND partition_date < first_day + 10 GROUP BY ALL""",
)
def load_commits(spark, folder):
    """The commit records of an incremental load, with the rows that the table lacks of them."""
    root, table = _all_days(spark, folder), shared_dir(spark, "warehouse")
    mark = plans.HighWaterMark.beside(spark, table)
    days = b.hourly_klines(spark, folder).agg(F.min("partition_date").alias("a"), F.max("partition_date").alias("z")).first()
    mark.write(days["a"])
    plans.run_incremental(spark, root, table, mark, days["z"] + dt.timedelta(days=1), days_per_write=10)
    records = mark.records().where("first_day IS NOT NULL")
    lost = plans.unmatched_commits(records, lake.table_since(spark, table, days["a"], schemas.WAREHOUSE_KLINE))
    lost = lost.select("first_day", (F.col("rows") - F.col("held")).alias("lost"))
    return records.join(lost, "first_day", "left").select("first_day", "next_day", "rows", F.coalesce("lost", F.lit(0)).alias("lost"))


@query(
    "klines_since",
    f"""WITH {KLINES} SELECT symbol, open_datetime, partition_date, close FROM klines
WHERE partition_date >= DATE '2024-01-01'""",
)
def klines_since(spark, folder):
    rows = lake.table_since(spark, _loaded(spark, folder), plans.FEATURES_SINCE, schemas.WAREHOUSE_KLINE)
    return b.naive(rows.select("symbol", "open_datetime", "partition_date", "close"), "open_datetime")


@query(
    "load_report",
    f"""WITH {KLINES}
SELECT symbol, count(*) AS original_count, count(*) AS kept_count, CAST(0 AS BIGINT) AS rejected_count,
       CAST(0 AS DOUBLE) AS rejected_pct FROM klines GROUP BY symbol""",
)
def load_report(spark, folder):
    return plans.load_report(b.hourly_klines(spark, folder))


@query(
    "features_table",
    f"""WITH {_RETURNS}, {_META}, {_SENT}
SELECT {_BASE}, {r6('log_return')} AS log_return, {r6('sma_24h')} AS sma_24h,
       {r6('volatility_24h')} AS volatility_24h, coin_name, consensus, sentiment_score
FROM features LEFT JOIN metadata USING (symbol) LEFT JOIN sentiment USING (partition_date, symbol)""",
)
def features_table(spark, folder):
    """Lake to warehouse table to feature table, read back from the last one."""
    target = shared_dir(spark, "features")
    plans.build_features(spark, _loaded(spark, folder), target, b.event_metadata(spark), b.event_sentiment(spark))
    rows = spark.read.parquet(target).select(
        *[c.strip() for c in _BASE.split(",")],
        *["log_return", "sma_24h", "volatility_24h", "coin_name", "consensus", "sentiment_score"],
    )
    return b.naive(b.rounded(rows, "log_return", "sma_24h", "volatility_24h"), "open_datetime")


@query(
    "pending_days",
    f"""WITH {KLINES}, span AS (SELECT min(partition_date) AS a, max(partition_date) AS z FROM klines),
days AS (SELECT CAST(unnest(generate_series(a, z, INTERVAL '1 day')) AS DATE) AS day FROM span)
SELECT day, count(symbol) AS klines_waiting FROM days LEFT JOIN klines ON day = partition_date GROUP BY day""",
)
def pending_days(spark, folder):
    """Days from the first one of the data up to the last, with the rows that wait for a load."""
    klines = b.hourly_klines(spark, folder).select("symbol", "partition_date")
    span = klines.agg(F.min("partition_date").alias("a"), F.max("partition_date").alias("z")).first()
    days = plans.pending_days(spark, span["a"], span["z"] + dt.timedelta(days=1))
    waiting = klines.groupBy("partition_date").agg(F.count(F.lit(1)).alias("n"))
    return days.join(waiting, F.col("day") == F.col("partition_date"), "left").select(
        "day", F.coalesce("n", F.lit(0)).alias("klines_waiting")
    )
