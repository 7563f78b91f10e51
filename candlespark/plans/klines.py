"""Landing, loading and feature jobs over daily klines, with a high-water mark."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from candlespark import schemas
from candlespark.functions.time import epoch_to_timestamp, is_valid_epoch
from candlespark.operators.blocks import KLINES, Series
from candlespark.operators.enrich import enrich
from candlespark.operators.features import window_features
from candlespark.operators.ingest import (
    full_day_gate,
    normalize_klines,
    reject_stats,
    valid_timestamps,
    with_lake_partitions,
    with_open_datetime,
    with_partition_date,
)
from candlespark.sinks.tables import write_dynamic, write_full
from candlespark.sources.lake import rows_since, scan_klines, table_since

LAKE_KEYS = ["symbol", "year", "month", "day"]
TABLE_KEYS = ["partition_date", "symbol"]
FEATURES_SINCE = dt.date(2024, 1, 1)  # fixed value: first day of the feature job
DEFAULT_LAG_DAYS = 7  # fixed value: start of a job without a mark


# --- landing -----------------------------------------------------------------------------------------


def lake_rows(payloads: DataFrame, expected: int = 1440, unit: str = "ms", daily: bool = False) -> DataFrame:
    """Kline payloads to lake rows: normalised, full days only, with directory columns.

    ``daily`` says that each payload holds one symbol's whole day: its number of klines is the gate then, and nothing is
    shuffled or read twice. Otherwise the klines of a symbol and day are counted over all payloads.
    """
    if daily:
        return with_lake_partitions(normalize_klines(payloads, expected=expected), unit)
    klines = normalize_klines(payloads)
    dated = klines.withColumn("_day", F.to_date(epoch_to_timestamp(F.col("open_time"), unit)))
    gated = full_day_gate(dated, day="_day", expected=expected).drop("_day")
    return with_lake_partitions(gated, unit)


def land_klines(payloads: DataFrame, root: str, expected: int = 1440, daily: bool = False) -> None:
    write_dynamic(lake_rows(payloads, expected, daily=daily), root, LAKE_KEYS)


# --- loading -----------------------------------------------------------------------------------------


def warehouse_rows(lake: DataFrame, unit: str = "ns") -> DataFrame:
    """Lake rows to warehouse rows: valid open times only, typed time, text date parts, partition date.

    ``year, month, day`` are those of the folder the row was read from.
    """
    typed = with_partition_date(with_open_datetime(valid_timestamps(lake, unit=unit), unit=unit))
    parts = {c: F.col(c).cast("string") for c in ("year", "month", "day")}
    return typed.withColumns(parts).select(*schemas.WAREHOUSE_KLINE.names)


def load_range(
    spark: SparkSession, lake_root: str, table: str, start: dt.date, end: dt.date, symbols=None
) -> int:
    """Load the days ``start..end`` with one pruned scan and one write: all symbols of the lake, or only ``symbols``.

    Returns the number of rows written, counted by the write itself.
    """
    lake = scan_klines(spark, lake_root, start, end, list(symbols) if symbols is not None else None)
    written = Observation()
    write_dynamic(warehouse_rows(lake).observe(written, F.count(F.lit(1)).alias("rows")), table, TABLE_KEYS)
    return written.get["rows"]


def load_report(lake: DataFrame, unit: str = "ns") -> DataFrame:
    """Per symbol: rows read, kept and rejected by the timestamp check."""
    return reject_stats(lake, is_valid_epoch(F.col("open_time"), unit), ["symbol"])


# --- features ----------------------------------------------------------------------------------------


def feature_rows(
    klines: DataFrame,
    metadata: DataFrame,
    sentiment: DataFrame,
    since: dt.date = FEATURES_SINCE,
    series: Series = KLINES,
) -> DataFrame:
    """Date filter first, then windows (so the first rows have short frames), then the two joins."""
    return enrich(window_features(rows_since(klines, since), series=series), metadata, sentiment)


def build_features(
    spark: SparkSession,
    table: str,
    target: str,
    metadata: DataFrame,
    sentiment: DataFrame,
    since: dt.date = FEATURES_SINCE,
    series: Series = KLINES,
) -> None:
    klines = table_since(spark, table, since, schemas.WAREHOUSE_KLINE)
    write_full(feature_rows(klines, metadata, sentiment, since, series), target, ["partition_date"])


# --- high-water mark ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class HighWaterMark:
    """Next day to load, kept as a small append-only dataset of commit records; the newest one counts.

    A record says which days a range wrote, how many rows, and where the next one starts. By default (``beside``) the records
    lie in the table's own folder, hidden from its readers, so that table and mark are copied, restored and removed together.
    """

    spark: SparkSession
    path: str

    @classmethod
    def beside(cls, spark: SparkSession, table: str) -> HighWaterMark:
        return cls(spark, f"{table.rstrip('/')}/_commits")

    def records(self) -> DataFrame:
        """All commit records; none before the first."""
        try:
            return self.spark.read.schema(schemas.HIGH_WATER_MARK).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schemas.HIGH_WATER_MARK)

    def _last(self) -> tuple[int, dt.date | None]:
        row = self.records().agg(F.max("seq").alias("seq"), F.max_by("next_day", "seq").alias("day")).first()
        return row["seq"] or 0, row["day"]

    def read(self, today: dt.date, default_lag: int = DEFAULT_LAG_DAYS) -> dt.date:
        return self._last()[1] or today - dt.timedelta(days=default_lag)

    def write(self, next_day: dt.date, first_day: dt.date | None = None, rows: int | None = None) -> None:
        seq = self._last()[0] + 1
        entry = self.spark.createDataFrame([(seq, first_day, next_day, rows)], schemas.HIGH_WATER_MARK)
        entry.coalesce(1).write.mode("append").parquet(self.path)


def unmatched_commits(records: DataFrame, table: DataFrame) -> DataFrame:
    """Commit records whose days hold fewer rows in the table than were written: days lost or replaced since.

    The newest record of a range counts. One row per day of the table meets the records, no kline.
    """
    newest = records.where("first_day IS NOT NULL").groupBy("first_day", "next_day").agg(F.max_by("rows", "seq").alias("rows"))
    days = newest.withColumn("day", F.explode(F.sequence("first_day", F.date_sub("next_day", 1))))
    held = table.groupBy(F.col("partition_date").alias("day")).agg(F.count(F.lit(1)).alias("held"))
    found = days.join(held, "day", "left").groupBy("first_day", "next_day", "rows").agg(F.coalesce(F.sum("held"), F.lit(0)).alias("held"))
    return found.where("held < rows")


def pending_days(spark: SparkSession, start: dt.date, today: dt.date) -> DataFrame:
    """Days still to load: ``start`` to yesterday; empty when there are none."""
    count = max(0, (today - start).days)
    return spark.range(count).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("day"))


def run_incremental(
    spark: SparkSession,
    lake_root: str,
    table: str,
    mark: HighWaterMark,
    today: dt.date,
    only_day: dt.date | None = None,
    symbols=None,
    days_per_write: int = 31,
) -> dt.date | None:
    """Load the pending days; returns the last loaded day.

    Days are loaded in ranges: one pruned scan and one write per range, after which a commit record moves the mark to the
    day behind it. A failure, also one between the write and the record, is raised and leaves the mark in front of the
    failed range; a retry replaces the same partitions. ``only_day`` loads that day and does not move the mark.
    Without ``symbols`` every symbol of the days is loaded; with them the mark moves past the other symbols' rows.
    """
    if only_day is not None:
        load_range(spark, lake_root, table, only_day, only_day, symbols)
        return only_day
    start, last = mark.read(today), today - dt.timedelta(days=1)
    done = None
    while start <= last:
        end = min(last, start + dt.timedelta(days=days_per_write - 1))
        rows = load_range(spark, lake_root, table, start, end, symbols)
        mark.write(end + dt.timedelta(days=1), start, rows)
        done, start = end, end + dt.timedelta(days=1)
    return done
