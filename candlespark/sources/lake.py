"""Scans of the kline lake, of day-partitioned tables and of candle tables."""

from __future__ import annotations

import calendar
import datetime as dt
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlespark import schemas


def _day_filter(start: dt.date, end: dt.date) -> Column:
    """Days ``start..end`` (inclusive) on the directory columns year, month, day.

    The test is written on the bare directory columns, so that Spark prunes folders without opening
    files. Whole years and months in between need no day test, hence the three nested bounds.
    """
    y, m, d = F.col("year"), F.col("month"), F.col("day")

    def after(day: dt.date) -> Column:
        return (y > day.year) | ((y == day.year) & ((m > day.month) | ((m == day.month) & (d >= day.day))))

    def before(day: dt.date) -> Column:
        return (y < day.year) | ((y == day.year) & ((m < day.month) | ((m == day.month) & (d <= day.day))))

    return after(start) & before(end)


def _range_patterns(start: dt.date, end: dt.date) -> list[str]:
    """Globs below a symbol's folder for the days ``start..end``: whole years, whole months, then days.

    Months and days are matched with and without a leading zero.
    """
    either = lambda numbers: ",".join(f"{n},{n:02d}" if n < 10 else str(n) for n in numbers)
    years, patterns = [], []
    for year in range(start.year, end.year + 1):
        first, last = max(start, dt.date(year, 1, 1)), min(end, dt.date(year, 12, 31))
        if (first.month, first.day, last.month, last.day) == (1, 1, 12, 31):
            years.append(str(year))
            continue
        whole = []
        for month in range(first.month, last.month + 1):
            length = calendar.monthrange(year, month)[1]
            low = first.day if month == first.month else 1
            high = last.day if month == last.month else length
            if (low, high) == (1, length):
                whole.append(month)
            else:
                patterns.append(f"year={year}/month={{{either([month])}}}/day={{{either(range(low, high + 1))}}}")
        if whole:
            patterns.append(f"year={year}/month={{{either(whole)}}}")
    return [f"year={{{','.join(years)}}}"] * bool(years) + patterns


def lake_folders(
    spark: SparkSession, root: str, start: dt.date | None = None, end: dt.date | None = None, symbols: list[str] | None = None
) -> list[str]:
    """The folders of the lake that hold the wanted symbols and days; only folders on the way to them are listed."""
    # Other characters than these are escaped in folder names: list the symbols then, and leave the choice to the filter.
    plain = symbols is not None and all(re.fullmatch(r"[\w.-]+", s) for s in symbols)
    symbol = f"symbol={{{','.join(symbols)}}}" if plain else "symbol=*"
    files = spark._jvm.org.apache.hadoop.fs
    system = files.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for pattern in _range_patterns(start or dt.date.min, end or dt.date.max) if symbols != [] else []:
        found += [f.getPath().toString() for f in (system.globStatus(files.Path(f"{root}/{symbol}/{pattern}")) or [])]
    return found


def scan_klines(
    spark: SparkSession,
    root: str,
    start: dt.date | None = None,
    end: dt.date | None = None,
    symbols: list[str] | None = None,
) -> DataFrame:
    """One scan over ``symbol=/year=/month=/day=`` folders, of the wanted symbols and days only.

    The folders are named to Spark, so that it lists their files and not those of the whole lake; without such folders the
    result is empty. ``open_time`` is read as a plain long, so that files with nanosecond timestamps load as well.
    """
    reader = spark.read.schema(schemas.LAKE_KLINE)
    if start is None and end is None and symbols is None:
        return reader.parquet(root)
    folders = lake_folders(spark, root, start, end, symbols)
    if not folders:
        return spark.createDataFrame([], schemas.LAKE_KLINE)
    klines = reader.option("basePath", root).parquet(*folders)
    if start is not None or end is not None:
        klines = klines.where(_day_filter(start or dt.date.min, end or dt.date.max))
    if symbols is not None:
        klines = klines.where(F.col("symbol").isin(list(symbols)))
    return klines


def symbols_in_lake(spark: SparkSession, root: str, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Symbols with a folder for any of the days, from folder names alone: no file is listed or opened."""
    names = {f.split("/symbol=")[1].split("/")[0] for f in lake_folders(spark, root, start, end)}
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    return spark.createDataFrame([(unescape(n),) for n in sorted(names)], "symbol string")


def missing_symbols(present: DataFrame, universe: DataFrame) -> DataFrame:
    """Symbols of the universe without any row: the ones a load skips."""
    return universe.join(present.select("symbol").distinct(), "symbol", "left_anti")


def table_since(
    spark: SparkSession, path: str, since: dt.date, schema: T.StructType | None = None, by: str = "partition_date"
) -> DataFrame:
    """Day-partitioned table from ``since`` on.

    With ``schema`` no file is opened to plan the scan, and columns that older files lack are null. Without
    it the schemas of all files are merged, which opens every file once.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", "true")
    return rows_since(reader.parquet(path), since, by)


def rows_since(df: DataFrame, since: dt.date, by: str = "partition_date") -> DataFrame:
    return df.where(F.col(by) >= F.lit(since))


def candles_for_symbol(candles: DataFrame, symbol: str) -> DataFrame:
    return candles.where(F.col("symbol") == symbol)
