import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from candlespark import schemas
from candlespark.operators import enrich, features
from candlespark.operators.blocks import Series
from candlespark.plans import klines as plans
from candlespark.session import shared_dir
from candlespark.sinks import candle_log, tables
from candlespark.sources import lake
from candlespark.sources.reference_data import BATCH_SYMBOLS, STREAM_SYMBOLS, coin_metadata, sentiment, stream_names, symbol_universe

DAY = dt.date(2024, 1, 1)
NS = 1_000_000_000


def lake_rows(spark, days=3, symbols=("BTCUSDT", "ETHUSDT", "DOGEUSDT"), bars=4, close=1.0):
    start = int(dt.datetime(2024, 1, 1, tzinfo=dt.UTC).timestamp())
    data = [
        ((start + d * 86400 + i * 3600) * NS, 1.0, 2.0, 0.5, close + i, 10.0, 5.0, 3, 1.0, 2.0, s, 2024, 1, 1 + d)
        for s in symbols
        for d in range(days)
        for i in range(bars)
    ]
    return spark.createDataFrame(data, schemas.LAKE_KLINE)


@pytest.fixture
def lake_root(spark):
    root = shared_dir(spark, "lake")
    tables.write_dynamic(lake_rows(spark), root, plans.LAKE_KEYS)
    return root


class FakeSession:
    """A session that only answers for its settings."""

    def __init__(self, master, folder=None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master})


def test_shared_dir_reads_the_session_setting():
    assert shared_dir(FakeSession("yarn", "hdfs://nn/shared/"), "x").startswith("hdfs://nn/shared/x-")
    assert shared_dir(FakeSession("local[2]"), "x").startswith("/tmp/run-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(FakeSession("yarn"), "x")


def test_lake_scan_prunes_folders_and_columns(spark, lake_root, plan):
    day = lake.scan_klines(spark, lake_root, DAY, DAY, ["BTCUSDT"]).select("close")
    assert day.count() == 4
    text = plan(day)
    assert "PartitionFilters: [" in text and "year" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert "ReadSchema: struct<close:double>" in text
    files = day.select(F.input_file_name().alias("f")).distinct().collect()
    assert all("symbol=BTCUSDT/year=2024/month=1/day=1/" in r.f for r in files)


def test_day_ranges_cross_months_and_years(spark):
    root = shared_dir(spark, "lake")
    days = [dt.date(2023, 12, 30) + dt.timedelta(days=i) for i in range(40)]
    rows = [(1, *[1.0] * 6, 1, 1.0, 1.0, "A", d.year, d.month, d.day) for d in days]
    tables.write_dynamic(spark.createDataFrame(rows, schemas.LAKE_KLINE), root, plans.LAKE_KEYS)
    for start, end in ((days[0], days[-1]), (days[1], days[3]), (dt.date(2024, 1, 31), dt.date(2024, 2, 2))):
        got = {dt.date(r.year, r.month, r.day) for r in lake.scan_klines(spark, root, start, end).collect()}
        assert got == {d for d in days if start <= d <= end}


def test_only_wanted_folders_are_listed(spark, plan):
    root = shared_dir(spark, "lake")
    days = [dt.date(2023, 11, 29) + dt.timedelta(days=i) for i in range(70)]
    rows = [(1, *[1.0] * 6, 1, 1.0, 1.0, symbol, d.year, d.month, d.day) for d in days for symbol in ("A", "B/c", None)]
    tables.write_dynamic(spark.createDataFrame(rows, schemas.LAKE_KLINE), root, plans.LAKE_KEYS)
    listed = lambda df: int(re.search(r"InMemoryFileIndex\((\d+) paths?\)", plan(df)).group(1))
    one = lake.scan_klines(spark, root, days[1], days[1], ["A"])
    assert listed(one) == 1 and one.count() == 1
    # One day of November, December as a month, and the days of January, per symbol.
    some = lake.scan_klines(spark, root, days[1], dt.date(2024, 1, 4))
    assert listed(some) == 3 * (1 + 1 + 4) and some.count() == 3 * 36
    assert listed(lake.scan_klines(spark, root, dt.date(2023, 1, 1), dt.date(2024, 12, 31))) == 3 * 2
    assert lake.scan_klines(spark, root, days[0], days[-1], ["B/c"]).count() == 70
    assert lake.scan_klines(spark, root, dt.date(2030, 1, 1), None).count() == 0 == lake.scan_klines(spark, root, symbols=[]).count()
    got = {r.symbol for r in lake.symbols_in_lake(spark, root, days[0], days[0]).collect()}
    assert got == {"A", "B/c", "__HIVE_DEFAULT_PARTITION__"}


def test_months_with_a_leading_zero(spark, tmp_path):
    for name in ("month=02/day=03", "month=2/day=4", "month=12/day=05"):
        spark.range(1).select(F.lit(1.0).alias("close")).write.parquet(str(tmp_path / "symbol=A" / "year=2024" / name))
    got = lake.scan_klines(spark, str(tmp_path), dt.date(2024, 2, 2), dt.date(2024, 2, 5), ["A"])
    assert sorted((r.month, r.day) for r in got.collect()) == [(2, 3), (2, 4)]
    assert lake.scan_klines(spark, str(tmp_path), dt.date(2024, 2, 1), dt.date(2024, 12, 5)).count() == 3


def test_nanosecond_files_are_read_as_long(spark, tmp_path):
    import pandas as pd

    frame = pd.DataFrame({"open_time": pd.to_datetime([1704067200000], unit="ms").astype("datetime64[ns]"), "close": [1.5]})
    path = tmp_path / "symbol=A" / "year=2024" / "month=1" / "day=1"
    path.mkdir(parents=True)
    frame.to_parquet(path / "part.parquet")
    row = plans.warehouse_rows(lake.scan_klines(spark, str(tmp_path))).first()
    assert row.open_time == 1704067200 * NS and str(row.partition_date) == "2024-01-01"
    assert (row.symbol, row.year, row.month, row.day, row.open) == ("A", "2024", "1", "1", None)


def test_missing_symbols(spark, lake_root):
    present = lake.scan_klines(spark, lake_root, DAY, DAY)
    missing = {r.symbol for r in lake.missing_symbols(present, symbol_universe(spark)).collect()}
    assert missing == set(BATCH_SYMBOLS) - {"BTCUSDT", "ETHUSDT", "DOGEUSDT"}
    assert len(BATCH_SYMBOLS) == 30 and len(STREAM_SYMBOLS) == 29 and stream_names()[0] == "btcusdt@trade"


def test_loading_twice_changes_nothing(spark, lake_root):
    table = shared_dir(spark, "warehouse")
    for _ in range(2):
        plans.load_range(spark, lake_root, table, DAY, DAY + dt.timedelta(days=1))
    assert lake.table_since(spark, table, DAY).count() == 3 * 2 * 4
    # A later load of one symbol leaves the others of that day alone.
    plans.load_range(spark, lake_root, table, DAY, DAY, ["BTCUSDT"])
    assert lake.table_since(spark, table, DAY).count() == 3 * 2 * 4


def test_added_columns_are_read_from_old_and_new_files(spark, lake_root):
    table = shared_dir(spark, "warehouse")
    plans.load_range(spark, lake_root, table, DAY, DAY)
    later = plans.warehouse_rows(lake.scan_klines(spark, lake_root, DAY + dt.timedelta(days=1)))
    tables.write_dynamic(later.withColumn("extra", F.lit(1)), table, plans.TABLE_KEYS)
    rows = lake.table_since(spark, table, DAY)
    assert rows.where("extra IS NULL").count() == 12 and rows.where("extra = 1").count() == 24


def test_table_since_prunes_partitions(spark, lake_root, plan):
    table = shared_dir(spark, "warehouse")
    plans.load_range(spark, lake_root, table, DAY, DAY + dt.timedelta(days=2))
    text = plan(lake.table_since(spark, table, DAY + dt.timedelta(days=1), schemas.WAREHOUSE_KLINE).select("close"))
    assert "PartitionFilters: [isnotnull(partition_date" in text and "ReadSchema: struct<close:double>" in text


def test_feature_table_has_metadata_and_sentiment(spark, lake_root):
    table, target = shared_dir(spark, "warehouse"), shared_dir(spark, "features")
    plans.load_range(spark, lake_root, table, DAY, DAY + dt.timedelta(days=2))
    for _ in range(2):
        plans.build_features(spark, table, target, coin_metadata(spark), sentiment(spark))
    rows = spark.read.parquet(target)
    assert rows.count() == 36
    got = {(r.symbol, str(r.partition_date)): (r.coin_name, r.sentiment_score) for r in rows.collect()}
    assert got[("BTCUSDT", "2024-01-01")] == ("Bitcoin", 0.35)
    assert got[("ETHUSDT", "2024-01-02")] == ("Ethereum", None)
    assert got[("DOGEUSDT", "2024-01-01")] == (None, None)


def test_join_plans(spark, lake_root, plan):
    rows = plans.warehouse_rows(lake.scan_klines(spark, lake_root))
    meta = enrich.join_metadata(rows, coin_metadata(spark))
    assert "BroadcastHashJoin" in plan(meta) and "Exchange hashpartitioning" not in plan(meta)
    assert "SortMergeJoin" in plan(enrich.join_sentiment(rows, sentiment(spark), "merge"))
    assert enrich.enrich(rows, coin_metadata(spark), sentiment(spark)).columns[:2] == ["partition_date", "symbol"]
    large = spark.range(10**9).select(F.col("id").cast("string").alias("symbol"), F.lit("x").alias("coin_name"))
    assert "BroadcastHashJoin" not in plan(enrich.join_metadata(rows, large))


# --- high-water mark ---------------------------------------------------------------------------------


def test_mark_moves_only_over_loaded_days(spark, lake_root, monkeypatch):
    table, mark = shared_dir(spark, "warehouse"), plans.HighWaterMark(spark, shared_dir(spark, "mark"))
    today = DAY + dt.timedelta(days=3)
    assert mark.read(today) == today - dt.timedelta(days=7)
    mark.write(DAY)
    real, loaded = plans.load_range, []

    def failing(spark_, root, target, start, end, symbols):
        if start > DAY:
            raise OSError("disk full")
        loaded.append(start)
        real(spark_, root, target, start, end, symbols)

    monkeypatch.setattr(plans, "load_range", failing)
    with pytest.raises(OSError):
        plans.run_incremental(spark, lake_root, table, mark, today, days_per_write=1)
    assert loaded == [DAY] and mark.read(today) == DAY + dt.timedelta(days=1)
    monkeypatch.setattr(plans, "load_range", real)
    assert plans.run_incremental(spark, lake_root, table, mark, today) == DAY + dt.timedelta(days=2)
    assert mark.read(today) == today and lake.table_since(spark, table, DAY).count() == 36
    assert plans.run_incremental(spark, lake_root, table, mark, today) is None


def test_commit_records_go_with_the_table(spark, lake_root):
    table = shared_dir(spark, "warehouse")
    mark = plans.HighWaterMark.beside(spark, table)
    today = DAY + dt.timedelta(days=3)
    mark.write(DAY)
    plans.run_incremental(spark, lake_root, table, mark, today, days_per_write=2)
    got = [tuple(r) for r in mark.records().orderBy("seq").collect()]
    second = DAY + dt.timedelta(days=2)
    assert got == [(1, None, DAY, None), (2, DAY, second, 24), (3, second, today, 12)]
    rows = lake.table_since(spark, table, DAY, schemas.WAREHOUSE_KLINE)
    assert rows.count() == 36  # the records are no rows of the table
    assert plans.unmatched_commits(mark.records(), rows).isEmpty()
    (lost,) = plans.unmatched_commits(mark.records(), rows.where(F.col("partition_date") != second)).collect()
    assert (lost.first_day, lost.rows, lost.held) == (second, 12, 0)


def test_symbols_outside_the_fixed_list_are_loaded(spark):
    root, table, mark = shared_dir(spark, "lake"), shared_dir(spark, "warehouse"), plans.HighWaterMark(spark, shared_dir(spark, "mark"))
    open_time = int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp()) * 10**9
    rows = [(open_time, *[1.0] * 6, 1, 1.0, 1.0, symbol, 2024, 1, 1) for symbol in ("BTCUSDT", "NEWUSDT")]
    tables.write_dynamic(spark.createDataFrame(rows, schemas.LAKE_KLINE), root, plans.LAKE_KEYS)
    mark.write(DAY)
    plans.run_incremental(spark, root, table, mark, DAY + dt.timedelta(days=1))
    loaded = lake.table_since(spark, table, DAY)
    assert {r.symbol for r in loaded.collect()} == {"BTCUSDT", "NEWUSDT"}
    assert {"BTCUSDT", "NEWUSDT"} <= set(features.hourly_pivot(loaded).columns)


def test_a_named_day_does_not_move_the_mark(spark, lake_root):
    table, mark = shared_dir(spark, "warehouse"), plans.HighWaterMark(spark, shared_dir(spark, "mark"))
    mark.write(DAY)
    only = DAY + dt.timedelta(days=2)
    assert plans.run_incremental(spark, lake_root, table, mark, DAY + dt.timedelta(days=3), only_day=only) == only
    assert mark.read(DAY) == DAY and lake.table_since(spark, table, DAY).count() == 12


def test_pending_days(spark):
    got = [r.day for r in plans.pending_days(spark, DAY, DAY + dt.timedelta(days=3)).orderBy("day").collect()]
    assert got == [DAY + dt.timedelta(days=i) for i in range(3)]
    assert plans.pending_days(spark, DAY, DAY).count() == 0


# --- candle log --------------------------------------------------------------------------------------


def candle(close, minute=0, symbol="A"):
    start = dt.datetime(2024, 1, 1, 0, minute)
    return (symbol, start, start + dt.timedelta(minutes=1), 1.0, 9.0, 0.5, close, 1.0, 1)


def view(spark, path, upto=None):
    return {(r.symbol, r.start_time.minute): r.close for r in candle_log.latest_candles_view(spark, path, upto).collect()}


def test_log_upserts_replays_and_compacts(spark):
    path = shared_dir(spark, "log")
    write = lambda rows, n: candle_log.append_candle_log(spark.createDataFrame(rows, schemas.CANDLE), n, path)
    write([candle(1.0), candle(2.0, 1)], 0)
    write([candle(3.0), candle(None, 2)], 1)
    expected = {("A", 0): 3.0, ("A", 1): 2.0, ("A", 2): None}
    assert view(spark, path) == expected
    write([candle(3.0), candle(None, 2)], 1)  # the batch again
    assert view(spark, path) == expected
    candle_log.compact(spark, path, 1)
    assert view(spark, path) == expected
    write([candle(4.0)], 2)
    assert view(spark, path) == {**expected, ("A", 0): 4.0} and view(spark, path, 1) == expected
    candle_log.compact(spark, path, 2)
    candle_log.compact(spark, path, 2)
    assert view(spark, path) == {**expected, ("A", 0): 4.0}
    changes = candle_log.candle_changes(spark, path)
    kinds = {(r.batch_id, r.start_time.minute): r.change for r in changes.collect()}
    assert kinds == {(0, 0): "insert", (0, 1): "insert", (1, 0): "replace", (1, 2): "insert", (2, 0): "replace"}


def test_an_unfinished_base_is_ignored(spark, tmp_path):
    path = str(tmp_path)
    candle_log.append_candle_log(spark.createDataFrame([candle(1.0)], schemas.CANDLE), 0, path)
    (tmp_path / "base" / "upto=5").mkdir(parents=True)
    assert view(spark, path) == {("A", 0): 1.0}


def test_partition_round_trip(spark):
    """Three rows, partitioned by symbol, come back."""
    at = [dt.datetime(2024, 12, 20, 10, 0, s) for s in range(3)]
    rows = [(1, "BTCUSDT", 45000.5, at[0]), (2, "ETHUSDT", 2300.75, at[1]), (3, "BTCUSDT", 45001.2, at[2])]
    df = spark.createDataFrame(rows, "id int, symbol string, price double, timestamp timestamp")
    path = shared_dir(spark, "roundtrip")
    for _ in range(2):
        tables.write_full(df, path, ["symbol"])
    back = spark.read.parquet(path).select(*df.columns)
    assert back.count() == 3 and sorted(back.collect()) == sorted(df.collect())


def test_series_defaults():
    assert Series().window() is not None
