import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from candlespark import schemas
from candlespark.operators.bars import ohlcv
from candlespark.operators.ingest import parse_trades
from candlespark.operators.stats import word_count
from candlespark.session import shared_dir
from candlespark.sinks.candle_log import candle_changes, latest_candles_view
from candlespark.sources.messages import broker_read_options, broker_write_options, read_message_files, trades_to_json
from candlespark.streaming import trades as jobs

START = dt.datetime(2024, 1, 1)
SCHEMA = "symbol string, trade_id long, timestamp timestamp, price double, quantity double, is_buyer_maker boolean"


@pytest.fixture
def source(spark):
    """Trades out of order, in four message files: a folder, the frame, and how to add a file."""
    rng = random.Random(4)
    rows = [
        (rng.choice("AB"), i, START + dt.timedelta(seconds=rng.randrange(600)), float(rng.randrange(9)), 1.0, False)
        for i in range(400)
    ]
    folder, parts = shared_dir(spark, "messages"), [rows[i::4] for i in range(4)]

    def add(part):
        frame = spark.createDataFrame(part, SCHEMA)
        trades_to_json(frame).select("value").coalesce(1).write.mode("append").text(folder)

    return folder, parts, add, spark.createDataFrame(rows, SCHEMA)


def stream(spark, folder):
    return parse_trades(read_message_files(spark, folder, files_per_trigger=1))


def run(queries):
    for q in queries if isinstance(queries, list) else [queries]:
        q.awaitTermination()
        assert q.exception() is None


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("slide", [None, "30 seconds"])
def test_merged_stream_equals_batch_after_a_restart(spark, source, slide):
    folder, parts, add, everything = source
    paths = jobs.StreamPaths(shared_dir(spark, "stream"))

    def go():
        run(
            jobs.start_candles(
                stream(spark, folder), paths.data("c"), paths.checkpoint("c"), "1 minute", slide, available_now=True
            )
        )

    add(parts[0])
    add(parts[1])
    go()
    add(parts[2])
    add(parts[3])
    go()  # goes on from the checkpoint
    assert rows(latest_candles_view(spark, paths.data("c"))) == rows(ohlcv(everything, "1 minute", slide))
    batches = {r.batch_id for r in candle_changes(spark, paths.data("c")).select("batch_id").distinct().collect()}
    assert batches == {0, 1, 2, 3}


def test_three_queries_from_one_source(spark, source):
    folder, parts, add, everything = source
    for part in parts:
        add(part)
    paths = jobs.StreamPaths(shared_dir(spark, "stream"))
    queries = jobs.start_trade_queries(stream(spark, folder), paths, available_now=True)
    assert len(queries) == 3
    jobs.await_all(spark, queries)
    archived = spark.read.schema(schemas.FLAT_TRADE).parquet(paths.data("raw"))
    assert archived.select("trade_id").distinct().count() == archived.count() == 400
    assert "date=2024-01-01/hour=0/" in archived.select(F.input_file_name()).first()[0]
    assert rows(latest_candles_view(spark, paths.data("tumbling"))) == rows(ohlcv(everything))
    assert rows(latest_candles_view(spark, paths.data("sliding"))) == rows(ohlcv(everything, "1 minute", "30 seconds"))


def test_repeated_messages_count_once_with_dedup(spark, source):
    folder, parts, add, everything = source
    for part in [*parts, parts[0]]:
        add(part)
    paths = jobs.StreamPaths(shared_dir(spark, "stream"))
    run(jobs.start_candles(stream(spark, folder), paths.data("c"), paths.checkpoint("c"), watermark="1 hour", dedup=True, available_now=True))
    assert rows(latest_candles_view(spark, paths.data("c"))) == rows(ohlcv(everything))


@pytest.mark.parametrize("watermark, late_counts", [(None, True), ("5 seconds", False)])
def test_late_trades(spark, source, watermark, late_counts):
    folder, _, add, _ = source
    at = lambda s: START + dt.timedelta(seconds=s)
    # The last trade comes two batches after its window has closed; a batch is judged by the watermark
    # that held before the batch in front of it.
    for i, second in enumerate((10, 300, 301, 20)):
        add([("A", i, at(second), 1.0 + i, 1.0, False)])
    paths = jobs.StreamPaths(shared_dir(spark, "stream"))
    listener = jobs.DroppedRows()
    spark.streams.addListener(listener)
    query = jobs.start_candles(stream(spark, folder), paths.data("c"), paths.checkpoint("c"), watermark=watermark, available_now=True)
    run(query)
    first = latest_candles_view(spark, paths.data("c")).orderBy("start_time").first()
    assert first.trade_count == (2 if late_counts else 1)
    assert first.close == (4.0 if late_counts else 1.0)
    dropped = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    assert dropped == (0 if late_counts else 1)
    for _ in range(100):  # progress reaches listeners a little later
        if listener.by_query.get(str(query.id)) == dropped:
            break
        time.sleep(0.1)
    spark.streams.removeListener(listener)
    assert listener.by_query[str(query.id)] == dropped


def test_a_failing_sink_fails_the_query_and_the_retry_repeats_the_batch(spark, source):
    folder, parts, add, everything = source
    for part in parts:
        add(part)
    paths, failed = jobs.StreamPaths(shared_dir(spark, "stream")), []

    def break_once(batch, batch_id):
        if batch_id == 2 and not failed:
            failed.append(batch_id)
            raise OSError("sink is gone")

    def start():
        return jobs.start_candles(stream(spark, folder), paths.data("c"), paths.checkpoint("c"), available_now=True, on_batch=break_once)

    with pytest.raises(Exception, match="sink is gone"):
        start().awaitTermination()
    run(start())
    assert failed == [2]
    assert rows(latest_candles_view(spark, paths.data("c"))) == rows(ohlcv(everything))


def test_alerts_per_batch(spark, source):
    folder, _, add, _ = source
    for i, price in enumerate((1.0, 5.0, 2.0)):
        add([("A", i, START + dt.timedelta(minutes=i), price, 1.0, False)])
    paths = jobs.StreamPaths(shared_dir(spark, "stream"))
    alerts = jobs.alert_on_batch(paths.data("c"), paths.data("alerts"), 3.0)
    run(jobs.start_candles(stream(spark, folder), paths.data("c"), paths.checkpoint("c"), available_now=True, on_batch=alerts))
    got = {(r.start_time.minute, r.direction) for r in jobs.latest_alerts(spark, paths.data("alerts")).collect()}
    assert got == {(1, "up"), (2, "down")}
    # A late trade closes minute 0 above the threshold: the crossing at minute 1 no longer holds, though its candle is the same.
    add([("A", 9, START + dt.timedelta(seconds=30), 4.0, 1.0, False)])
    run(jobs.start_candles(stream(spark, folder), paths.data("c"), paths.checkpoint("c"), available_now=True, on_batch=alerts))
    got = {(r.start_time.minute, r.direction) for r in jobs.latest_alerts(spark, paths.data("alerts")).collect()}
    assert got == {(2, "down")}


def test_published_messages_are_the_source_of_the_next_job(spark, source):
    folder, parts, add, everything = source
    add(parts[0])
    paths = jobs.StreamPaths(shared_dir(spark, "stream"))
    out = {"path": paths.data("published")}
    run(jobs.start_publish(stream(spark, folder), paths.checkpoint("p"), out, sink="text", available_now=True))
    again = stream(spark, paths.data("published"))
    run(jobs.start_rows(again, paths.data("rows"), paths.checkpoint("rows"), available_now=True))
    got = spark.read.schema(schemas.FLAT_TRADE).parquet(paths.data("rows")).select(*everything.columns)
    assert rows(got) == sorted(parts[0])


def test_word_count_of_a_text_stream(spark, tmp_path):
    for i, line in enumerate(("a b a", "b  c")):
        (tmp_path / f"{i}.txt").write_text(line + "\n")
    counts = word_count(read_message_files(spark, str(tmp_path), 1).withColumnRenamed("value", "text"))
    query = counts.writeStream.outputMode("complete").format("memory").queryName("counts").trigger(availableNow=True).start()
    run(query)
    assert {r.word: r.word_count for r in spark.table("counts").collect()} == {"a": 2, "b": 2, "c": 1}


def test_broker_options():
    read = broker_read_options("host:9092", "trades")
    assert (read["subscribe"], read["startingOffsets"], read["failOnDataLoss"]) == ("trades", "earliest", "false")
    assert read["maxOffsetsPerTrigger"] == "50000"
    write = broker_write_options("host:9092", "trades")
    assert (write["topic"], write["kafka.compression.type"], write["kafka.batch.size"]) == ("trades", "gzip", "32768")


def test_the_upsert_query_writes_replays_and_compacts_a_log(spark, monkeypatch):
    from candlespark.catalog import QUERIES, streams

    calls = []
    for name in ("append_candle_log", "compact", "latest_candles_view"):
        real = getattr(streams.candle_log, name)
        monkeypatch.setattr(streams.candle_log, name, lambda *a, name=name, real=real: (calls.append(name), real(*a))[1])
    rows = QUERIES["upsert_latest"](spark, "/root/testdata/sf0.001").collect()
    assert rows and calls.count("append_candle_log") == 5 and "compact" in calls and calls[-1] == "latest_candles_view"


@pytest.mark.parametrize("ids", [range(400), [0] * 400, [1, 5, 2, *range(0, 1584, 4), 3]], ids=["apart", "one", "uneven"])
def test_message_files_grow_in_number_not_in_size(spark, tmp_path, monkeypatch, ids):
    """A task sorts what it writes; a micro-batch still takes exactly the files of its batch."""
    from candlespark.catalog import streams

    monkeypatch.setattr(streams, "FILE_TRADES", 50)
    rows = [(i, n, "AB"[n % 2], START + dt.timedelta(seconds=n), float(n), '{"k": 2}') for n, i in enumerate(ids)]
    schema = "event_id long, user_id long, event_type string, ts timestamp, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "events.parquet"))
    written, count = streams.message_files(spark, str(tmp_path))
    assert count == 8
    sizes = spark.read.text(f"{written}/*").groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in sizes) == 400 and max(r["count"] for r in sizes) <= 100
    paths = jobs.StreamPaths(shared_dir(spark, "stream"))
    query = jobs.start_rows(streams._parsed(spark, written, count), paths.data("rows"), paths.checkpoint("rows"), available_now=True)
    run(query)
    batches = [sum(i % streams.BATCHES == k for i in ids) for k in range(streams.BATCHES)]
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [n for n in batches if n]
    assert spark.read.schema(schemas.FLAT_TRADE).parquet(paths.data("rows")).count() == 400
