"""Streaming queries, run to the end of the available messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlespark import schemas
from candlespark.catalog import bindings as b
from candlespark.catalog.registry import CANDLE_COLUMNS, TRADES, candles, query, sliding
from candlespark.operators.bars import ohlcv
from candlespark.operators.ingest import parse_trades
from candlespark.session import shared_dir
from candlespark.sinks import candle_log
from candlespark.sources.messages import read_message_files, trades_to_json
from candlespark.streaming import trades as jobs

#: Micro-batches of the message files, the fewest files of each, and the trades that one task writes.
BATCHES, FILES, FILE_TRADES = 4, 2, 250_000


def message_files(spark: SparkSession, folder: str, batches: int = BATCHES) -> tuple[str, int]:
    """All trades as JSON message files below ``batch=N`` folders, written in one pass, and the number of files to a batch.

    A trade's batch is its id modulo ``batches``, so the batches depend on the data alone. The times of the files say in
    which order they are read. Files hold trades of all times, so that later batches correct candles of earlier ones. Every task
    writes a file of each batch, for which it sorts its messages: their number grows with the trades, not their size.
    """
    path = shared_dir(spark, "messages")
    trades = b.trades(spark, folder)
    tasks = max(FILES, -(-trades.count() // FILE_TRADES))
    # By more than the id: trades of one id go to one batch, but not to one task.
    trades = trades.repartition(tasks, "trade_id", "symbol", "timestamp", "price", "quantity")
    messages = trades_to_json(trades, F.pmod("trade_id", F.lit(batches)).alias("batch")).select("value", "batch")
    messages.write.partitionBy("batch").text(path)
    files = spark._jvm.org.apache.hadoop.fs
    system = files.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    found = [[f.getPath().toString() for f in system.globStatus(files.Path(f"{path}/batch={batch}/*"))] for batch in range(batches)]
    # As many as were written: a batch of few trades has fewer, and empty ones keep the next batch's files out of its micro-batch.
    count = max(FILES, *map(len, found))
    for batch, names in enumerate(found):
        missing = [f"{path}/batch={batch}/empty-{k}" for k in range(len(names), count)] if names else []
        for name in missing:
            system.create(files.Path(name)).close()
        for name in names + missing:
            system.setTimes(files.Path(name), 1_000_000_000_000 + 1_000 * batch, -1)
    return path, count


def message_stream(spark: SparkSession, folder: str, batches: int = BATCHES) -> DataFrame:
    """The messages as a stream of ``batches`` micro-batches."""
    return _parsed(spark, *message_files(spark, folder, batches))


def _parsed(spark: SparkSession, path: str, files: int) -> DataFrame:
    return parse_trades(read_message_files(spark, f"{path}/*", files_per_trigger=files))


def finish(*queries) -> None:
    for q in queries:
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()


def _candle_table(spark, folder, window, slide=None) -> tuple[str, jobs.StreamPaths]:
    paths = jobs.StreamPaths(shared_dir(spark, "stream"))
    finish(
        jobs.start_candles(
            message_stream(spark, folder),
            paths.data("candles"),
            paths.checkpoint("candles"),
            window,
            slide,
            available_now=True,
        )
    )
    return paths.data("candles"), paths


# Messages carry milliseconds, so the candles are those of the truncated times.
_MS = f"""{TRADES.replace("ts AS", "time_bucket(INTERVAL '1 millisecond', ts) AS")}"""


@query("stream_tumbling", f"WITH {_MS}, {candles()} SELECT {CANDLE_COLUMNS} FROM candles")
def stream_tumbling(spark, folder):
    path, _ = _candle_table(spark, folder, "1 hour")
    return b.naive(candle_log.latest_candles_view(spark, path), "start_time", "end_time")


@query("stream_sliding", f"WITH {_MS}, {sliding()} SELECT {CANDLE_COLUMNS} FROM candles")
def stream_sliding(spark, folder):
    path, _ = _candle_table(spark, folder, "1 hour", "30 minutes")
    return b.naive(candle_log.latest_candles_view(spark, path), "start_time", "end_time")


@query(
    "stream_alerts",
    f"""WITH {_MS}, {candles()},
p AS (SELECT symbol, start_time, close, lag(close) OVER (PARTITION BY symbol ORDER BY start_time) AS previous FROM candles)
SELECT symbol, start_time, close, previous, CASE WHEN previous < 50 THEN 'up' ELSE 'down' END AS direction FROM p
WHERE (previous < 50 AND close >= 50) OR (previous >= 50 AND close < 50)""",
)
def stream_alerts(spark, folder):
    """Alerts that hold after the last batch; batches hold trades of all times, so most candles are corrected."""
    paths = jobs.StreamPaths(shared_dir(spark, "stream"))
    alert = jobs.alert_on_batch(paths.data("candles"), paths.data("alerts"), 50.0)
    trades, checkpoint = message_stream(spark, folder), paths.checkpoint("candles")
    finish(jobs.start_candles(trades, paths.data("candles"), checkpoint, "1 hour", available_now=True, on_batch=alert))
    return b.naive(jobs.latest_alerts(spark, paths.data("alerts")), "start_time")


_BATCHED = f"{_MS}, batches AS (SELECT unnest(range({BATCHES})) AS batch_id)"


@query(
    "candle_changes",
    f"""WITH {_BATCHED},
hours AS (SELECT *, time_bucket(INTERVAL '1 hour', "timestamp") AS start_time FROM trades),
logged AS (
  SELECT symbol, start_time, start_time + INTERVAL '1 hour' AS end_time, arg_min(price, ("timestamp", trade_id)) AS open,
         max(price) AS high, min(price) AS low, arg_max(price, ("timestamp", trade_id)) AS close, sum(quantity) AS volume,
         count(*) AS trade_count, batch_id
  FROM hours JOIN batches ON trade_id % {BATCHES} <= batch_id GROUP BY symbol, start_time, batch_id
  HAVING max(trade_id % {BATCHES}) = batch_id)
SELECT *, CASE WHEN batch_id = min(batch_id) OVER (PARTITION BY symbol, start_time) THEN 'insert' ELSE 'replace' END AS change
FROM logged""",
)
def candle_changes(spark, folder):
    """Change feed of the tumbling candles: every candle once per batch that changed it."""
    path, _ = _candle_table(spark, folder, "1 hour")
    return b.naive(candle_log.candle_changes(spark, path), "start_time", "end_time")


@query(
    "candle_changes_folded",
    f"""WITH {_MS}, {candles()}
SELECT symbol, start_time, end_time, CAST(1 AS BIGINT) AS inserts, close, trade_count FROM candles""",
)
def candle_changes_folded(spark, folder):
    """The change feed applied in order: one insert per key, and the last change is the final candle."""
    path, _ = _candle_table(spark, folder, "1 hour")
    changes = candle_log.candle_changes(spark, path)
    folded = changes.groupBy(*schemas.CANDLE_KEY).agg(
        F.count_if(F.col("change") == "insert").alias("inserts"),
        F.max_by("close", "batch_id").alias("close"),
        F.max_by("trade_count", "batch_id").alias("trade_count"),
    )
    return b.naive(folded, "start_time", "end_time")


_TRADE_COLUMNS = """symbol, trade_id, price, quantity, is_buyer_maker, "timestamp",
  CAST("timestamp" AS DATE) AS date, CAST(hour("timestamp") AS INTEGER) AS hour"""
_TRADE_NAMES = ("symbol", "trade_id", "price", "quantity", "is_buyer_maker", "timestamp", "date", "hour")


@query("raw_archive", f"WITH {_MS} SELECT {_TRADE_COLUMNS} FROM trades")
def raw_archive(spark, folder):
    """All trades through the archive query, one micro-batch; several and a restart are tested apart."""
    paths = jobs.StreamPaths(shared_dir(spark, "stream"))
    stream = message_stream(spark, folder, batches=1)
    finish(jobs.start_archive(stream, paths.data("raw"), paths.checkpoint("raw"), available_now=True))
    archived = spark.read.schema(schemas.FLAT_TRADE).parquet(paths.data("raw"))
    return b.naive(archived.select(*_TRADE_NAMES), "timestamp")


@query(
    "stream_trades",
    f"""WITH {_MS}
SELECT date, hour, count(*) AS trades FROM (SELECT {_TRADE_COLUMNS} FROM trades) GROUP BY date, hour""",
)
def stream_trades(spark, folder):
    """Source and parser over several micro-batches, counted per hour."""
    paths = jobs.StreamPaths(shared_dir(spark, "stream"))
    finish(jobs.start_rows(message_stream(spark, folder), paths.data("parsed"), paths.checkpoint("parsed"), True))
    parsed = spark.read.schema(schemas.FLAT_TRADE).parquet(paths.data("parsed"))
    return parsed.groupBy("date", "hour").agg(F.count(F.lit(1)).alias("trades"))


@query(
    "stream_restart",
    f"""WITH {_MS}, {candles("tumbling")}, {sliding("sliding")},
archive AS (SELECT symbol, time_bucket(INTERVAL '1 hour', "timestamp") AS start_time, count(*) AS trade_count FROM trades GROUP BY ALL)
SELECT 'tumbling' AS query, symbol, start_time, close, trade_count FROM tumbling
UNION ALL SELECT 'sliding', symbol, start_time, close, trade_count FROM sliding
UNION ALL SELECT 'archive', symbol, start_time, NULL, trade_count FROM archive""",
)
def stream_restart(spark, folder):
    """Archive, tumbling and sliding candles as three queries, ended after two batches and resumed from their checkpoints for two more."""
    (written, count), arrived = message_files(spark, folder), shared_dir(spark, "arrived")
    paths = jobs.StreamPaths(shared_dir(spark, "stream"))
    files = spark._jvm.org.apache.hadoop.fs
    system = files.Path(written).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(files.Path(arrived))
    for part in (range(BATCHES // 2), range(BATCHES // 2, BATCHES)):
        for batch in part:
            system.rename(files.Path(f"{written}/batch={batch}"), files.Path(f"{arrived}/batch={batch}"))
        jobs.await_all(spark, jobs.start_trade_queries(_parsed(spark, arrived, count), paths, available_now=True, window="1 hour", slide="30 minutes"))
    names = ["query", "symbol", "start_time", "close", "trade_count"]
    views = [
        candle_log.latest_candles_view(spark, paths.data(name)).withColumn("query", F.lit(name)).select(names) for name in ("tumbling", "sliding")
    ]
    archive = spark.read.schema(schemas.FLAT_TRADE).parquet(paths.data("raw"))
    counted = archive.groupBy("symbol", F.date_trunc("hour", "timestamp").alias("start_time")).agg(F.count(F.lit(1)).alias("trade_count"))
    counted = counted.select(F.lit("archive").alias("query"), "symbol", "start_time", F.lit(None).cast("double").alias("close"), "trade_count")
    return b.naive(views[0].unionByName(views[1]).unionByName(counted), "start_time")


_CLOSED = f"""WITH {_MS},
hours AS (
  SELECT *, trade_id % {BATCHES} AS batch, time_bucket(INTERVAL '1 hour', "timestamp") + INTERVAL '1 hour' AS end_time FROM trades),
marks AS (
  SELECT batch, max(max("timestamp")) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) - INTERVAL '5 seconds' AS late,
         max(max("timestamp")) OVER () - INTERVAL '5 seconds' AS last
  FROM hours GROUP BY batch),
trades_in_time AS (SELECT h.* FROM hours h JOIN marks USING (batch) WHERE (late IS NULL OR end_time > late) AND end_time <= last)"""


@query("stream_late_data", f"{_CLOSED}, {candles(source='trades_in_time')} SELECT {CANDLE_COLUMNS} FROM candles")
def stream_late_data(spark, folder):
    """Watermarked append mode: closed windows only; the newest one stays open and late trades are dropped.

    A batch is judged by the watermark that held before the batch in front of it.
    """
    paths = jobs.StreamPaths(shared_dir(spark, "stream"))
    bars = ohlcv(message_stream(spark, folder).withWatermark("timestamp", "5 seconds"), "1 hour")
    finish(
        bars.writeStream.format("parquet")
        .option("path", paths.data("closed"))
        .option("checkpointLocation", paths.checkpoint("closed"))
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    return b.naive(spark.read.schema(schemas.CANDLE).parquet(paths.data("closed")), "start_time", "end_time")


@query(
    "upsert_latest",
    f"""WITH {TRADES}, {candles(size='1 day')}
SELECT {CANDLE_COLUMNS} FROM candles""",
)
def upsert_latest(spark, folder):
    """A candle log in four batches, one per part of the day, with one replayed and a base: the view shows the whole days."""
    trades, path = b.trades(spark, folder), shared_dir(spark, "candles")
    trades = trades.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    part = F.call_function("div", F.hour("timestamp"), F.lit(6))
    same = [F.col(c).eqNullSafe(F.col(f"changed_{c}")) for c in schemas.CANDLE_KEY]

    def append(batch: int) -> None:
        # As in update mode: the candles that the batch's trades changed, over all trades so far.
        changed = ohlcv(trades.where(part == batch), "1 day").select(*[F.col(c).alias(f"changed_{c}") for c in schemas.CANDLE_KEY])
        candle_log.append_candle_log(ohlcv(trades.where(part <= batch), "1 day").join(changed, same, "left_semi"), batch, path)

    for batch in range(4):
        append(batch)
        if batch == 1:
            candle_log.compact(spark, path, batch)
        if batch == 2:
            append(batch)
    return b.naive(candle_log.latest_candles_view(spark, path), "start_time", "end_time")
