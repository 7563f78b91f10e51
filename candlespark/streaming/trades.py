"""Three independent queries over one trade source: raw archive, tumbling and sliding candles."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from candlespark import schemas
from candlespark.operators.bars import ohlcv
from candlespark.operators.blocks import CANDLES, over_series
from candlespark.operators.indicators import crossing
from candlespark.operators.ingest import dedup_trades
from candlespark.sinks.candle_log import BATCH, append_candle_log, latest_by_key, logged_candles, numbered, remove, upkeep
from candlespark.sources.messages import trades_to_json


@dataclass(frozen=True)
class StreamPaths:
    """Folders of the streaming jobs below one root; each query has its own checkpoint."""

    root: str

    def data(self, name: str) -> str:
        return f"{self.root}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoint/{name}"


def _trigger(writer, every: str | None, available_now: bool):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every) if every else writer


def start_archive(
    trades: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = False,
    every: str = "1 minute",
) -> StreamingQuery:
    """Append trades to Parquet by date and hour.

    The trades of a live batch nearly all belong to one hour, those of a backlog to many. ``rebalance``
    serves both: adaptive execution cuts a large hour into several tasks and joins small ones.
    """
    writer = (
        trades.hint("rebalance", "date", "hour")
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("date", "hour")
        .outputMode("append")
    )
    return _trigger(writer, every, available_now).start()


def start_publish(
    trades: DataFrame, checkpoint: str, options: dict[str, str], sink: str = "kafka", available_now: bool = False
) -> StreamingQuery:
    """Send trades as JSON messages: to a broker, or with ``sink="text"`` to message files."""
    messages = trades_to_json(trades)
    if sink == "text":
        messages = messages.select("value")
    writer = messages.writeStream.format(sink).options(**options).option("checkpointLocation", checkpoint)
    return _trigger(writer, None, available_now).start()


def start_rows(
    rows: DataFrame, path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Append rows as they come, without a key: a whole micro-batch is written at a time."""
    writer = rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return _trigger(writer.outputMode("append"), None, available_now).start()


def start_candles(
    trades: DataFrame,
    path: str,
    checkpoint: str,
    window: str = "1 minute",
    slide: str | None = None,
    watermark: str | None = None,
    dedup: bool = False,
    available_now: bool = False,
    on_batch: Callable[[DataFrame, int], None] | None = None,
    compact_every: int | None = 20,
    keep: int = 20,
) -> StreamingQuery:
    """Candles in update mode, upserted through the candle log.

    Without ``watermark`` late trades always correct their candle and state is kept for ever; with one,
    state older than the delay is released and later trades are dropped. ``on_batch`` sees each batch
    after it was logged. Every ``compact_every`` batches the log is compacted, and what is older than ``keep`` batches is
    removed. Errors are not caught: a batch that was not written is not committed.
    """
    if dedup:
        trades = dedup_trades(trades, watermark)
    elif watermark:
        trades = trades.withWatermark("timestamp", watermark)

    def log_batch(batch: DataFrame, batch_id: int) -> None:
        append_candle_log(batch, batch_id, path)
        if on_batch is not None:
            on_batch(batch, batch_id)
        if compact_every:
            upkeep(batch.sparkSession, path, batch_id, compact_every, keep)

    writer = (
        ohlcv(trades, window, slide)
        .writeStream.foreachBatch(log_batch)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, None, available_now).start()


def start_trade_queries(
    trades: DataFrame,
    paths: StreamPaths,
    watermark: str | None = None,
    dedup: bool = False,
    available_now: bool = False,
    window: str = "1 minute",
    slide: str = "30 seconds",
) -> list[StreamingQuery]:
    """Archive, tumbling and sliding candles as three queries."""

    def candles(name: str, step: str | None) -> StreamingQuery:
        return start_candles(
            trades, paths.data(name), paths.checkpoint(name), window, step, watermark, dedup, available_now
        )

    return [
        start_archive(trades, paths.data("raw"), paths.checkpoint("raw"), available_now),
        candles("tumbling", None),
        candles("sliding", slide),
    ]


class DroppedRows(StreamingQueryListener):
    """Counts what queries drop as late, over all their batches: ``spark.streams.addListener(DroppedRows())``.

    Spark counts the rows that reach the state after the map-side combine, so trades of one candle and task count once.
    """

    def __init__(self) -> None:
        self.by_query: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.by_query.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        dropped = sum(s.numRowsDroppedByWatermark for s in event.progress.stateOperators)
        self.by_query[str(event.progress.id)] = self.by_query.get(str(event.progress.id), 0) + dropped

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def await_all(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Wait until every query has ended; the first failure of any of them is raised at once."""
    while any(q.isActive for q in queries):
        spark.streams.awaitAnyTermination()
        for q in queries:
            if not q.isActive and q.exception() is not None:
                raise q.exception()
        spark.streams.resetTerminated()


ALERT_CANDLE = "symbol string, start_time timestamp, close double"


def alert_on_batch(path: str, target: str, threshold: float, remember: int = 8) -> Callable[[DataFrame, int], None]:
    """A batch callback that writes the crossing, or its absence, at every candle that a batch may have affected.

    A crossing depends on a candle and the one before it, so the changed candles and their successors are judged again;
    ``latest_alerts`` gives what holds. The newest ``remember`` candles of each symbol are kept as a small table per batch, beside
    ``target``: with them a batch needs no history, unless it changes a candle at or before the oldest remembered one. Then,
    for the symbols concerned only, the stretch from the candle before the first change to the candle after the last one is
    taken from the log. A repeated batch replaces its own rows.
    """
    state = f"{target.rstrip('/')}-state"

    def alert(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        changed = spark.read.schema(schemas.CANDLE).parquet(f"{path}/log/{BATCH}={batch_id}").select("symbol", "start_time", "close")
        before = max((n for n in numbered(spark, f"{state}/{BATCH}=*/_SUCCESS") if n < batch_id), default=None)
        if before is None:  # the first batch judged here, though the log may be older
            known = newest_candles(latest_by_key(logged_candles(spark, path, batch_id - 1)), remember)
        else:
            known = spark.read.schema(ALERT_CANDLE).parquet(f"{state}/{BATCH}={before}")
        rows = known.join(changed, ["symbol", "start_time"], "left_anti").withColumn("changed", F.lit(None).cast("boolean"))
        rows = rows.unionByName(changed.withColumn("changed", F.lit(True)))
        newest_candles(rows, remember).coalesce(1).write.mode("overwrite").parquet(f"{state}/{BATCH}={int(batch_id)}")

        oldest = known.groupBy("symbol").agg(F.min("start_time").alias("oldest"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= remember)
        late = changed.join(oldest, "symbol").where(F.col("start_time") <= F.col("oldest")).select("symbol").distinct()
        if not late.isEmpty():
            rows = rows.join(late, "symbol", "left_anti").unionByName(stretches(spark, path, batch_id, changed.join(late, "symbol", "left_semi")))
        judged = price_crossings(rows, threshold)
        judged = judged.where(F.col("changed") | F.col("previous_changed"))
        judged.select("symbol", "start_time", "close", "previous", "direction").write.mode("overwrite").parquet(f"{target}/{BATCH}={int(batch_id)}")
        for old in numbered(spark, f"{state}/{BATCH}=*"):
            if old < batch_id - 2:
                remove(spark, f"{state}/{BATCH}={old}")

    return alert


def newest_candles(candles: DataFrame, k: int) -> DataFrame:
    """Time and close of the ``k`` newest candles of each symbol."""
    newest = Window.partitionBy("symbol").orderBy(F.col("start_time").desc())
    return candles.withColumn("place", F.row_number().over(newest)).where(F.col("place") <= k).select("symbol", "start_time", "close")


def stretches(spark: SparkSession, path: str, batch_id: int, changed: DataFrame) -> DataFrame:
    """The logged candles of each symbol from the one before its first change to the one after its last, ``changed`` marked.

    Finding the ends takes two columns of the log and no shuffle of candles.
    """
    log = logged_candles(spark, path, batch_id).select("symbol", "start_time", "close", BATCH)
    span = changed.groupBy("symbol").agg(F.min("start_time").alias("first"), F.max("start_time").alias("last"))
    start = F.col("start_time")
    ends = log.select("symbol", "start_time").join(span, "symbol").groupBy("symbol").agg(
        F.coalesce(F.max(F.when(start < F.col("first"), start)), F.min("first")).alias("low"),
        F.coalesce(F.min(F.when(start > F.col("last"), start)), F.max("last")).alias("high"),
    )
    near = log.join(ends, "symbol").where(start.between(F.col("low"), F.col("high"))).select(log.columns)
    merged = latest_by_key(near, ("symbol", "start_time"))
    return merged.join(changed.select("symbol", "start_time", F.lit(True).alias("changed")), ["symbol", "start_time"], "left")


def price_crossings(marked: DataFrame, threshold: float) -> DataFrame:
    """Every row with the price before it, the crossing (or null), and whether the row before was ``changed``."""

    def add(rows: DataFrame, w: WindowSpec) -> DataFrame:
        rows = rows.withColumns({"previous": F.lag("close", 1).over(w), "previous_changed": F.lag("changed", 1).over(w)})
        return rows.withColumn("direction", crossing("close", threshold))

    return over_series(marked, CANDLES, 1, add)


def latest_alerts(spark: SparkSession, target: str) -> DataFrame:
    """The crossings that hold after all batches."""
    logged = "symbol string, start_time timestamp, close double, previous double, direction string, batch_id bigint"
    return latest_by_key(spark.read.schema(logged).parquet(target), ("symbol", "start_time")).where("direction IS NOT NULL")
