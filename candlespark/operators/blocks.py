"""Row windows per key that do not gather a key in one task.

``Window.partitionBy(symbol)`` puts all rows of a symbol into one task: with some thirty symbols, at most
thirty tasks do the work, and the largest symbol decides the run time. The functions here cut each
symbol's series into blocks of equal row count and give every block the rows just before it that its
frames reach back to. Results are the same as with the plain window, for any gaps in the series.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from candlespark.functions.time import time_chunk

ROW_INDEX = "_row_index"


@dataclass(frozen=True)
class Series:
    """How a table forms time series: key columns, the time column, extra order columns for equal times.

    ``chunk`` is the stretch of time counted together when rows are numbered; one task sorts the rows of
    one key and chunk. ``block_rows`` is the number of rows computed together; ``None`` asks for the plain
    window (one task per key), which is right only for keys of known, small length.
    Key and time columns must not be null.
    """

    key: tuple[str, ...] = ("symbol",)
    time: str = "start_time"
    tie: tuple[str, ...] = ()
    chunk: str = "1 day"
    block_rows: int | None = 65_536

    @property
    def order(self) -> tuple[str, ...]:
        return (self.time, *self.tie)

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.key).orderBy(*self.order)


CANDLES = Series()
KLINES = Series(time="open_datetime")


def chunk_offsets(df: DataFrame, key: tuple[str, ...], chunk: Column) -> DataFrame:
    """Rows per key and chunk, and how many rows of the key lie in earlier chunks.

    The count is combined map-side, so only one row per key and chunk is shuffled and scanned in order.
    """
    counts = df.groupBy(*key, chunk.alias("_chunk")).agg(F.count(F.lit(1)).alias("_chunk_rows"))
    earlier = Window.partitionBy(*key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_base", F.coalesce(F.sum("_chunk_rows").over(earlier), F.lit(0)))


def with_row_index(df: DataFrame, series: Series) -> DataFrame:
    """Adds ``_row_index``: 0, 1, 2, ... per key in time order.

    Rows are numbered within their chunk; the number of rows in earlier chunks comes from a small
    aggregate. Both sides of the join are already distributed by key and chunk.
    """
    chunk = time_chunk(F.col(series.time), series.chunk)
    offsets = chunk_offsets(df, series.key, chunk).drop("_chunk_rows")
    within = Window.partitionBy(*series.key, "_chunk").orderBy(*series.order)
    local = df.withColumn("_chunk", chunk).withColumn("_local", F.row_number().over(within))
    # A left join keeps rows whose key or time is null, for which there is no position: fail, not drop.
    base = F.coalesce("_base", F.raise_error(F.lit("series rows need a non-null key and time")).cast("long"))
    return (
        local.join(offsets, [*series.key, "_chunk"], "left")
        .withColumn(ROW_INDEX, base + F.col("_local") - 1)
        .drop("_chunk", "_local", "_base")
    )


def spread_blocks(df: DataFrame, series: Series, lookback: int) -> DataFrame:
    """Adds ``_row_index`` and ``_block``; the last ``lookback`` rows of a block are also copied to the next."""
    size = series.block_rows
    if size is None or not 0 <= lookback <= size:
        raise ValueError("lookback must lie between 0 and block_rows")
    indexed = with_row_index(df, series)
    block = F.call_function("div", F.col(ROW_INDEX), F.lit(size))
    in_tail = F.pmod(F.col(ROW_INDEX), F.lit(size)) >= size - lookback
    return indexed.withColumn("_block", F.explode(F.when(in_tail, F.array(block, block + 1)).otherwise(F.array(block))))


def own_rows(series: Series) -> Column:
    """True for a row in its own block, false for a copy that only serves a later block's frames."""
    return F.col("_block") == F.call_function("div", F.col(ROW_INDEX), F.lit(series.block_rows))


def over_series(
    df: DataFrame, series: Series, lookback: int, add: Callable[[DataFrame, WindowSpec], DataFrame]
) -> DataFrame:
    """Run ``add(rows, window)`` over each series.

    ``add`` may use ``lag`` and row frames on ``window`` as long as no result needs more than ``lookback``
    rows before its own, and may use the column ``_row_index``.
    """
    if series.block_rows is None:
        numbered = df.withColumn(ROW_INDEX, F.row_number().over(series.window()) - 1)
        return add(numbered, series.window()).drop(ROW_INDEX)
    window = Window.partitionBy(*series.key, "_block").orderBy(ROW_INDEX)
    return add(spread_blocks(df, series, lookback), window).where(own_rows(series)).drop("_block", ROW_INDEX)


def running_max(df: DataFrame, series: Series, value: str, name: str) -> DataFrame:
    """Adds the maximum of ``value`` from the start of the series to the current row.

    Maxima per chunk are aggregated first; their running maximum gives every chunk its starting value.
    """
    chunk = time_chunk(F.col(series.time), series.chunk)
    peaks = df.groupBy(*series.key, chunk.alias("_chunk")).agg(F.max(value).alias("_peak"))
    earlier = Window.partitionBy(*series.key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = peaks.select(*series.key, "_chunk", F.max("_peak").over(earlier).alias("_before"))
    within = Window.partitionBy(*series.key, "_chunk").orderBy(*series.order)
    local = df.withColumn("_chunk", chunk).withColumn(
        "_within", F.max(value).over(within.rowsBetween(Window.unboundedPreceding, 0))
    )
    return (
        local.join(before, [*series.key, "_chunk"], "left")
        .withColumn(name, F.greatest("_before", "_within"))
        .drop("_chunk", "_within", "_before")
    )
