"""Keyed upsert without a table format: a log of batches and a view of the newest row per key.

Layout below ``path``::

    log/batch_id=N/     rows that micro-batch N changed; a repeated batch replaces its own folder
    base/upto=N/        all keys as of batch N, written by ``compact``; its name says which batches it covers

The view reads the newest finished base and the batches after it. ``upkeep`` runs after every batch of the job: every n
batches it writes a base and removes what no reader needs any more, so that the number of folders stays bounded. States
and changes of the last ``keep`` batches at least can always be read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlespark import schemas

BATCH = "batch_id"


def append_candle_log(batch: DataFrame, batch_id: int, path: str) -> None:
    """Write the rows of one micro-batch; any failure is raised, so that the batch is not committed."""
    batch.write.mode("overwrite").parquet(f"{path}/log/{BATCH}={int(batch_id)}")


def latest_by_key(log: DataFrame, key: tuple[str, ...] = schemas.CANDLE_KEY, version: str = BATCH) -> DataFrame:
    """The whole row of the newest version per key. Versions are combined map-side before the shuffle."""
    rest = [c for c in log.columns if c not in key and c != version]
    # Column by column: one struct of all would make Spark sort the whole log.
    return log.groupBy(*key).agg(*[F.max_by(c, version).alias(c) for c in rest])


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All logged versions with their batch number."""
    logged = T.StructType([*schemas.CANDLE.fields, T.StructField(BATCH, T.LongType())])
    return spark.read.schema(logged).parquet(f"{path}/log")


def numbered(spark: SparkSession, pattern: str) -> list[int]:
    """Numbers in the names of the folders that match ``name=*`` or hold a file that matches ``name=*/file``."""
    glob = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = glob.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(glob)
    paths = [f.getPath() for f in (found or [])]
    return sorted(int((p if "=" in p.getName() else p.getParent()).getName().split("=")[1]) for p in paths)


def remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def finished_bases(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the bases that were written to the end (they hold a ``_SUCCESS`` file), ascending."""
    return numbered(spark, f"{path}/base/upto=*/_SUCCESS")


def _newest_base(spark: SparkSession, path: str, upto: int | None) -> int | None:
    return max((n for n in finished_bases(spark, path) if upto is None or n <= upto), default=None)


def logged_candles(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    """Rows that may be the current ones as of batch ``upto``: the newest base and the batches after it."""
    base_id = _newest_base(spark, path, upto)
    log = read_log(spark, path)
    if upto is not None:
        log = log.where(F.col(BATCH) <= upto)
    if base_id is not None:
        log = log.where(F.col(BATCH) > base_id).unionByName(_base_rows(spark, path, base_id))
    return log


def _base_rows(spark: SparkSession, path: str, base_id: int) -> DataFrame:
    base = spark.read.schema(schemas.CANDLE).parquet(f"{path}/base/upto={base_id}")
    return base.withColumn(BATCH, F.lit(base_id).cast("long"))


def latest_candles_view(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    """Current row of every key, or the row as of batch ``upto``."""
    return latest_by_key(logged_candles(spark, path, upto))


def compact(spark: SparkSession, path: str, upto: int) -> None:
    """Write the state as of batch ``upto`` to a new base folder. Readers switch once it is finished."""
    if _newest_base(spark, path, upto) == upto:
        return
    latest_candles_view(spark, path, upto).write.mode("overwrite").parquet(f"{path}/base/upto={int(upto)}")


def prune(spark: SparkSession, path: str, keep: int) -> list[str]:
    """Remove the folders that are needed for no state of the last ``keep`` batches before the newest base; their names.

    The newest base that is ``keep`` batches old stays with all batches after it. Batches it covers and older bases go, after
    the grace that ``keep`` gives to readers that have listed them already.
    """
    bases = finished_bases(spark, path)
    settled = max((n for n in bases if n <= bases[-1] - keep), default=None) if bases else None
    if settled is None:
        return []
    gone = [f"base/upto={n}" for n in numbered(spark, f"{path}/base/upto=*") if n < settled]
    gone += [f"log/{BATCH}={n}" for n in numbered(spark, f"{path}/log/{BATCH}=*") if n <= settled]
    for name in gone:
        remove(spark, f"{path}/{name}")
    return gone


def upkeep(spark: SparkSession, path: str, batch_id: int, every: int, keep: int) -> None:
    """After batch ``batch_id``: a base every ``every`` batches, then removal of what it makes needless.

    A repeated batch does the same again: its base is there already, and the batch itself is younger than any that goes.
    """
    if (batch_id + 1) % every == 0:
        compact(spark, path, batch_id)
        prune(spark, path, keep)


def candle_changes(spark: SparkSession, path: str, after: int | None = None) -> DataFrame:
    """Change feed: the rows that batches logged (after batch ``after``, if given), each with the kind of change it made.

    The batches are merged by key with the state before them, in one shuffle; a key's first row is its insert. Without ``after``
    the feed starts behind the oldest base, which covers the batches that ``upkeep`` has removed.
    """
    bases = finished_bases(spark, path)
    known = max((n for n in bases if n <= after), default=None) if after is not None else min(bases, default=None)
    log = read_log(spark, path)
    if known is None:
        log = log.withColumn("_base", F.lit(False))
    else:
        # A feed from the start, as long as no batch has been removed, needs no base.
        first = min(numbered(spark, f"{path}/log/{BATCH}=*"), default=None)
        if after is None and first is not None and first <= known:
            log = log.withColumn("_base", F.lit(False))
        else:
            log = log.where(F.col(BATCH) > known).withColumn("_base", F.lit(False))
            log = log.unionByName(_base_rows(spark, path, known).withColumn("_base", F.lit(True)))
    versions = Window.partitionBy(*schemas.CANDLE_KEY).orderBy(BATCH)
    kind = F.when(F.row_number().over(versions) == 1, "insert").otherwise("replace")
    changes = log.withColumn("change", kind).where("NOT _base").drop("_base")
    return changes if after is None else changes.where(F.col(BATCH) > after)
