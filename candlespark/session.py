"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the results depend on (time zone) or that plans rely on (adaptive re-planning, skew
# splitting). Shuffle width and memory stay with whoever starts the session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Candle state without a watermark is kept for ever: hold it outside the heap, checkpoint its changes.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


#: Shared folders made by this process.
_made: list[str] = []


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "candlespark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder that every executor can reach.

    It lies below ``spark.checkpoint.dir``. A machine-local folder is used only when that setting is
    absent *and* the session runs in local mode; elsewhere other machines could not read it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def release(spark: SparkSession) -> int:
    """Delete the shared folders this process has made, once no result that reads them is needed; their number."""
    files = spark._jvm.org.apache.hadoop.fs
    count = len(_made)
    while _made:
        path = files.Path(_made.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return count


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to a table in the shared folder and go on from there.

    For results that several branches of a plan read: without it Spark computes them once per branch.
    The table outlives lost executors.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
