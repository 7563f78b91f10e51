"""Column helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlespark.session import materialize

#: Rows that a task of a small intermediate table gets at least.
ROWS_PER_TASK = 16_384

#: Words are runs of other characters than these (fixed values of the contracts).
GAP = r"[ \t-\r]+"
WORD = r"[^ \t-\r]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not use yet, upper and lower case alike."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_key(text: Column) -> Column:
    """A 64-bit key of a text, for joins that also compare ``doc_id``."""
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def stored(df: DataFrame, name: str, rows: int) -> DataFrame:
    """``df`` written to the shared folder, in about as many files as ``rows`` rows need.

    Small shuffle partitions are merged without another shuffle, so that a small table is not written and read as hundreds
    of tiny files. Never fewer than twice the cores, and a large table keeps its partitions.
    """
    least = 2 * df.sparkSession.sparkContext.defaultParallelism
    return materialize(df.coalesce(max(least, -(-rows // ROWS_PER_TASK))), name)


def discard(table: DataFrame) -> None:
    """Delete a table that ``materialize`` wrote, once nothing reads it any more."""
    files = table.inputFiles()
    if files:
        spark = table.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
