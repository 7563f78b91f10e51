"""Text cleaning as a column operator."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlespark.functions import text as t


def with_clean_text(df: DataFrame, source: str = "text", target: str = "cleaned") -> DataFrame:
    """Adds ``target``: the same as ``functions.text.clean_text``, but most rows skip most of the work.

    Each replacement runs only where a cheap test says that it can change something. The steps are
    separate projections, so that a step's result is computed once and tested without being recomputed.
    """
    raw = F.col(source)
    steps = (
        df.withColumn("_1", F.when(t.may_hold_symbols(raw), F.regexp_replace(raw, t.SYMBOL_CLASS, "")).otherwise(raw))
        .withColumn("_2", F.when(F.contains("_1", F.lit("  ")), F.regexp_replace("_1", "  +", " ")).otherwise(F.col("_1")))
        .withColumn(
            target,
            F.when(
                F.startswith("_2", F.lit(" ")) | F.contains("_2", F.lit("\n ")),
                F.regexp_replace("_2", t.LINE_START_SPACE, "$1"),
            ).otherwise(F.col("_2")),
        )
    )
    return steps.drop("_1", "_2")
