"""Exact percentiles per group for groups of any size.

Spark's exact ``percentile`` keeps all distinct values of a group in the memory of one task. Here a
sketch only supplies cut points close to the wanted ranks. All values between two cuts are counted, the
counts tell which stretch holds each wanted rank, and only those stretches are sorted. The result does
not depend on how good the sketch is; a poor one would only make a stretch longer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlespark.session import materialize


def join_on(left: DataFrame, right: DataFrame, names: list[str], how: str) -> DataFrame:
    """Join on equal columns where null equals null; keeps the left columns once."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in names})
    condition = F.lit(True)
    for c in names:
        condition = condition & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return left.join(renamed, condition, how).drop(*[f"_r_{c}" for c in names])


def exact_percentiles(
    df: DataFrame, key: list[str], value: str, probs: dict[str, float], accuracy: int = 10_000, also: dict[str, Column] | None = None
) -> DataFrame:
    """Linearly interpolated percentiles: one row per key, one column per entry of ``probs``.

    ``also`` are further aggregates of ``df``, computed in the scan that makes the sketch; with them keys that have only null
    values are kept. ``df`` is read twice: for the sketch, and to place its values, which are written out by stretch.
    """
    margin = 3 / accuracy
    grid = sorted({min(1.0, max(0.0, p + d)) for p in probs.values() for d in (-margin, margin)})
    extra = [c.alias(name) for name, c in (also or {}).items()]
    cuts = materialize(df.groupBy(*key).agg(F.percentile_approx(value, grid, accuracy).alias("_cuts"), *extra), "percentile-cuts")
    rows = df.where(F.col(value).isNotNull()).select(*key, F.col(value).alias("_v"))

    # The stretch number is the count of cuts below the value, so it grows with the value.
    stretch = sum((F.when(F.col("_v") > F.get("_cuts", F.lit(i)), 1).otherwise(0) for i in range(len(grid))), F.lit(0))
    placed = join_on(rows, cuts.select(*key, "_cuts"), key, "left").withColumn("_stretch", stretch).drop("_cuts")
    placed = materialize(placed, "percentile-values")

    # At most len(grid) + 1 rows per key from here to the choice of stretches.
    before = Window.partitionBy(*key).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(*key, "_stretch").agg(F.count(F.lit(1)).alias("_n"))
    sizes = sizes.withColumns(
        {
            "_base": F.coalesce(F.sum("_n").over(before), F.lit(0)),
            "_total": F.sum("_n").over(Window.partitionBy(*key)),
        }
    )

    def position(p: float) -> Column:
        return F.lit(float(p)) * (F.col("_total") - 1)

    def covers(first: Column, count: Column, rank: Column) -> Column:
        return (rank >= first) & (rank < first + count)

    wanted = F.lit(False)
    for p in probs.values():
        for rank in (F.floor(position(p)), F.ceil(position(p))):
            wanted = wanted | covers(F.col("_base"), F.col("_n"), rank)
    chosen = sizes.where(wanted).select(*key, "_stretch", "_base", "_total")

    # Equal values collapse before anything is sorted.
    values = join_on(placed, chosen, [*key, "_stretch"], "inner")
    values = values.groupBy(*key, "_stretch", "_base", "_total", "_v").agg(F.count(F.lit(1)).alias("_n"))
    inside = Window.partitionBy(*key, "_stretch").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    values = values.withColumn("_first", F.col("_base") + F.coalesce(F.sum("_n").over(inside), F.lit(0)))

    picks = []
    for name, p in probs.items():
        for suffix, rank in (("lo", F.floor(position(p))), ("hi", F.ceil(position(p)))):
            hit = covers(F.col("_first"), F.col("_n"), rank)
            picks.append(F.max(F.when(hit, F.col("_v"))).alias(f"_{name}_{suffix}"))
    picked = values.groupBy(*key).agg(F.max("_total").alias("_total"), *picks)

    def between(name: str, p: float) -> Column:
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        return (lo + (hi - lo) * (position(p) - F.floor(position(p)))).alias(name)

    found = picked.select(*key, *[between(name, p) for name, p in probs.items()])
    return found if also is None else join_on(cuts.drop("_cuts"), found, key, "left")
