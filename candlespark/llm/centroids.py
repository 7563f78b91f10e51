"""Integer k-means in column expressions: literal centroids, ``zip_with`` distances, column sums.

Components become integers, floor(scale * x). Every round is one scan of the quantised vectors: the distance to each literal
centroid array comes from ``aggregate(zip_with(...))``, ``array_min`` of ``(distance, number)`` structs chooses the cluster, and one
``sum`` per component with map-side combine gives the new centroids. Only ``k`` rows of sums reach the driver, whatever
the number of vectors.

Edge cases: vectors that are null, have another number of components, or hold a null or non-finite component take no part. A
component beyond ``LIMIT`` after scaling raises an error, so that no distance can leave a long. A null ``vec_id`` is
clustered, and as a seed comes after all others; seeds with equal ids are ordered by their components. With fewer vectors than
``k`` there are as many centroids as vectors; an empty table gives no rows. Repeated rows count as often as they occur. Empty
clusters keep their centroid. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlespark.session import materialize

#: Largest size of a scaled component: 64 squared differences of twice this fit a long 16 times over.
LIMIT = 2**26


def quantised(vectors: DataFrame, size: int, scale: int) -> DataFrame:
    """``vec_id, x, square``: the vectors that take part as integers, and their squared lengths."""
    x = F.col("embedding")
    good = (F.size(x) == size) & F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    scaled = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")))
    fits = F.forall(scaled, lambda c: F.abs(c) <= LIMIT)
    checked = F.when(fits, scaled).otherwise(F.raise_error(F.lit(f"a scaled component exceeds {LIMIT}")).cast("array<bigint>"))
    points = vectors.select("vec_id", "embedding").where(good).select("vec_id", checked.alias("x"))
    return points.withColumn("square", product(F.col("x"), F.col("x")))


def seeds(points: DataFrame, k: int, salt: str) -> list[list[int]]:
    """The ``k`` vectors with the smallest SHA-256 of ``salt:vec_id``, in that order."""
    order = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    return [list(row.x) for row in points.orderBy(order.asc_nulls_last(), "x").limit(k).select("x").collect()]


def literal(centroids: list[list[int]]) -> Column:
    """The centroids and their squared lengths as one constant array."""
    each = [f"named_struct('x', array({', '.join(f'{x}L' for x in c)}), 'square', {sum(x * x for x in c)}L)" for c in centroids]
    return F.expr(f"array({', '.join(each)})")


def product(x: Column, y: Column) -> Column:
    """Inner product of two integer arrays."""
    return F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0).cast("bigint"), lambda total, p: total + p)


def assigned(points: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Adds ``nearest``: distance and number of the nearest centroid, the smaller number of equals."""
    # |x - c|^2 from the inner product: one multiplication per component inside the lambda, which is not compiled.
    away = lambda c: F.col("square") + c["square"] - 2 * product(F.col("x"), c["x"])
    each = F.transform(literal(centroids), lambda c, i: F.struct(away(c).alias("distance"), i.alias("cluster")))
    return points.withColumn("nearest", F.array_min(each))


def updated(points: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Componentwise floor of the mean of each cluster's vectors; exact, since the division is of integers."""
    size = len(centroids[0])
    flat = assigned(points, centroids).selectExpr("nearest.cluster", *[f"bigint(x[{i}]) x{i}" for i in range(size)])
    sums = flat.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *[F.expr(f"sum(x{i}) x{i}") for i in range(size)]).collect()
    moved = list(centroids)
    for row in sums:
        moved[row.cluster] = [row[f"x{i}"] // row.n for i in range(size)]
    return moved


def cluster(vectors: DataFrame, size: int = 64, scale: int = 64, k: int = 16, rounds: int = 3, salt: str = "1") -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector that takes part."""
    points = materialize(quantised(vectors, size, scale), "cluster-points")
    centroids = seeds(points, k, salt)
    if not centroids:
        empty = "cast(null AS int) cluster, cast(null AS bigint) distance, cast(null AS bigint) cluster_inertia, cast(null AS bigint) inertia, '' centroid_sha256"
        return points.where("false").selectExpr("vec_id", *empty.split(", "))
    for _ in range(rounds):
        centroids = updated(points, centroids)
    placed = materialize(assigned(points, centroids).select("vec_id", "nearest.cluster", "nearest.distance"), "cluster-rows")
    inertia = [0] * len(centroids)
    for row in placed.groupBy("cluster").agg(F.sum("distance").alias("total")).collect():
        inertia[row.cluster] = row.total
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return placed.select(
        "vec_id", "cluster", "distance",
        F.get(F.array(*[F.lit(x).cast("bigint") for x in inertia]), "cluster").alias("cluster_inertia"),
        F.lit(sum(inertia)).cast("bigint").alias("inertia"),
        F.get(F.array(*map(F.lit, digests)), "cluster").alias("centroid_sha256"),
    )
