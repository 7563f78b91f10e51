"""Exact top-k search by inner product, with vectors bucketed by norm.

Vectors are put into buckets of nearly equal norm and each bucket into blocks of bounded size; a block is one row
with its ids and a packed matrix, longest vectors first. The queries are packed into blocks as well. A first pass
against one block of the longest vectors and one from the middle gives each query a threshold: its k-th best score so
far. The least length that a vector needs for any threshold of a query block decides which buckets the block meets at
all; other pairs are never made. In the second pass a query's threshold, divided by its norm and the block's
largest, is its local cosine threshold. Above 1 the block is skipped. Otherwise the query prunes by length (a
prefix of the block) or, where the cosine threshold is high enough to leave a narrow interval on the query's largest
coordinate, by that coordinate; the products of what remains are computed in full.

Edge cases: vectors that are null or hold null or non-finite components, and rows with a null id, take no part. Only
vectors of equal length are compared. Rows that share the query's id are its own and no candidates. Ties go to the
smaller id, repeated candidate rows count one by one. Extra columns are ignored. Scores are exact 64-bit integers, also
beyond 2^53; a score whose products reach 2^63 when summed without their signs fails the query with a message.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlespark.session import materialize

BLOCK_ROWS, QUERY_ROWS = 4096, 1024
#: Buckets per doubling of the norm.
STEPS = 16
#: ``step`` is the norm bucket, ``most`` the largest norm; the matrix holds 32 or, where needed, 64-bit integers.
PACKED = "part int, dim int, step int, most double, ids binary, matrix binary"
#: Sums of products from here on may not fit 64 bits (2^63, less what rounding can hide).
BEYOND = 9.2233e18


def scaled(vector: Column, scale: int = 256) -> Column:
    """Components times ``scale``, rounded down; null for a vector that takes no part."""
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    valid = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(F.coalesce(valid, F.lit(False)), whole)


def _packed(rows: DataFrame, ordered: bool) -> DataFrame:
    """One row per ``part``; a part has bounded rows."""

    def pack(frame):
        import numpy as np
        import pandas as pd

        matrix = np.stack(frame.vector).astype("int64")
        ids = frame.id.to_numpy("int64")
        square = (matrix.astype("float64") ** 2).sum(1)
        if ordered:
            order = np.lexsort((ids, -square))
            matrix, ids = matrix[order], ids[order]
        narrow = np.abs(matrix.astype("float64")).max() < 2**31
        packed = matrix.astype("int32" if narrow else "int64").tobytes()
        first = {c: frame[c].iloc[:1] for c in ("part", "step")}
        return pd.DataFrame(first | {"dim": [matrix.shape[1]], "most": [float(np.sqrt(square.max()))], "ids": [ids.tobytes()], "matrix": [packed]})[COLUMNS]

    COLUMNS = [c.split()[0] for c in PACKED.split(", ")]  # noqa: N806
    return rows.groupBy("part").applyInPandas(pack, PACKED)


def _parts(rows: DataFrame, keys: list[str], most: int) -> DataFrame:
    """Adds ``part``, dense numbers; rows of one part agree in ``keys`` and are about ``most`` at the most."""
    # A row per dimension and norm step: few, whatever the data.
    counts = rows.groupBy(*keys).agg(F.count("*").alias("n")).withColumn("cut", F.ceil(F.col("n") / most).cast("int"))
    before = Window.orderBy(*[F.col(k).desc() for k in keys]).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("base", F.coalesce(F.sum("cut").over(before), F.lit(0)).cast("int"))
    numbered = rows.join(counts, keys)
    return numbered.withColumn("part", F.col("base") + F.pmod(F.xxhash64("id", "vector"), F.col("cut")).cast("int"))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256) -> DataFrame:
    """``query_id, rank, vec_id, score`` from ``vec_id, embedding``; ``is_query`` marks the queries."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("id"), scaled(F.col("embedding"), scale).alias("vector"), is_query.alias("asks"))
    rows = rows.filter("id IS NOT NULL AND vector IS NOT NULL AND size(vector) > 0").withColumn("dim", F.size("vector"))
    norm = F.aggregate("vector", F.lit(0.0), lambda t, x: t + x.cast("double") * x)
    rows = rows.withColumn("step", F.floor(F.log2(F.greatest(norm, F.lit(1.0))) / 2 * STEPS).cast("int"))
    blocks = materialize(_packed(_parts(rows.drop("asks"), ["dim", "step"], BLOCK_ROWS), True), "topk-blocks")
    asked = materialize(_packed(_parts(rows.filter("asks").drop("asks").withColumn("step", F.lit(0)), ["dim"], QUERY_ROWS), False), "topk-queries")
    asking = asked.select("dim", *[F.col(c).alias(f"query_{c}") for c in ("part", "ids", "matrix")])
    # A row per dimension and norm bucket, whose blocks have neighbouring numbers.
    buckets = blocks.groupBy("dim", "step").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.max("most").alias("most"))

    def meet(pairs: DataFrame) -> DataFrame:
        """Compares the pairs of a query block and the number of a vector block."""
        columns = ["query_part", "query_ids", "query_matrix", "floors", "dim", "ids", "matrix"]
        # One pair of blocks at a time in a task.
        return pairs.join(blocks.drop("step", "most"), ["part", "dim"]).select(*columns).mapInPandas(compare, FOUND)

    def compare(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        def matrix(raw, dim, rows):
            return np.frombuffer(raw, "int32" if len(raw) == 4 * dim * rows else "int64").reshape(rows, dim)

        def product(x, q):
            """Exact scores: doubles hold them up to 2^53, else 64-bit integers do if the products, without signs, fit."""
            if x.dtype == np.float64:
                return (x @ q).astype("int64")
            reach = np.abs(x.astype("float64")) @ np.abs(q.astype("float64"))
            if len(reach) and reach.max() > BEYOND:
                raise ValueError("a score does not fit a 64-bit integer: components are too large for this scale")
            return x @ q

        def best(q, qid, x, ids, norms, floor):
            """At most k of the rows that may reach the floor: ids and scores."""
            length = float(np.sqrt((q.astype("float64") ** 2).sum()))
            if floor > 0 and length > 0:
                local = floor / (length * norms[0]) if norms[0] else 2.0
                if local > 1 + 1e-9:
                    return ids[:0], ids[:0]
                # Length: only the prefix of vectors that are long enough.
                x = x[: np.searchsorted(-norms, -(floor / length) * (1 - 1e-9), "right")]
                f = int(np.argmax(np.abs(q.astype("float64"))))
                share = float(q[f]) / length
                if local * local + share * share > 1:
                    # Coordinate: a unit vector within the angle has its coordinate f near the query's.
                    slack = np.sqrt(max(0.0, 1 - local * local) * max(0.0, 1 - share * share)) + 1e-9
                    unit = x[:, f] / norms[: len(x)]
                    keep = np.flatnonzero((unit >= local * share - slack) if share > 0 else (unit <= local * share + slack))
                    x, ids = x[keep], ids[keep]
            ids = ids[: len(x)]
            scores = product(x, q)
            keep = np.flatnonzero((scores >= floor) & (ids != qid))
            if len(keep) > k:
                least = np.partition(scores[keep], len(keep) - k)[len(keep) - k]
                keep = keep[scores[keep] >= least]
                keep = keep[np.lexsort((ids[keep], -scores[keep]))[:k]]
            return ids[keep], scores[keep]

        for batch in batches:
            for row in batch.itertuples():
                ids, asking = np.frombuffer(row.ids, "int64"), np.frombuffer(row.query_ids, "int64")
                x, q = matrix(row.matrix, row.dim, len(ids)), matrix(row.query_matrix, row.dim, len(asking))
                norms = np.sqrt((x.astype("float64") ** 2).sum(1))
                largest = np.abs(x.astype("float64")).max() * np.abs(q.astype("float64")).max()
                x, q = (m.astype("float64" if largest * row.dim < 2**53 else "int64") for m in (x, q))
                floors = np.frombuffer(row.floors, "int64") if row.floors is not None else np.full(len(q), NONE)
                hits = [best(q[i], asking[i], x, ids, norms, floors[i]) for i in range(len(q))]
                sizes = [len(h[0]) for h in hits]
                yield pd.DataFrame(
                    {
                        "query_part": row.query_part,
                        "place": np.repeat(np.arange(len(q)), sizes),
                        "query_id": np.repeat(asking, sizes),
                        "vec_id": np.concatenate([h[0] for h in hits]).astype("int64"),
                        "score": np.concatenate([h[1] for h in hits]),
                    }
                )

    NONE = -(2**63)  # noqa: N806
    FOUND = "query_part int, place int, query_id bigint, vec_id bigint, score bigint"  # noqa: N806
    ranking = Window.partitionBy("query_part", "place").orderBy(F.col("score").desc(), "vec_id")
    if asked.isEmpty():
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    # First pass: per dimension the first block (longest vectors) and one from the middle.
    chosen = blocks.groupBy("dim").agg(F.min("part").alias("a"), F.percentile_approx("part", 0.5).alias("b"))
    chosen = chosen.select("dim", F.explode(F.array_distinct(F.array("a", "b"))).alias("part"))
    first = meet(asking.withColumn("floors", F.lit(None).cast("binary")).join(chosen, "dim"))
    kth = first.withColumn("rank", F.row_number().over(ranking)).filter(F.col("rank") == k).select("query_part", "place", "score")

    def floors(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        for batch in batches:
            for row in batch.itertuples():
                rows = len(row.query_ids) // 8
                q = np.frombuffer(row.query_matrix, "int32" if len(row.query_matrix) == 4 * row.dim * rows else "int64")
                lengths = np.sqrt((q.reshape(rows, row.dim).astype("float64") ** 2).sum(1))
                values = np.full(rows, NONE)
                for known in row.known if row.known is not None else ():
                    values[known["place"]] = known["score"]
                # No threshold above zero, no length that is needed.
                need = np.where(values > 0, values / np.maximum(lengths, 1e-300), 0.0).min()
                yield pd.DataFrame({"query_part": [row.query_part], "floors": [values.tobytes()], "need": [float(need)]})

    # At most a score per row of the block.
    known = kth.groupBy("query_part").agg(F.collect_list(F.struct("place", "score")).alias("known"))
    blockwise = asking.join(known, "query_part", "left").mapInPandas(floors, "query_part int, floors binary, need double")
    thresholds = materialize(blockwise, "topk-floors")
    # Only buckets with vectors long enough for some query of the block.
    pairs = asking.join(thresholds, "query_part").join(buckets, "dim").filter(F.col("most") >= F.col("need") * (1 - 1e-9))
    pairs = pairs.withColumn("part", F.explode(F.sequence("low", "high"))).drop("low", "high", "most", "step", "need")
    found = meet(pairs).withColumn("rank", F.row_number().over(ranking)).filter(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")
