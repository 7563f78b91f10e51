"""Integer clustering against a plain loop."""

import hashlib
import math
import random

import pytest

from candlespark.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, cluster string, x int, square double"


def brute(rows, size, scale, k, rounds):
    points = [(i, [math.floor(scale * c) for c in e]) for i, e in rows if e is not None and len(e) == size and all(c is not None and math.isfinite(c) for c in e)]
    order = lambda p: (p[0] is None, hashlib.sha256(f"1:{p[0]}".encode()).hexdigest() if p[0] is not None else "", p[1])
    centers = [p for _, p in sorted(points, key=order)[:k]]

    def nearest(p):
        return min((sum((a - b) ** 2 for a, b in zip(p, c)), n) for n, c in enumerate(centers))

    for _ in range(rounds):
        groups = {}
        for _, p in points:
            groups.setdefault(nearest(p)[1], []).append(p)
        for n, members in groups.items():
            centers[n] = [sum(column) // len(members) for column in zip(*members)]
    placed = [(i, *nearest(p)[::-1]) for i, p in points]
    total = lambda n: sum(d for _, c, d in placed if n in (None, c))
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted([(i, c, d, total(c), total(None), digest[c]) for i, c, d in placed], key=str)


def test_clusters(spark):
    rng = random.Random(3)
    rows = [(i, [float(rng.randint(-40, 40)) / 16 for _ in range(4)]) for i in range(200)]
    rows += [(200 + i, rows[7][1]) for i in range(40)] + [rows[3], rows[3], (3, [0.0] * 4)]
    rows += [(None, rows[9][1]), (None, [9.0, -9.0, 9.0, 9.0]), (300, None), (301, []), (302, [1.0] * 3), (303, [1.0, None, 0.0, 0.0]), (304, [float("nan")] * 4), (305, [float("-inf")] * 4)]
    frame = spark.createDataFrame([(*r, "a", 1, 0.5) for r in rows], SCHEMA)
    for k in (1, 16, 400):
        got = centroids.cluster(frame, size=4, scale=8, k=k).collect()
        assert sorted(map(tuple, got), key=str) == brute(rows, 4, 8, k, 3)


def test_no_vectors(spark):
    for rows in ([], [(1, None, "a", 1, 0.5)]):
        result = centroids.cluster(spark.createDataFrame(rows, SCHEMA))
        assert result.count() == 0
        assert result.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_too_large_components_are_refused(spark):
    with pytest.raises(Exception, match="exceeds"):
        centroids.cluster(spark.createDataFrame([(1, [3e8] * 4, "a", 1, 0.5)], SCHEMA), size=4).collect()
