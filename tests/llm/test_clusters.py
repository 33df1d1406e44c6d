"""Centroid clustering compared with brute force: ties, repeated rows, bad vectors, few rows, exact floors."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest

from hearthwatt.llm import clusters

SCHEMA = "vec_id long, embedding array<double>, distance string, cluster string"


def brute(rows, k, rounds, width, scale, seed=3):
    kept = [(i, [int(np.floor(scale * x)) for x in v]) for i, v, *_ in rows
            if v is not None and len(v) == width and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    centroids = [v for _, v in first]
    far = lambda v, c: sum((x - y) ** 2 for x, y in zip(v, c))
    near = lambda v: min((far(v, c), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        number = [near(v)[1] for _, v in kept]
        for j in range(len(centroids)):
            own = [v for (_, v), c in zip(kept, number) if c == j]
            if own:
                centroids[j] = [sum(x) // len(own) for x in zip(*own)]
    return sorted(((i, v, *near(v)[::-1]) for i, v in kept), key=repr), centroids


def check(spark, rows, k=4, rounds=5, width=3, scale=16):
    got, centroids = clusters.cluster_vectors(spark.createDataFrame(rows, SCHEMA), k=k, rounds=rounds, dimensions=width, scale=scale)
    want, known = brute(rows, k, rounds, width, scale)
    assert got.columns == ["vec_id", "vector", "cluster", "distance"]
    assert sorted(map(tuple, got.collect()), key=repr) == want and centroids == known
    return len(want)


@pytest.mark.parametrize("width", [1, 2, 9, 64])
def test_against_all_distances(spark, width):
    rng = np.random.default_rng(width)
    rows = [(i, (rng.normal(0, 1, width) + (i % 3)).tolist(), "x", "y") for i in range(150)]
    assert check(spark, rows, k=5, rounds=10, width=width, scale=8) == 150


def test_nearest_of_many_centroids():
    """The walk stops early and still gives the nearest, the smaller number where two are as near."""
    rng = np.random.default_rng(4)
    for k, width in ((1, 1), (2, 3), (40, 2), (60, 17)):
        centroids = rng.integers(-6, 6, (k, width))
        vectors = rng.integers(-8, 8, (500, width))
        number, distance = clusters.SortedLists(centroids).nearest(vectors)
        all_of_them = ((vectors[:, None] - centroids[None]) ** 2).sum(axis=2)
        assert (number == all_of_them.argmin(axis=1)).all() and (distance == all_of_them.min(axis=1)).all()


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.5, -0.01], "a", "b"), (1, [0.5, -0.5, -0.01], "a", "b"), (1, [2.0, 2.0, 2.0], "a", "b"), (2, None, "a", "b"),
            (3, [], "a", "b"), (4, [1.0, 2.0], "a", "b"), (5, [1.0, None, 2.0], "a", "b"), (6, [nan, 1.0, 1.0], "a", "b"),
            (7, [inf, 1.0, 1.0], "a", "b"), (8, [1.0, 1.0, 1.0, 1.0], "a", "b"), (None, [3.0, 3.0, 3.0], None, None), (9, [-7.3, 0.0, 1e-9], None, None)]
    assert check(spark, rows) == 5
    assert check(spark, rows, k=20) == 5  # fewer vectors than centroids
    assert check(spark, rows, rounds=0) == 5
    assert check(spark, rows[3:5]) == 0 and check(spark, []) == 0


def test_equal_vectors_tie(spark):
    assert check(spark, [(i, [1.0, 1.0, 1.0], "a", "b") for i in range(30)]) == 30


def test_too_large(spark):
    with pytest.raises(Exception, match="not be exact"):
        clusters.cluster_vectors(spark.createDataFrame([(1, [1e9, 0.0, 0.0], "a", "b")], SCHEMA), dimensions=3)[0].count()
