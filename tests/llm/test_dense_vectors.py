"""Near-duplicate vectors in tables where few pivots lie apart: links are compared with brute force."""

from __future__ import annotations

import numpy as np

from hearthwatt.llm import vectors
from test_contracts import roots

SCHEMA = "vec_id long, embedding array<double>"


def check(spark, groups):
    """``groups``: arrays of vectors, one per length."""
    rows, links = [], []
    for group in groups:
        unit = group / np.sqrt((group ** 2).sum(axis=1))[:, None]
        links += [(len(rows) + i, len(rows) + j) for i, j in zip(*np.nonzero(np.triu(unit @ unit.T >= 0.95, 1)))]
        rows += [(len(rows) + i, v.tolist()) for i, v in enumerate(group)]
    counts = np.bincount(np.array(links).ravel(), minlength=len(rows))
    component = roots(range(len(rows)), links)
    got = vectors.linked_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == \
        [(i, counts[i], component[i], component[i] == i) for i in range(len(rows))]
    return len(links)


def test_two_near_copies(spark):
    assert check(spark, [np.array([[1.0, 0.0], [0.97, np.sqrt(1 - 0.97 ** 2)]])]) == 1


def test_one_dense_group(spark):
    rng = np.random.default_rng(5)
    assert check(spark, [rng.normal(0, 1, 16) + rng.normal(0, 0.15, (1500, 16))]) > 1000


def test_common_direction_and_near_copies(spark):
    rng = np.random.default_rng(6)
    spread = 2 * np.ones(32) + rng.normal(0, 1, (300, 32))
    assert 200 <= check(spark, [np.concatenate([spread, spread[:200] + rng.normal(0, 0.1, (200, 32))])]) < 5000


def test_lengths_have_their_own_pivots(spark):
    rng = np.random.default_rng(7)
    groups = [rng.normal(0, 1, (n, length)) for n, length in ((3, 4), (400, 48), (300, 64), (1, 9))]
    groups = [np.concatenate([g, g + rng.normal(0, 0.02, g.shape)]) for g in groups]
    assert check(spark, groups) >= 700
    chosen = vectors._pivots_by_length(spark.createDataFrame(
        [(np.ascontiguousarray(v / np.sqrt(v @ v)).tobytes(),) for g in groups for v in g], "unit binary"))
    assert sorted(chosen) == [48, 64] and sum(len(p) for _, p in chosen.values()) == max(f + len(p) for f, p in chosen.values())
