"""Hard negatives compared with brute force: ties, repeated rows, missing ids, short and empty vectors, large numbers."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearthwatt.llm import negatives

SCHEMA = "vec_id long, label long, vector array<long>, anchor boolean"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, positives=5, wanted=10, low=30, high=90):
    """Every score of every anchor, in plain Python."""
    rows = [r for r in rows if r[1] is not None and r[2] is not None]
    place = lambda r: (r[0] is None, r[0] or 0)
    out = []
    for a in (r for r in rows if r[3] and r[0] is not None):
        scored = sorted(((-sum(x * y for x, y in zip(a[2], r[2])), place(r), r) for r in rows if r is not a), key=lambda s: s[:2])
        for p, _, positive in [s for s in scored if s[2][1] == a[1]][:positives]:
            fits = [s for s in scored if s[2][1] != a[1] and low * -p <= 100 * -s[0] <= high * -p][:wanted]
            out += [(a[0], positive[0], k + 1, r[0], -p, -n) for k, (n, _, r) in enumerate(fits)]
    return sorted(out, key=repr)


def check(spark, rows, **options):
    got = negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA), **{k.replace("wanted", "negatives"): v for k, v in options.items()})
    assert got.columns == COLUMNS
    want = brute(rows, **options)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    return len(want)


def some(rng, n, width, spread, labels=3):
    """Vectors around one centre, many of them repeated."""
    base = rng.integers(-spread, spread, (n, width)) + rng.integers(-spread, spread, width)
    base[n // 2:n // 2 + n // 4] = base[0]
    return [(int(i), int(rng.integers(labels)), base[i].tolist(), i % 9 == 0) for i in range(n)]


@pytest.mark.parametrize("width", [1, 3, 8, 21])
def test_against_all_scores(spark, width):
    rng = np.random.default_rng(width)
    assert check(spark, some(rng, 200, width, 12)) > 100
    assert check(spark, some(rng, 120, width, 2), positives=3, wanted=4, low=10, high=100) > 50


def test_blocks_tiles_and_slices(spark, monkeypatch):
    """Many blocks of anchors, and small slices of rows in one task, give what one block gives."""
    rows = some(np.random.default_rng(8), 300, 10, 20)
    monkeypatch.setattr(negatives, "BLOCK_ANCHORS", 7)
    assert len(list(negatives._blocks(spark.createDataFrame(rows, SCHEMA).where("anchor")))) == 5
    assert check(spark, rows) > 100


def test_small_slices():
    """Index and state over slices of 16 rows, without Spark."""
    rows = some(np.random.default_rng(9), 200, 12, 20)
    vectors, labels = np.array([r[2] for r in rows], float), np.array([r[1] for r in rows])
    anchors = np.flatnonzero([r[3] for r in rows])
    block = negatives.Block(vectors[anchors].astype(np.int64), labels[anchors], anchors, np.arange(len(anchors)),
                            np.full(len(anchors), -negatives._NO_ID), np.full(len(anchors), negatives._NO_ID), 5, True)
    best = negatives.Best(block, 0, len(anchors))
    for first in range(0, 200, 16):
        at = np.arange(first, min(first + 16, 200))
        best.search(negatives.Index(vectors[at]), vectors[anchors], at, labels[at], at)
    for k, a in enumerate(anchors):
        score = vectors @ vectors[a]
        want = sorted((-score[i], i) for i in range(200) if labels[i] == labels[a] and i != a)[:5]
        assert [(-s, i) for w, s, i in zip(*best.found[:3]) if w == k] == want


def test_index_omits_what_cannot_matter():
    """Trailing dimensions and short rows stay out of the posting lists, and no pair is lost by it."""
    rng = np.random.default_rng(10)
    rows = np.round(rng.normal(0, 1, (400, 32)) * 2.0 ** -np.arange(32) * 4096)
    index, anchors = negatives.Index(rows), rows[:20]
    least = ((anchors ** 2).sum(axis=1) * 0.7).astype(np.int64)
    a, row, score = index.join(anchors, least)
    full = anchors @ rows.T
    assert sorted(zip(a.tolist(), row.tolist(), score.tolist())) == sorted((i, j, int(full[i, j])) for i, j in zip(*np.nonzero(full >= least[:, None])))
    reach = (least / np.sqrt((anchors ** 2).sum(axis=1))).min()
    assert (index.rest[:, 1] < reach).mean() > 0.5


def test_odd_rows(spark):
    rows = [(9, 1, [3, 0, 2], True), (9, 1, [3, 0, 2], True), (18, 1, [], True), (27, 2, [0, 0, 0], True), (None, 1, [2, 1, 1], True),
            (None, 2, [1, 0, 1], False), (1, 2, [1], False), (2, 2, [1, 0, 2, 5], False), (3, None, [9, 9, 9], False), (4, 2, None, True),
            (5, 1, [-3, 0, -2], True), (6, 2, [2, 0, 0], False), (7, 1, [1, 0, 1], False), (8, 3, [1, 1, 1], False), (10, 2, [0, 0, 0], False)]
    assert check(spark, rows) > 5
    assert check(spark, rows, low=0, high=100) > 5
    assert check(spark, []) == 0
    assert check(spark, [(1, 1, [1], False)]) == 0


def test_scores_beyond_doubles(spark):
    """Products above 2**53 stay exact; those that don't fit in 64 bits are an error."""
    rng = np.random.default_rng(11)
    rows = [(i, int(i % 3), (rng.integers(0, 50, 4) + 400_000_000).tolist(), i % 10 == 0) for i in range(60)]
    assert check(spark, rows, low=99, high=100) > 10
    with pytest.raises(Exception, match="64 bits"):
        negatives.hard_negatives(spark.createDataFrame([(0, 1, [2 ** 40], True), (1, 1, [2 ** 40], False)], SCHEMA)).count()


def test_query_rows(spark):
    """Labels move, components are floored as doubles, bad vectors and clashing columns do no harm."""
    nan, inf = float("nan"), float("inf")
    rows = [(7, 9, [0.51, -0.001], 5, "x"), (100, 3, [1.0, 0.5], 5, "x"), (None, 4, [0.1], 5, "x"), (1, None, [0.1], 5, "x"), (2, 1, None, 5, "x"),
            (3, 1, [nan], 5, "x"), (4, 1, [inf, 0.0], 5, "x"), (5, 1, [0.1, None], 5, "x"), (6, 1, [], 5, "x")]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>, score int, row string")
    got = negatives.labelled(table).orderBy(F.col("vec_id").asc_nulls_first()).collect()
    assert [tuple(r) for r in got] == [(None, 4, [25], False), (6, 1, [], False), (7, 0, [130, -1], False), (100, 3, [256, 128], True)]
