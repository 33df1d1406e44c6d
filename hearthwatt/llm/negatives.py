"""Hard-negative mining: threshold joins over an inverted index whose thresholds sink until every window is full."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from hearthwatt.llm.clusters import finite, whole
from hearthwatt.llm.frames import spread, stored, table
from hearthwatt.llm.registry import query
from hearthwatt.sources.shared import run_folder

POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
SCALE, LABELS = 256, 10
#: Anchors that are broadcast at once: at most so many, and at most so many components together.
BLOCK_ANCHORS, BLOCK_COMPONENTS = 2048, 1 << 20
#: Within a task, anchors joined at once, rows indexed at once, and neighbouring dimensions that share a posting list.
TILE, ROWS, GROUP = 256, 4096, 8
#: Where thresholds start between the least and the largest score that counts, and how they sink while windows have room.
SINKING = (0.7, 0.35, 0.0)

_FOUND = "window int, score long, vec_id long, row long"
_NO_ID = np.iinfo(np.int64).max


@dataclass
class Block:
    """Anchors, and the windows to fill for each: the ``want`` best rows of the same or of other labels, from low to high."""
    vectors: np.ndarray
    labels: np.ndarray
    rows: np.ndarray
    owner: np.ndarray  # anchor of each window, ascending
    low: np.ndarray
    high: np.ndarray
    want: int
    same: bool


class Index:
    """Inverted index over some rows for one level of thresholds.

    Dimensions are ordered by their share of the rows' squares. The trailing dimensions of a row are left out where their
    norm alone can't lift any anchor to its threshold. Rows with more dimensions come first, so a posting list is a range.
    """

    def __init__(self, rows: np.ndarray):
        self.order = np.argsort(-(rows.astype(np.float64) ** 2).sum(axis=0), kind="stable")
        self.rows, self.rest = self.arranged(rows)
        self.groups = self.rest.shape[1] - 1

    def arranged(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Vectors in the order of dimensions, and the norm of what is left of each from every group on."""
        out = vectors[:, self.order]
        squares = np.add.reduceat(out.astype(np.float64) ** 2, np.arange(0, out.shape[1], GROUP), axis=1)
        rest = np.sqrt(np.cumsum(squares[:, ::-1], axis=1)[:, ::-1]) * (1 + 1e-9)
        return out, np.concatenate([rest, np.zeros((len(out), 1))], axis=1)

    def join(self, anchors: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchor, row and score of all pairs with a score of at least the anchor's threshold."""
        anchors, rest = self.arranged(anchors)
        floor = least - 1 - np.abs(least) * 1e-12  # bounds are rounded, so they get some room
        reach = np.where(floor > 0, floor / np.maximum(rest[:, 0], 1e-300), -1.0).min()
        depth = (self.rest[:, :-1] >= reach).sum(axis=1)
        live = np.argsort(-depth, kind="stable")
        live = live[depth[live] > 0]
        scores = np.zeros((len(anchors), len(live)), anchors.dtype)
        for g in range(self.groups):
            listed = np.searchsorted(-depth[live], -g, side="left")  # rows whose list goes on to this group
            if not listed:
                break
            some = slice(g * GROUP, (g + 1) * GROUP)
            scores[:, :listed] += anchors[:, some] @ self.rows[live[:listed], some].T
            bound = scores[:, :listed] + rest[:, g + 1, None] * self.rest[live[:listed], g + 1][None]
            kept = np.ones(len(live), bool)
            kept[:listed] = (bound >= floor[:, None]).any(axis=0)
            if kept.sum() < 0.8 * len(live):
                live, scores = live[kept], scores[:, kept]
        end = depth[live]
        a, at = np.nonzero(scores + rest[:, end] * self.rest[live, end][None] >= floor[:, None])
        score, row, end = scores[a, at], live[at], end[at]
        for g in range(int(end.min()) if len(end) else self.groups, self.groups):  # what the index has left out
            some, out = slice(g * GROUP, (g + 1) * GROUP), end <= g
            score[out] += (anchors[a[out], some] * self.rows[row[out], some]).sum(axis=1)
            kept = ~out | (score + rest[a, g + 1] * self.rest[row, g + 1] >= floor[a])
            a, row, score, end = a[kept], row[kept], score[kept], end[kept]
        score = score.astype(np.int64)
        kept = score >= least[a]
        return a[kept], row[kept], score[kept]


class Best:
    """What a task has found so far for the windows of one tile of anchors: the ``want`` first of each."""

    def __init__(self, block: Block, first: int, last: int):
        self.block, self.first, self.last = block, first, last
        self.windows = np.arange(*np.searchsorted(block.owner, [first, last]))
        self.begin = np.searchsorted(block.owner, np.arange(first, last + 1))
        self.found = [np.empty(0, np.int64)] * 4  # window, score, id, row
        self._count()

    def _count(self) -> None:
        """Rows found per window, and the score below which a row no longer counts for it."""
        n = np.bincount(self.found[0], minlength=len(self.block.owner))[self.windows]
        worst = np.full(len(self.block.owner), _NO_ID)
        np.minimum.at(worst, self.found[0], self.found[1])
        self.full = n >= self.block.want
        self.least = np.where(self.full, np.maximum(worst[self.windows], self.block.low[self.windows]), self.block.low[self.windows])

    def add(self, a: np.ndarray, score: np.ndarray, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> None:
        block = self.block
        fits = (block.labels[self.first + a] == labels) & (block.rows[self.first + a] != rows) if block.same \
            else block.labels[self.first + a] != labels
        a, score, ids, rows = a[fits], score[fits], ids[fits], rows[fits]
        parts = [self.found]
        for k in range(int(np.diff(self.begin).max(initial=0))):  # the k-th window of each anchor
            window = self.begin[a] + k
            there = window < self.begin[a + 1]
            w = window[there]
            s = score[there]
            inside = (s >= self.least[w - self.begin[0]]) & (s <= block.high[w])
            parts.append([w[inside], s[inside], ids[there][inside], rows[there][inside]])
        window, score, ids, rows = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((rows, ids, -score, window))
        window, score, ids, rows = window[order], score[order], ids[order], rows[order]
        place = np.arange(len(window)) - np.searchsorted(window, window)
        kept = place < block.want
        self.found = [x[kept] for x in (window, score, ids, rows)]
        self._count()

    def search(self, index: Index, anchors: np.ndarray, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> None:
        """Threshold joins with the indexed rows; an anchor's threshold sinks until its windows are full or end."""
        block, owner = self.block, self.block.owner[self.windows] - self.first
        most = np.ceil(np.sqrt((anchors.astype(np.float64) ** 2).sum(axis=1)) * index.rest[:, 0].max(initial=0)).astype(np.int64) + 1
        top = np.full(len(anchors), -_NO_ID)
        np.maximum.at(top, owner, block.high[self.windows])
        top = np.minimum(top, most)
        room = np.zeros(len(anchors), bool)
        np.logical_or.at(room, owner, ~self.full)

        def bottom() -> np.ndarray:
            out = np.full(len(anchors), _NO_ID)
            np.minimum.at(out, owner, self.least)
            return np.maximum(out, -most)

        before = top + 1
        todo = np.flatnonzero(bottom() <= top)
        for share in SINKING:
            if not len(todo):
                break
            low = bottom()[todo]
            # windows that were full before need one join only, at the score that still counts
            least = low + np.floor(np.where(room[todo], share, 0.0) * (top[todo] - low)).astype(np.int64)
            a, row, score = index.join(anchors[todo], least)
            fresh = score < before[todo][a]  # the others were found at a higher threshold
            a, row, score = todo[a[fresh]], row[fresh], score[fresh]
            self.add(a, score, ids[row], labels[row], rows[row])
            before[todo] = least
            todo = todo[bottom()[todo] < least]


def _padded(column: pa.Array) -> np.ndarray:
    """Lists as rows of a matrix; a shorter one ends in zeros."""
    sizes = np.diff(column.offsets.to_numpy()) if len(column) else np.empty(0, np.int64)
    width, values = int(sizes.max(initial=0)), column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width)[None] < sizes[:, None]] = values
    return out


def _alike(rows: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in one width, of one column at least, and in a type that holds every partial score exactly."""
    width = max(rows.shape[1], anchors.shape[1], 1)
    rows, anchors = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (rows, anchors))
    bound = np.prod([np.sqrt((x.astype(np.float64) ** 2).sum(axis=1).max(initial=0)) for x in (rows, anchors)])
    if bound >= 2.0 ** 61:
        raise ValueError("scores would not fit in 64 bits")
    return (rows.astype(np.float64), anchors.astype(np.float64)) if bound < 2.0 ** 52 else (rows, anchors)


def _search(block):
    def run(batches):
        task: Block = block.value
        best = [Best(task, i, min(i + TILE, len(task.rows))) for i in range(0, len(task.rows), TILE)]
        best = [b for b in best if len(b.windows)]
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                vectors, anchors = _alike(_padded(part.column("vector")), task.vectors)
                index = Index(vectors)
                ids = part.column("vec_id").fill_null(_NO_ID).to_numpy()
                labels, rows = part.column("label").to_numpy(), part.column("row").to_numpy()
                for b in best:
                    b.search(index, anchors[b.first:b.last], ids, labels, rows)
        for b in best:
            window, score, ids, rows = b.found
            yield pa.RecordBatch.from_arrays([pa.array(window.astype(np.int32)), pa.array(score), pa.array(ids), pa.array(rows)],
                                             names=["window", "score", "vec_id", "row"])
    return run


def _first(found: DataFrame, want: int) -> DataFrame:
    """The first ``want`` rows of each window over all tasks, each of which has kept as many at most."""
    order = Window.partitionBy("window").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= want)


def _blocks(anchors: DataFrame) -> Iterator[list]:
    """Anchors in blocks of a bounded number of components, streamed through the driver."""
    width = anchors.agg(F.max(F.size("vector"))).first()[0] or 1
    each, rows = max(1, min(BLOCK_ANCHORS, BLOCK_COMPONENTS // max(1, width))), anchors.toLocalIterator()
    while block := list(islice(rows, each)):
        yield block


def hard_negatives(vectors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
                   high: int = HIGH) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for rows ``vec_id, label, vector, anchor``.

    A score is the inner product of two integer vectors (of which a shorter one ends in zeros); higher scores come
    first, then smaller ids. An anchor's positives are its first ``positives`` other rows of the same label. For each of
    them the first ``negatives`` rows of other labels count whose score is from ``low`` to ``high`` percent of the
    positive's. All rows that are as good as asked for are found: thresholds only sink further while a window has room.

    Rows without label or vector take no part; a row without id is no anchor, comes after all ids and stays null in the
    results. Repeated rows are rows of their own. An anchor without other rows of its label, and a positive without
    rows in its window (as all with a score below zero), give no rows, nor does an empty table. Scores from 2**61 on are an error.

    The anchors are a query set: blocks of bounded size are broadcast one after another, and each block is searched in all
    rows, where a task keeps only as many rows per window as are asked for. Nothing is shuffled but those. A task that is
    lost repeats its own search; finished blocks are in the shared folder.
    """
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", "label", "vector", "anchor").where("label IS NOT NULL AND vector IS NOT NULL")
    rows = stored(spread(rows).withColumn("row", F.monotonically_increasing_id()), "labelled-vectors")
    searched = rows.select("vec_id", "label", "vector", "row")
    folder = run_folder(spark, "hard-negatives")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(folder)
    for taken in _blocks(rows.where("anchor AND vec_id IS NOT NULL")):
        width, unbounded = max(len(r["vector"]) for r in taken), np.full(len(taken), _NO_ID)
        block = Block(np.array([r["vector"] + [0] * (width - len(r["vector"])) for r in taken], np.int64).reshape(len(taken), width),
                      np.array([r["label"] for r in taken]), np.array([r["row"] for r in taken]),
                      np.arange(len(taken)), -unbounded, unbounded, positives, True)
        sent = spark.sparkContext.broadcast(block)
        pairs = _first(searched.mapInArrow(_search(sent), _FOUND), positives).orderBy("window", "rank").collect()
        sent.unpersist()
        least, most = ([min(x // 100, _NO_ID) for x in xs] for xs in ([low * r["score"] + 99 for r in pairs], [high * r["score"] for r in pairs]))
        owner = np.array([r["window"] for r in pairs], np.int64)
        block = Block(block.vectors, block.labels, block.rows, owner, np.array(least, np.int64), np.array(most, np.int64), negatives, False)
        sent = spark.sparkContext.broadcast(block)
        named = spark.createDataFrame(
            [(i, taken[r["window"]]["vec_id"], None if r["vec_id"] == _NO_ID else r["vec_id"], r["score"]) for i, r in enumerate(pairs)],
            "window int, anchor_id long, positive_id long, positive_score long")
        found = _first(searched.mapInArrow(_search(sent), _FOUND), negatives).join(named, "window").select(
            "anchor_id", "positive_id", "rank", F.nullif("vec_id", F.lit(_NO_ID)).alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score"))
        found.write.mode("append").parquet(folder)
        sent.unpersist()
    return spark.read.schema(schema).parquet(folder)


def labelled(embeddings: DataFrame, column: str = "embedding", key: str = "vec_id", label: str = "label") -> DataFrame:
    """Rows of ``embeddings`` as integer vectors: every seventh label moved to the next, every hundredth row an anchor."""
    vec_id, given = F.col(key).cast("long"), F.col(label).cast("long")
    moved: Column = F.when(vec_id % 7 == 0, (given + 1) % LABELS).otherwise(given)
    rows = embeddings.where(given.isNotNull() & finite(column))
    return rows.select(vec_id.alias("vec_id"), moved.alias("label"), whole(column, SCALE).alias("vector"),
                       F.coalesce(vec_id % 100 == 0, F.lit(False)).alias("anchor"))


SQL = f"""
WITH item AS MATERIALIZED (
    SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
           list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
pair AS MATERIALIZED (
    SELECT a.row AS anchor, a.vec_id AS anchor_id, b.row AS other, b.vec_id AS other_id, a.label = b.label AS same,
           CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
    FROM item a JOIN item b ON a.row <> b.row WHERE a.vec_id % 100 = 0),
positive AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other_id, other) AS nth FROM pair WHERE same)
    WHERE nth <= {POSITIVES}),
ranked AS (
    SELECT p.anchor_id, p.other_id AS positive_id, n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.score DESC, n.other_id, n.other) AS nth
    FROM positive p JOIN pair n ON p.anchor = n.anchor
    WHERE NOT n.same AND {LOW} * p.score <= 100 * n.score AND 100 * n.score <= {HIGH} * p.score)
SELECT anchor_id, positive_id, CAST(nth AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE nth <= {NEGATIVES}
"""


@query("op11_hard_negatives", SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(labelled(table(spark, sf_dir, "embeddings")))
