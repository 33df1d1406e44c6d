"""Centroid clustering of integer vectors; nearest centroids come from the threshold algorithm over sorted lists."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hearthwatt.llm.frames import spread, stored, table
from hearthwatt.llm.registry import query

CLUSTERS, ROUNDS, DIMENSIONS, SCALE, SEED = 8, 10, 64, 1024, 3
#: Largest scaled component; beyond it a squared distance of some thousand components would not fit in 64 bits.
LARGEST = 1 << 25
#: Vectors that walk their lists at once, and dimensions in which they take a step before the frontier is summed again.
ROWS, STEP = 1024, 8


def whole(column: str, scale: int) -> Column:
    """Components as integers, each the floor of ``scale`` times the component in double precision."""
    return F.transform(column, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def finite(column: str) -> Column:
    """Whether an array is there and holds neither nulls nor non-finite numbers."""
    fine = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col(column).isNotNull() & F.coalesce(fine, F.lit(False))


class SortedLists:
    """For each dimension the centroids in ascending order of their component."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.order = np.argsort(centroids, axis=0, kind="stable").T
        self.values = np.take_along_axis(centroids.T, self.order, axis=1)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of each vector's nearest centroid; of equally near ones the smaller number.

        Every dimension's list is walked outward from the vector's own component. A centroid that comes up is measured in
        full. One that has not come up yet is at least as far away in each dimension as the next entry of its list, so a
        vector is done when the squares of these frontiers add up to more than its best distance.
        """
        k, width = self.centroids.shape
        number, distance = np.full(len(vectors), k, np.int64), np.full(len(vectors), np.iinfo(np.int64).max)
        at = np.arange(len(vectors))
        right = (self.values[None] < vectors[:, :, None]).sum(axis=2)
        left, seen = right - 1, np.zeros((len(vectors), k), bool)
        dims, first = np.arange(width), 0
        while len(at):
            some = vectors[at]
            below = np.where(left >= 0, some - self.values[dims, np.maximum(left, 0)], np.iinfo(np.int64).max)
            above = np.where(right < k, self.values[dims, np.minimum(right, k - 1)] - some, np.iinfo(np.int64).max)
            frontier = np.minimum(below, above)
            # a list at its end has shown every centroid
            going = (frontier < np.iinfo(np.int64).max).all(axis=1) & ~seen.all(axis=1)
            going &= (np.where(going[:, None], frontier, 0) ** 2).sum(axis=1) <= distance[at]
            if not going.all():
                at, left, right, seen = at[going], left[going], right[going], seen[going]
                below, above, some = below[going], above[going], some[going]
            chosen = dims[first:first + STEP]
            down = below[:, chosen] <= above[:, chosen]
            place = np.where(down, left[:, chosen], right[:, chosen])
            fresh = np.zeros_like(seen)
            fresh[np.arange(len(at))[:, None], self.order[chosen, place]] = True
            left[:, chosen] -= down
            right[:, chosen] += ~down
            row, found = np.nonzero(fresh & ~seen)
            seen |= fresh
            measured = np.full(seen.shape, np.iinfo(np.int64).max)
            measured[row, found] = ((some[row] - self.centroids[found]) ** 2).sum(axis=1)
            if len(at):
                best = measured.argmin(axis=1)
                far = measured[np.arange(len(at)), best]
                closer = (far < distance[at]) | ((far == distance[at]) & (best < number[at]))
                number[at[closer]], distance[at[closer]] = best[closer], far[closer]
            first = first + STEP if first + STEP < width else 0
        return number, distance


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of equal length as rows of a matrix."""
    out = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)
    if len(out) and max(-int(out.min()), int(out.max())) > LARGEST:
        raise ValueError(f"a scaled component lies beyond {LARGEST}: its distances would not be exact")
    return out


def _assign(lists):
    def run(batches):
        known = lists.value
        for batch in batches:
            vectors = _matrix(batch.column("vector"), known.centroids.shape[1])
            parts = [known.nearest(vectors[i:i + ROWS]) for i in range(0, len(vectors), ROWS)]
            number, distance = (np.concatenate([p[i] for p in parts]) if parts else np.empty(0, np.int64) for i in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("vector"), pa.array(number.astype(np.int32)), pa.array(distance)],
                names=["vec_id", "vector", "cluster", "distance"])
    return run


def _sums(lists):
    """Of each task one row per centroid with members: how many, and their sum in each dimension."""
    def run(batches):
        known = lists.value
        k, width = known.centroids.shape
        count, total = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        for batch in batches:
            vectors = _matrix(batch.column("vector"), width)
            for i in range(0, len(vectors), ROWS):
                number, _ = known.nearest(vectors[i:i + ROWS])
                count += np.bincount(number, minlength=k)
                np.add.at(total, number, vectors[i:i + ROWS])
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(count[used]), pa.array(total[used].tolist(), pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"])
    return run


def cluster_vectors(embeddings: DataFrame, column: str = "embedding", key: str = "vec_id", k: int = CLUSTERS,
                    rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE,
                    seed: int = SEED) -> tuple[DataFrame, list[list[int]]]:
    """``vec_id, vector, cluster, distance`` of every kept row, and the final centroids.

    Kept are vectors of ``dimensions`` components, none of them null or non-finite; all other rows (null or empty vectors
    too) are left out. Components become integers, so every result is exact and no order of sums matters; a component
    beyond LARGEST after scaling is an error. The first centroids are the kept vectors with the smallest sha256 of
    ``seed:id``; equal ids are told apart by their vectors, and rows without id come last. Where fewer than ``k`` vectors
    are kept there are fewer centroids, and an empty table gives an empty result. Repeated rows count as often as
    they stand there. Of equally near centroids the smaller number wins. Other columns are not read.

    A round reads the kept integers once; what it shuffles are sums per task, centroid and dimension, and what reaches the
    driver and is broadcast are ``k`` x ``dimensions`` numbers, however many rows there are.
    """
    spark = embeddings.sparkSession
    rows = spread(embeddings.select(F.col(key).cast("long").alias("vec_id"), F.col(column).alias("vector")))
    kept = rows.where(finite("vector") & (F.size("vector") == dimensions)).select("vec_id", whole("vector", scale).alias("vector"))
    kept = stored(kept, "whole-vectors")
    first = kept.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256).asc_nulls_last(),
                         "vector").limit(k).collect()
    centroids = np.array([r["vector"] for r in first], np.int64).reshape(len(first), dimensions)
    if not first:
        return kept.select("vec_id", "vector", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), []
    for _ in range(rounds):
        lists = spark.sparkContext.broadcast(SortedLists(centroids))
        sums = kept.select("vector").mapInArrow(_sums(lists), "cluster int, n long, sums array<long>")
        total = sums.select("cluster", "n", F.posexplode("sums").alias("dimension", "part")).groupBy("cluster", "dimension").agg(
            F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
        moved = centroids.copy()
        for r in total.collect():
            moved[r["cluster"], r["dimension"]] = int(r["total"]) // r["n"]
        lists.unpersist()
        if (moved == centroids).all():  # the rounds left would give the same
            break
        centroids = moved
    lists = spark.sparkContext.broadcast(SortedLists(centroids))
    assigned = kept.mapInArrow(_assign(lists), "vec_id long, vector array<long>, cluster int, distance long")
    return assigned, centroids.tolist()


def _digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def _sql() -> str:
    """Every round is a pair of tables of its own: the nearest centroid of each vector, then the moved centroids."""
    steps = []
    for i in range(ROUNDS + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
    SELECT row, vec_id, v, c AS cluster, d FROM (
        SELECT row, vec_id, v, c, d, row_number() OVER (PARTITION BY row ORDER BY d, c) AS nth FROM (
            SELECT row, vec_id, v, c,
                   CAST(list_sum(list_transform(range(1, {DIMENSIONS} + 1), lambda i: (v[i] - m[i]) * (v[i] - m[i]))) AS BIGINT) AS d
            FROM kept, c{i})) WHERE nth = 1)""")
        if i < ROUNDS:
            steps.append(f"""s{i} AS (
    SELECT cluster, i, sum(x) AS total, count(*) AS n FROM (
        SELECT cluster, unnest(range(1, {DIMENSIONS} + 1)) AS i, unnest(v) AS x FROM a{i}) GROUP BY 1, 2),
c{i + 1} AS MATERIALIZED (
    SELECT c, coalesce(moved, m) AS m FROM c{i} LEFT JOIN (
        SELECT cluster, list(CAST((total - ((total % n) + n) % n) // n AS BIGINT) ORDER BY i) AS moved FROM s{i} GROUP BY 1)
    ON c = cluster)""")
    return f"""WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE len(embedding) = {DIMENSIONS}
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMENSIONS}),
c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS c, v AS m FROM (
        SELECT sha256('{SEED}:' || CAST(vec_id AS VARCHAR)) AS h, v FROM kept ORDER BY h NULLS LAST, v LIMIT {CLUSTERS})),
{", ".join(steps)}
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN c{ROUNDS} ON cluster = c
"""


@query("op13_centroid_clustering", _sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, centroids = cluster_vectors(table(spark, sf_dir, "embeddings"))
    assigned = stored(assigned.select("vec_id", "cluster", "distance"), "assigned")
    inertia = {r["cluster"]: int(r["inertia"]) for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()}
    known = [(c, inertia.get(c, 0), sum(inertia.values()), _digest(m)) for c, m in enumerate(centroids)]
    facts = spark.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
