"""Near-duplicate vectors by a pivot-permutation index."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from hearthwatt.llm.frames import stored, table
from hearthwatt.llm.graph import components
from hearthwatt.llm.registry import query

#: Reference points of a vector length: at most PIVOTS, out of about SAMPLE vectors that a hash picks. No two have a cosine
#: over APART, or the order of the pivots inside a dense group of vectors would be left to chance.
PIVOTS, SAMPLE, APART = 128, 4096, 0.6
#: The most frequent vector lengths that get pivots of their own; every other length is one list.
LENGTHS = 16
#: Each vector is described by its NEAREST pivots; two that share SHARED of them are candidates.
NEAREST, SHARED = 5, 2
#: Vectors per tile: two tiles are compared by one task.
TILE = 1024


def _pivots(rows: pd.DataFrame, pivots: int) -> np.ndarray:
    """Sampled directions of one length, each taken if it lies apart from those taken before."""
    chosen: list[np.ndarray] = []
    for raw in rows.sort_values("place")["unit"]:
        unit = np.frombuffer(raw, np.float64)
        if not chosen or (np.array(chosen) @ unit).max() <= APART:
            chosen.append(unit)
        if len(chosen) == pivots:
            break
    return np.array(chosen)


def _pivots_by_length(classes: DataFrame) -> dict[int, tuple[int, np.ndarray]]:
    """The pivots of each length of ``classes``, with the number of the first of them.

    A length has none where so few lie apart that any two sets of the nearest share SHARED of them: its classes all meet.
    """
    size, place = F.length("unit"), F.xxhash64("unit", F.lit("pivot"))
    frequent = classes.groupBy(size.alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").limit(LENGTHS).collect()
    out, first = {}, 0
    for row in frequent:
        rate = min(1_000_000, -(-1_000_000 * SAMPLE // row["n"]))
        sampled = classes.where((size == row["size"]) & (F.pmod(place, F.lit(1_000_000)) < rate))
        points = _pivots(sampled.select("unit", place.alias("place")).toPandas(), PIVOTS)
        if len(points) > 2 * NEAREST - SHARED:
            out[points.shape[1]] = first, points
            first += len(points)
    return out


def _units(batches):
    """Unit vector in double precision; null for vectors that link with nothing."""
    for batch in batches:
        units = []
        for value in batch.column(1).to_pylist():
            unit = None
            if value and None not in value:
                vector = np.array(value, np.float64)
                top = np.abs(vector).max()
                if np.isfinite(top) and top > 0:
                    vector /= top
                    unit = (vector / np.sqrt(vector @ vector)).tobytes()
            units.append(unit)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(units, pa.binary())], names=["vec_id", "unit"])


def _described(pivots):
    """The sorted numbers of the nearest pivots; all vectors of a length without pivots share one list."""
    def run(batches):
        known = pivots.value
        for batch in batches:
            sets = []
            for raw in batch.column(0).to_pylist():
                unit = np.frombuffer(raw, np.float64)
                if len(unit) in known:
                    first, points = known[len(unit)]
                    near = (first + np.argsort(-(points @ unit), kind="stable")[:NEAREST]).tolist()
                else:
                    near = [-1 - 2 * len(unit), -2 - 2 * len(unit)]
                sets.append(sorted(near))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sets, pa.list_(pa.int32()))], names=[*batch.schema.names, "near"])
    return run


def _first_shared(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The SHARED smallest pivots that rows of both have in common, -9 where there are fewer."""
    both = (left[:, :, None] == right[:, None, :]).any(axis=2)
    out = np.full((len(left), SHARED), np.iinfo(np.int32).min)
    for k in range(SHARED):
        has = both.any(axis=1)
        place = both.argmax(axis=1)
        out[has, k] = left[has, place[has]]
        both[np.arange(len(both)), place] = False
    return out


def _compare(least: float):
    """One pair of tiles of one list: links of each vector, and edges of a spanning forest of the links.

    A pair is counted only in the list of the first pivots that it shares, so once over all lists.
    """
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rep", kind="stable").reset_index(drop=True)
        units = np.stack([np.frombuffer(raw, np.float64) for raw in pdf["unit"]])
        near = np.stack(pdf["near"].to_list())
        own, rep, copies = np.array(pdf["pivots"].iloc[0]), pdf["rep"].to_numpy(), pdf["copies"].to_numpy()
        low, high = pdf["low"].iloc[0], pdf["high"].iloc[0]
        one = np.flatnonzero(pdf["tile"].to_numpy() == low)
        two = np.flatnonzero(pdf["tile"].to_numpy() == high)
        n_links, forest, parent = np.zeros(len(pdf), np.int64), [], list(range(len(pdf)))

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for first in range(0, len(one), 128):
            some = one[first:first + 128]
            cosine = units[some] @ units[two].T
            i, j = np.nonzero(cosine >= least)
            i, j = some[i], two[j]
            if low == high:
                i, j = i[i < j], j[i < j]
            mine = (_first_shared(near[i], near[j]) == own).all(axis=1) if len(i) else np.empty(0, bool)
            i, j = i[mine], j[mine]
            np.add.at(n_links, i, copies[j])
            np.add.at(n_links, j, copies[i])
            for a, b in zip(i.tolist(), j.tolist()):
                a, b = find(a), find(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    forest.append((int(rep[min(a, b)]), int(rep[max(a, b)]), 0))
        counted = np.flatnonzero(n_links)
        return pd.concat([pd.DataFrame(forest, columns=["a", "b", "n"], dtype="int64"),
                          pd.DataFrame({"a": rep[counted], "b": rep[counted], "n": n_links[counted]})])
    return run


def linked_vectors(embeddings: DataFrame, column: str = "embedding", key: str = "vec_id", least: float = 0.95) -> DataFrame:
    """One row per row of ``embeddings``: ``vec_id, n_links, component_id, kept``.

    Vectors link if their cosine in double precision is ``least`` or more. A vector that is null, empty, zero or holds
    null or non-finite components links with nothing, and so does a row without id, whose component is null. Vectors
    of different lengths do not link. Equal directions are one class from the start, whose copies link with each other.

    Every class is described by its nearest pivots and stands in one inverted list for each pair of them, so two
    classes meet if they share two pivots. Vectors too dense for pivots, and lengths too rare for them, all meet in one list
    per length, which is quadratic in it. A list longer than a tile is cut into tiles, and each pair of tiles is
    compared by a task of its own; what leaves it are counts and the edges of a spanning forest, not the pairs.
    """
    spark = embeddings.sparkSession
    chosen = embeddings.select(F.col(key).cast("long").alias("vec_id"), F.col(column).alias("vector"))
    units = stored(chosen.mapInArrow(_units, "vec_id long, unit binary"), "units")
    classes = units.where("unit IS NOT NULL AND vec_id IS NOT NULL").groupBy("unit").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    classes = stored(classes, "classes")
    pivots = spark.sparkContext.broadcast(_pivots_by_length(classes))
    described = classes.select("unit", "rep", "copies").mapInArrow(_described(pivots), "unit binary, rep long, copies long, near array<int>")
    pairs = F.expr(f"filter(flatten(transform(near, (x, i) -> transform(slice(near, i + 2, {NEAREST}), y -> array(x, y)))), p -> size(p) = 2)")
    listed = described.withColumn("pivots", F.explode(pairs))
    sizes = listed.groupBy("pivots").agg(F.count("*").alias("size")).where("size > 1") \
        .withColumn("tiles", F.ceil(F.col("size") / TILE).cast("int"))
    dealt = listed.join(sizes, "pivots").withColumn("tile", F.pmod(F.xxhash64("unit"), F.col("tiles")).cast("int"))
    meeting = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))) \
        .withColumn("low", F.least("tile", "other")).withColumn("high", F.greatest("tile", "other")).drop("other", "size", "tiles")
    compared = stored(meeting.groupBy("pivots", "low", "high").applyInPandas(_compare(least), "a long, b long, n long"), "compared")
    counts = compared.where("a = b").groupBy("a").agg(F.sum("n").alias("n"))
    found = components(compared.where("a <> b"), "a", "b")
    named = classes.join(counts, F.col("rep") == F.col("a"), "left").join(found, F.col("rep") == F.col("node"), "left").select(
        "unit", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    idle = F.col("unit").isNull() | F.col("vec_id").isNull()
    return units.join(named, "unit", "left").select(
        "vec_id", F.when(idle, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
        F.when(idle, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id")) \
        .withColumn("kept", F.col("vec_id").isNull() | (F.col("vec_id") == F.col("component_id")))


SQL = """
WITH RECURSIVE vec AS MATERIALIZED (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v,
           coalesce(len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding) AND list_max(list_transform(embedding, lambda x: abs(x))) > 0, false) AS sound
    FROM embeddings),
link AS MATERIALIZED (
    SELECT a.vec_id AS a, b.vec_id AS b FROM vec a JOIN vec b ON a.vec_id <> b.vec_id AND a.sound AND b.sound AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
reach AS (SELECT a AS vec_id, a AS other FROM link UNION SELECT r.vec_id, l.b FROM reach r JOIN link l ON l.a = r.other),
found AS (SELECT vec_id, min(other) AS least FROM reach GROUP BY 1),
size AS (SELECT a AS vec_id, count(*) AS n FROM link GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(least, vec_id) AS component_id, coalesce(least, vec_id) = vec_id AS kept
FROM vec LEFT JOIN size USING (vec_id) LEFT JOIN found USING (vec_id)
"""


@query("op5_embedding_near_dedup", SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_vectors(table(spark, sf_dir, "embeddings"))
