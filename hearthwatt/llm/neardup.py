"""MinHash near-duplicates with tensored banding: table keys are pairs out of two small collections of minhashes."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from hearthwatt.llm.frames import small_batches, stored, table
from hearthwatt.llm.graph import components
from hearthwatt.llm.registry import query
from hearthwatt.llm.text import mixed, prefix_sums, slices, spans_hash, spans_residue, utf8, word_spans

#: Two collections of SIDE hashes, each of DEPTH minhashes, make SIDE * SIDE tables out of 2 * SIDE * DEPTH minhashes.
#: At a similarity of 0.8 a pair meets in a table with probability (1 - (1 - 0.8**2)**8)**2 = 0.9994, at 0.9 with 1 - 4e-6.
SIDE, DEPTH = 8, 2
ROUNDS = 2
#: Passes in which links are merged between rounds. What they leave apart is compared once more than needed, and merged in the end.
PASSES = 2
#: Bytes of text that are worked on at once; one longer text is a slice of its own.
SLICE = 1 << 18
#: A bucket of more classes is compared in tiles of its cluster and not pair by pair; classes per tile.
BUCKET, TILE = 32, 1024

_SPACE = np.array([b == 0x20 or 0x09 <= b <= 0x0D for b in range(256)])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_RANDOM = np.random.default_rng(42)
_PLACES = _RANDOM.integers(1, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
_MASKS = _RANDOM.integers(0, 1 << 63, 2 * SIDE * DEPTH, np.uint64)
_FACTORS = _RANDOM.integers(1, 1 << 63, 2 * SIDE * DEPTH, np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words and the offset of each text among them; a text of fewer words is one run.

    A word is hashed modulo 2**64 and modulo a prime, as one of them alone can be alike for words made for it.
    """
    low = _LOWER[data[offsets[0]:offsets[-1]]]
    starts, ends, at = word_spans(~_SPACE[low], offsets - offsets[0])
    words = mixed(spans_hash(prefix_sums(low), starts, ends) + spans_residue(low, starts, ends) * _PLACES[-1])
    count = np.diff(at)
    runs = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    places = np.concatenate(([0], np.cumsum(runs)))
    first = np.arange(places[-1]) - np.repeat(places[:-1], runs) + np.repeat(at[:-1], runs)
    held = np.repeat(np.minimum(count, size), runs)
    total = held.astype(np.uint64)
    for k in range(size):
        inside = k < held
        total[inside] += words[first[inside] + k] * _PLACES[k]
    return mixed(total), places


def sketch(hashes: np.ndarray, places: np.ndarray) -> np.ndarray:
    """For each text with any runs the 2 * SIDE hashes of its two collections."""
    full = np.flatnonzero(np.diff(places))
    out = np.empty((len(full), 2 * SIDE), np.uint64)
    if len(full) == 0:
        return out
    starts = places[:-1][full]
    for i in range(2 * SIDE):
        total = np.full(len(full), i, np.uint64)
        for k in range(DEPTH):
            j = i * DEPTH + k
            total = mixed(total + np.minimum.reduceat((hashes ^ _MASKS[j]) * _FACTORS[j], starts))
        out[:, i] = total
    return out


def _sketches(size: int):
    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            n, x, y, parts = [], [], [], []
            for a, b in slices(offsets, SLICE):
                hashes, places = shingles(data, offsets[a:b + 1], size)
                collections = iter(sketch(hashes, places).view(np.int64))
                for i in range(b - a):
                    own = np.unique(hashes[places[i]:places[i + 1]])
                    n.append(len(own))
                    x.append(own.sum(dtype=np.uint64))
                    y.append(mixed(own).sum(dtype=np.uint64))
                    parts.append(next(collections) if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(np.array(x, np.uint64).view(np.int64)),
                 pa.array(np.array(y, np.uint64).view(np.int64)), pa.array(parts, pa.list_(pa.int64()))],
                names=["doc_id", "n", "x", "y", "parts"])
    return run


def _sets(size: int):
    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in slices(offsets, SLICE):
                hashes, places = shingles(data, offsets[a:b + 1], size)
                sets = [np.unique(hashes[places[i]:places[i + 1]]).tobytes() for i in range(b - a)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(sets, pa.binary())], names=["rep", "members"])
    return run


def _similar(percent: int):
    def run(batches):
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            keep = []
            for i in range(batch.num_rows):
                x, y = np.frombuffer(left[i].as_buffer(), np.uint64), np.frombuffer(right[i].as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                same = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                keep.append(100 * same >= percent * (len(x) + len(y) - same))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def common_counts(left: np.ndarray, left_at: np.ndarray, right: np.ndarray, right_at: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of all sets of the left side with all of the right side.

    The sets are concatenated, with the offset of each. A member of many sets is a column of two dense matrices that are
    multiplied, a block of columns at a time; members of few sets are counted pair by pair.
    """
    rows, columns = len(left_at) - 1, len(right_at) - 1
    total = np.zeros((rows, columns), np.int64)
    both = np.intersect1d(left, right)
    sides = []
    for values, at in ((left, left_at), (right, right_at)):
        place = np.minimum(np.searchsorted(both, values), max(0, len(both) - 1))
        hit = np.flatnonzero(both[place] == values) if len(both) else np.empty(0, int)
        owner, member = np.searchsorted(at, hit, side="right") - 1, place[hit]
        order = np.argsort(member, kind="stable")
        sides.append((owner[order], np.searchsorted(member[order], np.arange(len(both) + 1))))
    (one, one_at), (two, two_at) = sides
    pairs = np.diff(one_at) * np.diff(two_at)
    dense = np.flatnonzero(pairs >= 4096)
    for first in range(0, len(dense), 2048):
        block = dense[first:first + 2048]
        matrices = []
        for owner, at, n in ((one, one_at, rows), (two, two_at, columns)):
            matrix = np.zeros((n, len(block)), np.float32)
            sizes = np.diff(at)[block]
            matrix[owner[_ranges(at[block], sizes)], np.repeat(np.arange(len(block)), sizes)] = 1
            matrices.append(matrix)
        total += (matrices[0] @ matrices[1].T).astype(np.int64)  # exact: at most 2048 each
    sparse = np.flatnonzero((pairs > 0) & (pairs < 4096))
    for part in np.split(sparse, np.searchsorted(np.cumsum(pairs[sparse]), np.arange(1 << 20, pairs[sparse].sum(), 1 << 20))):
        n, m = np.diff(one_at)[part], np.diff(two_at)[part]
        row = np.repeat(one[_ranges(one_at[part], n)], np.repeat(m, n))
        column = two[_ranges(np.repeat(two_at[part], n), np.repeat(m, n))]
        total += np.bincount(row * columns + column, minlength=rows * columns).reshape(rows, columns)
    return total


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ..., for each start as many as its size says."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _tiles(percent: int):
    """Links between different components in one pair of tiles, as a spanning forest."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rep", kind="stable")
        low, high = pdf["low"].iloc[0], pdf["high"].iloc[0]
        sides = []
        for tile in (low, high):
            own = pdf[pdf["tile"] == tile]
            sets = [np.frombuffer(x, np.uint64) for x in own["members"]]
            sides.append((own["rep"].to_numpy(), own["component"].to_numpy(), np.concatenate([*sets, np.empty(0, np.uint64)]),
                          np.concatenate(([0], np.cumsum([len(x) for x in sets]))).astype(np.int64)))
        (a, ca, xs, x_at), (b, cb, ys, y_at) = sides
        if not len(a) or not len(b) or min(ca.min(), cb.min()) == max(ca.max(), cb.max()):
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        same = common_counts(xs, x_at, ys, y_at)
        union = np.diff(x_at)[:, None] + np.diff(y_at)[None, :] - same
        i, j = np.nonzero((100 * same >= percent * union) & (ca[:, None] != cb[None, :]))
        _, low_at = np.unique(np.minimum(ca[i], cb[j]), return_inverse=True)
        names, high_at = np.unique(np.maximum(ca[i], cb[j]), return_inverse=True)
        _, first = np.unique(low_at * len(names) + high_at, return_index=True)
        return pd.DataFrame({"a": np.minimum(a[i], b[j])[first], "b": np.maximum(a[i], b[j])[first]})
    return run


def _in_tiles(crowded: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between different components among the members of crowded buckets.

    Buckets that share members make a cluster. It is cut into tiles, and each pair of tiles is compared once, by one
    task, however many tables the same members meet in.
    """
    heads = crowded.groupBy("key").agg(F.min("rep").alias("head"))
    clusters = components(crowded.join(heads, "key").select("rep", "head").distinct(), "rep", "head")
    own = crowded.select("rep", "component").distinct().join(clusters, F.col("rep") == F.col("node"), "left") \
        .select("rep", clusters["component"].alias("found"), crowded["component"].alias("component")) \
        .select("rep", "component", F.coalesce("found", "rep").alias("cluster"))
    sizes = own.groupBy("cluster").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    dealt = own.join(sizes, "cluster").withColumn("tile", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int")).join(sets, "rep")
    meeting = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))) \
        .withColumn("low", F.least("tile", "other")).withColumn("high", F.greatest("tile", "other")).drop("other", "tiles")
    return meeting.groupBy("cluster", "low", "high").applyInPandas(_tiles(percent), "a long, b long")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left, right = sets.select(F.col("rep").alias("a"), F.col("members").alias("x")), sets.select(F.col("rep").alias("b"), F.col("members").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(_similar(percent), "a long, b long")


def _labelled(members: DataFrame, links: DataFrame) -> DataFrame:
    found = components(links, "a", "b", PASSES).withColumnRenamed("node", "rep")
    return members.join(found, "rep", "left").withColumn("component", F.coalesce("component", "rep"))


def _split(labelled: DataFrame) -> DataFrame:
    """The members of tables' buckets that hold more than one component."""
    mixed_keys = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")) \
        .where("low <> high").select("key")
    return labelled.join(mixed_keys, "key")


def near_duplicates(documents: DataFrame, column: str = "text", key: str = "doc_id", size: int = 4, percent: int = 80) -> DataFrame:
    """One row per row of ``documents``: ``doc_id, n_shingles, component_id, kept``.

    Documents link if the sets of their ``size``-word runs have 100 * intersection >= ``percent`` * union; a component is
    what links reach, named by its smallest id, which alone is kept. Words are lower-cased (A-Z) and end at white space;
    fewer than ``size`` words are one run; a text without words, or null, has an empty set and links with nothing, and so
    does a row without id, whose component is null. Equal sets are one class from the start, so copies of any number
    cost one row. Texts under one repeated id count as one document. An empty table gives no rows, other columns are not read, and a
    text of any length is worked on whole in one task.

    Classes that share a table key are candidates. In each bucket one class, another one in each round, is compared with
    all others; whatever is in one component by then needs no comparison any more. Of the rest, members of buckets of up
    to 32 classes are compared in pairs, larger buckets tile by tile, where a task multiplies the incidence matrices of
    its two tiles and returns a spanning forest of the links. So no link between components is lost, and no rows are
    made for the pairs of a crowd of texts that are alike but not alike enough.
    """
    chosen = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(column).alias("text"))
    with small_batches(documents.sparkSession):  # all jobs that run Python end before this returns
        return _named(chosen, size, percent)


def _named(chosen: DataFrame, size: int, percent: int) -> DataFrame:
    sketches = stored(chosen.mapInArrow(_sketches(size), "doc_id long, n long, x long, y long, parts array<long>"), "sketches")
    classes = sketches.where("n > 0 AND doc_id IS NOT NULL").groupBy("n", "x", "y").agg(F.min("doc_id").alias("rep"), F.first("parts").alias("parts"))
    one, two = F.slice("parts", 1, SIDE), F.slice("parts", SIDE + 1, SIDE)
    keys = classes.select("rep", "n", two.alias("two"), F.posexplode(one).alias("i", "one")) \
        .select("rep", "n", "i", "one", F.posexplode("two").alias("j", "other")) \
        .select(F.xxhash64("i", "one", "j", "other").alias("key"), "rep", "n")
    shared = keys.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high"), F.count("*").alias("size")) \
        .where("low <> high").select("key", "size")
    members = stored(keys.join(shared, "key"), "members")
    reps = members.select("rep").distinct()
    sets = stored(chosen.join(reps, chosen.doc_id == reps.rep, "left_semi").mapInArrow(_sets(size), "rep long, members binary"), "sets")

    def alike(n: str, m: str):
        return (F.col(n) * 100 >= F.col(m) * percent) & (F.col(m) * 100 >= F.col(n) * percent)

    labelled, links = members.withColumn("component", F.col("rep")), None
    for turn in range(ROUNDS):
        open_buckets = labelled if turn == 0 else _split(labelled)
        order = F.col("rep") if turn == 0 else F.xxhash64("rep", F.lit(turn))
        heads = open_buckets.groupBy("key").agg(F.min(F.struct(order.alias("order"), "rep", "n", "component")).alias("head"))
        pairs = open_buckets.join(heads, "key").where(F.col("component") != F.col("head.component")) \
            .where(alike("n", "head.n")).select(F.least("rep", "head.rep").alias("a"), F.greatest("rep", "head.rep").alias("b")).distinct()
        found = _linked(pairs, sets, percent)
        links = stored(found if links is None else found.union(links), "found")
        labelled = stored(_labelled(members, links), "labelled")
    rest = stored(_split(labelled), "open")
    crowded, few = rest.where(F.col("size") > BUCKET), rest.where(F.col("size") <= BUCKET)
    other = few.select("key", F.col("rep").alias("b"), F.col("n").alias("m"), F.col("component").alias("theirs"))
    pairs = few.join(other, "key").where("rep < b AND component <> theirs").where(alike("n", "m")) \
        .select(F.col("rep").alias("a"), "b").distinct()
    final = components(_linked(pairs, sets, percent).union(links).union(_in_tiles(crowded, sets, percent)), "a", "b")
    named = classes.select("n", "x", "y", "rep").join(final, F.col("rep") == F.col("node"), "left") \
        .select("n", "x", "y", F.coalesce("component", "rep").alias("component_id"))
    return sketches.drop("parts").join(named, ["n", "x", "y"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        (F.coalesce("component_id", "doc_id").eqNullSafe(F.col("doc_id")) | F.col("doc_id").isNull()).alias("kept"))


def distinct_documents(documents: DataFrame, column: str = "text", key: str = "doc_id", size: int = 5, percent: int = 80) -> DataFrame:
    """The documents that ``near_duplicates`` keeps, with their own columns. Repeated rows of a kept id become one; rows
    without id stay."""
    named = documents.where(F.col(key).isNotNull())
    kept = near_duplicates(named, column, key, size, percent).where("kept").groupBy(F.col("doc_id").alias("id")).agg(F.count("*").alias("times"))
    rows = named.select(F.col(key).cast("long").alias("id"), F.struct("*").alias("row")).join(kept, "id")
    once, again = rows.where("times = 1"), rows.where("times > 1").dropDuplicates(["id"])
    return once.union(again).select("row.*").union(documents.where(F.col(key).isNull()))


SQL = r"""
WITH RECURSIVE doc AS MATERIALIZED (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
run AS MATERIALIZED (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 4) - 1], ' ') AS run
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 0) + 2)) AS i FROM doc WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM run GROUP BY 1),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS same FROM run a JOIN run b ON a.run = b.run AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS MATERIALIZED (
    SELECT a, b FROM common JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * same >= 80 * (x.n + y.n - same)),
edge AS MATERIALIZED (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT a AS doc_id, a AS other FROM edge UNION SELECT r.doc_id, e.b FROM reach r JOIN edge e ON e.a = r.other),
found AS (SELECT doc_id, min(other) AS least FROM reach GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(least, doc_id) AS component_id, coalesce(least, doc_id) = doc_id AS kept
FROM doc LEFT JOIN size USING (doc_id) LEFT JOIN found USING (doc_id)
"""


@query("op9_minhash_near_dedup", SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
