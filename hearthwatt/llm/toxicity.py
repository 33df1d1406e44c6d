"""Toxicity: nearest labelled examples by exact TF-IDF cosine, found through a block-max inverted index."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from hearthwatt.llm.frames import remainder, stored, table
from hearthwatt.llm.registry import query
from hearthwatt.llm.text import letter_grams, slices, utf8

#: Terms are letter n-grams with word borders, so short words are terms too.
ORDERS = (4, 5, 6)
#: Examples per label (expected, a hash of the key picks them), neighbours that vote, terms and examples per block.
SAMPLE, NEIGHBOURS, TERMS, BLOCK = 4000, 15, 2048, 64
#: A term counts if the lower bound of its documents' share of label 1 (95 %) reaches this.
LEAST_SHARE = 0.7
_FILTER = 20


class Terms:
    """Chosen terms by their hash: a small table rejects most others at once."""

    def __init__(self, codes: np.ndarray):
        self.codes = np.sort(codes)
        self.table = np.zeros(1 << _FILTER, bool)
        self.table[(self.codes >> np.uint64(64 - _FILTER)).astype(np.int64)] = True

    def found(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, term and count of each pair that occurs, by text and term."""
        pairs = []
        for code, at in letter_grams(data, offsets, ORDERS) if len(self.codes) else ():
            near = np.flatnonzero(self.table[(code >> np.uint64(64 - _FILTER)).astype(np.int64)])
            term = np.searchsorted(self.codes, code[near])
            hit = self.codes[np.minimum(term, len(self.codes) - 1)] == code[near]
            text = np.searchsorted(at, near[hit], side="right") - 1
            pairs.append(text * len(self.codes) + term[hit])
        pair, n = np.unique(np.concatenate(pairs) if pairs else np.empty(0, np.int64), return_counts=True)
        return pair // max(1, len(self.codes)), pair % max(1, len(self.codes)), n


def _document_counts(batches):
    """Number of documents of each label (0 or 1) that hold a term."""
    kept: list[tuple[np.ndarray, np.ndarray]] = []

    def merged():
        code, label = np.concatenate([c for c, _ in kept]), np.concatenate([x for _, x in kept])
        unique, place = np.unique(code, return_inverse=True)
        return unique, np.bincount(place, label[:, 0]), np.bincount(place, label[:, 1])

    for batch in batches:
        data, offsets = utf8(batch.column(1))
        labels = batch.column(0).to_numpy(zero_copy_only=False)
        for a, b in slices(offsets):
            parts = list(letter_grams(data, offsets[a:b + 1], ORDERS))
            for i in range(b - a):
                code = np.unique(np.concatenate([c[at[i]:at[i + 1]] for c, at in parts]))
                kept.append((code, np.repeat([[1.0 - labels[a + i], float(labels[a + i])]], len(code), axis=0)))
            code, zero, one = merged()
            kept = [(code, np.column_stack([zero, one]))]
    if kept:
        code, zero, one = merged()
        for first in range(0, len(code), 100_000):
            cut = slice(first, first + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(code[cut].view(np.int64)), pa.array(zero[cut]), pa.array(one[cut])],
                                             names=["code", "zero", "one"])


def _frequencies(terms):
    """Number of documents in a partition, as code -1, and of those that hold each term."""
    def count(batches):
        total, rows = np.zeros(len(terms.value.codes), np.int64), 0
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            rows += batch.num_rows
            for a, b in slices(offsets):
                _, term, _ = terms.value.found(data, offsets[a:b + 1])
                total += np.bincount(term, minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(total))), pa.array(np.concatenate(([rows], total)))], names=["term", "n"])
    return count


class Index:
    """Weighted examples by blocks of similar ones. Each block holds its postings by term, and ``most`` the largest weight
    of each term in each block, which bounds what a block can add to a query."""

    def __init__(self, terms: Terms, idf: np.ndarray, ids: list[int | None], labels: np.ndarray, votes: np.ndarray,
                 vectors: list[tuple[np.ndarray, np.ndarray]], base: float, silent: float):
        self.terms, self.idf, self.base, self.silent = terms, idf, base, silent
        order = sorted(range(len(vectors)), key=lambda i: (int(vectors[i][0][np.argmax(vectors[i][1])]), ids[i] is None, ids[i] or 0))
        self.ids = [ids[i] for i in order]
        self.labels, self.votes = labels[order], votes[order]
        n = -(-len(order) // BLOCK)
        self.most, self.row, self.postings = np.zeros((len(idf), n), np.float32), np.full((len(idf), n), -1, np.int32), []
        for block in range(n):
            part = [vectors[i] for i in order[block * BLOCK:(block + 1) * BLOCK]]
            used = np.unique(np.concatenate([t for t, _ in part]))
            weights = np.zeros((len(used), len(part)))
            for column, (term, weight) in enumerate(part):
                weights[np.searchsorted(used, term), column] = weight
            self.row[used, block] = np.arange(len(used))
            self.most[used, block] = np.nextafter(weights.max(axis=1).astype(np.float32), np.float32(2))
            self.postings.append(weights)

    def nearest(self, term: np.ndarray, weight: np.ndarray, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """Examples and cosines of the ``k`` nearest; ties go to the example that stands first. Blocks are read from the
        highest bound on, until none can hold a better one."""
        bound = weight @ self.most[term] + 1e-6
        best, cosine = np.empty(0, np.int64), np.empty(0)
        for block in np.argsort(-bound, kind="stable"):
            if bound[block] <= 1e-6 or len(best) == k and bound[block] < cosine[-1]:
                break
            row = self.row[term, block]
            got = weight[row >= 0] @ self.postings[block][row[row >= 0]]
            hit = np.flatnonzero(got > 0)
            best = np.concatenate((best, hit + block * BLOCK))
            cosine = np.round(np.concatenate((cosine, got[hit])), 12)
            order = np.lexsort((best, -cosine))[:k]
            best, cosine = best[order], cosine[order]
        return best, cosine

    def vector(self, term: np.ndarray, count: np.ndarray) -> np.ndarray:
        weight = (1 + np.log(count)) * self.idf[term]
        return weight / np.sqrt((weight ** 2).sum())

    def score(self, term: np.ndarray, count: np.ndarray) -> tuple[float, list[int]]:
        """Share of the votes for label 1, and the neighbours' ids. A little of the general share smooths few or far votes."""
        best, cosine = self.nearest(term, self.vector(term, count)) if len(term) else ([], [])
        if len(best) == 0:
            return self.silent, []
        votes = cosine * self.votes[best]
        return float((votes @ self.labels[best] + 0.2 * self.base) / (votes.sum() + 0.2)), \
            [self.ids[i] for i in best if self.ids[i] is not None]


def lower_bound(one: np.ndarray, all_: np.ndarray, z: float = 1.96) -> np.ndarray:
    """Wilson's lower bound of the share of label 1."""
    p, n = one / all_, all_
    return (p + z * z / (2 * n) - z * np.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def fit(documents: DataFrame, labels: DataFrame, label: str, column: str = "text", key: str = "doc_id", sample: int = SAMPLE,
        terms: int = TERMS, least_share: float = LEAST_SHARE) -> Index | None:
    """Index of the documents that ``labels`` marks 0 or 1 (other labels are left out), or None without any.

    About ``sample`` examples of each label are indexed, chosen by a hash of ``key`` before the labels are joined with the
    texts; a vote counts as many times as its label was thinned out. Terms are the ``terms`` letter n-grams that speak most clearly for label 1 in those
    examples. Their document frequencies come from all of ``documents``. So the index, which is broadcast, is bounded
    by ``sample`` and ``terms``.
    """
    spark = documents.sparkSession
    known = labels.where(F.col(label).isin(0, 1))
    sizes = {r[label]: r["n"] for r in known.groupBy(label).agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    place = F.pmod(F.xxhash64(F.lit("toxicity"), F.col(key).cast("string")), F.lit(1_000_000))
    limit = F.lit(0)
    for value, n in sizes.items():
        limit = F.when(F.col(label) == value, F.lit(min(1_000_000, -(-1_000_000 * sample // n)))).otherwise(limit)
    marked = known.where(place < limit).select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
    chosen = stored(documents.select(F.col(key).alias("key"), F.col(column).alias("text")).join(F.broadcast(marked), "key")
                    .select("label", "text", "key"), "examples")
    counted = chosen.select("label", "text").mapInArrow(_document_counts, "code long, zero double, one double") \
        .groupBy("code").agg(F.sum("zero").alias("zero"), F.sum("one").alias("one")).where("one >= 4").toPandas()
    thinned = {v: n / min(n, sample) for v, n in sizes.items()}
    zero, one = counted["zero"].to_numpy() * thinned.get(0, 1), counted["one"].to_numpy()
    share = lower_bound(one * thinned.get(1, 1), np.maximum(one * thinned.get(1, 1) + zero, 1e-9)) if len(counted) else np.empty(0)
    good = counted.assign(share=share, one=one)[share >= least_share].sort_values(["one", "share", "code"], ascending=[False, False, True])
    own = Terms(good["code"].to_numpy()[:terms].astype(np.int64).view(np.uint64))
    shared = spark.sparkContext.broadcast(own)
    rows = documents.select(F.col(column).alias("text")).mapInArrow(_frequencies(shared), "term long, n long") \
        .groupBy("term").agg(F.sum("n").alias("n")).collect()
    frequency = {r["term"]: r["n"] for r in rows}
    idf = np.array([np.log((1 + frequency.get(-1, 0)) / (1 + frequency.get(t, 0))) + 1 for t in range(len(own.codes))])

    def vectors(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in slices(offsets):
                text, term, n = shared.value.found(data, offsets[a:b + 1])
                at = np.searchsorted(text, np.arange(b - a + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a),
                     pa.array([term[at[i]:at[i + 1]] for i in range(b - a)], pa.list_(pa.int64())),
                     pa.array([n[at[i]:at[i + 1]] for i in range(b - a)], pa.list_(pa.int64()))],
                    names=["label", "key", "terms", "counts"])

    found = chosen.select("label", "text", "key").mapInArrow(vectors, f"label int, key {chosen.schema['key'].dataType.simpleString()}, "
                                                             "terms array<long>, counts array<long>").toPandas()
    return index(own, idf, found, thinned)


def index(terms: Terms, idf: np.ndarray, found: pd.DataFrame, thinned: dict[int, float]) -> Index | None:
    if not len(found):
        return None
    labels = found["label"].to_numpy().astype(float)
    votes = np.where(labels == 1, thinned.get(1, 1.0), thinned.get(0, 1.0))
    speaks = found["terms"].map(len).to_numpy() > 0
    base = float((votes @ labels) / votes.sum())
    quiet = votes[~speaks]
    silent = float((quiet @ labels[~speaks] + base) / (quiet.sum() + 1))
    rows = found[speaks]
    ready = Index(terms, idf, [], np.empty(0), np.empty(0), [], base, silent)
    weighted = [(t, ready.vector(t, n)) for t, n in zip(rows["terms"], rows["counts"])]
    ids = [None if pd.isna(x) else int(x) for x in rows["key"]]
    return Index(terms, idf, ids, labels[speaks], votes[speaks], weighted, base, silent)


def score(df: DataFrame, model: Index | None, column: str = "text", result: tuple[str, str] = ("score", "evidence")) -> DataFrame:
    """``df`` with the share of votes for label 1 and the ids of the examples that voted, for every whole text.

    A text without any term (null and empty ones too) gets the share of label 1 among the examples without any; without
    a model the score is 0. Columns that have the name of a result are replaced; repeated rows are scored one by one.
    """
    kept = [c for c in df.columns if c not in result]
    shared = df.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        own = shared.value
        for batch in batches:
            data, offsets = utf8(batch.column(column))
            scores, evidence = [], []
            for a, b in slices(offsets):
                text, term, n = own.terms.found(data, offsets[a:b + 1]) if own else (np.empty(0, int),) * 3
                at = np.searchsorted(text, np.arange(b - a + 1))
                for i in range(b - a):
                    value, ids = own.score(term[at[i]:at[i + 1]], n[at[i]:at[i + 1]]) if own else (0.0, [])
                    scores.append(value)
                    evidence.append(ids)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(scores, pa.float64()),
                                              pa.array(evidence, pa.list_(pa.int64()))], names=[*kept, *result])

    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept), f"{result[0]} double, {result[1]} array<long>"])
    return df.select(*kept).mapInArrow(scored, schema)


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 5) != 0).select("doc_id", "toxic")
    model = fit(documents, labels, "toxic")
    return score(documents, model).select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score",
                                          (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")
