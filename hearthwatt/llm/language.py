"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hearthwatt.llm.frames import free_names, remainder, table
from hearthwatt.llm.registry import query
from hearthwatt.llm.text import letter_grams, slices, sums_per_text, utf8

UNKNOWN = "und"
#: Hash buckets per model and orders of the n-grams.
BUCKETS, ORDERS = 1 << 16, (1, 2, 3)
#: Documents per language that the model is fitted on, as an expected value: a hash of the key picks them.
SAMPLE = 4000
#: Bytes of text that are worked on at once; what is known about them leaves at once, too.
SLICE = 1 << 18


def grams(data: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS, orders=ORDERS):
    """Buckets of the letter n-grams of some texts, with the offset of each text among them, by order."""
    for code, at in letter_grams(data, offsets, orders):
        yield (code % np.uint64(buckets)).astype(np.int64), at


def _counts(labels: list[str], buckets: int):
    def count(batches):
        number = {label: i for i, label in enumerate(labels)}
        total = np.zeros((len(labels), buckets), np.int64)
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            label = np.array([number[x] for x in batch.column(0).to_pylist()], np.int64)
            for a, b in slices(offsets, SLICE):
                for bucket, at in grams(data, offsets[a:b + 1], buckets):
                    flat = np.repeat(label[a:b], np.diff(at)) * buckets + bucket
                    total += np.bincount(flat, minlength=total.size).reshape(total.shape)
        for i, label in enumerate(labels):
            at = np.flatnonzero(total[i])
            yield pa.RecordBatch.from_pydict({
                "label": pa.array([label] * len(at), pa.string()), "bucket": pa.array(at, pa.int64()), "n": pa.array(total[i][at], pa.int64())})
    return count


class Model:
    """Log probabilities: one row per bucket, one column per label, and the log prior of each label."""

    def __init__(self, labels: list[str], matrix: np.ndarray, prior: np.ndarray):
        self.labels, self.matrix, self.prior = labels, matrix, prior


def fit(examples: DataFrame, label: str, column: str = "text", key: str = "doc_id", sample: int = SAMPLE,
        buckets: int = BUCKETS, smoothing: float = 0.5, max_labels: int = 512) -> Model:
    """Naive Bayes model of ``examples``; rows without label or text are left out.

    The priors are the shares of all examples; the matrix counts about ``sample`` rows of each label, chosen by a hash of
    ``key``. It has ``buckets`` x labels entries and is broadcast, so the number of labels is checked against ``max_labels`` first. No examples: no labels.
    """
    spark = examples.sparkSession
    known = examples.where(F.col(label).isNotNull() & F.col(column).isNotNull())
    sizes = {r[label]: r["n"] for r in known.groupBy(label).agg(F.count("*").alias("n")).limit(max_labels + 1).collect()}
    if len(sizes) > max_labels:
        raise ValueError(f"more than {max_labels} labels")
    labels = sorted(sizes)
    if not labels:
        return Model([], np.zeros((buckets, 0), np.float32), np.zeros(0))
    place = F.pmod(F.xxhash64(F.lit("sample"), F.col(key).cast("string")), F.lit(1_000_000))
    limit: Column = F.lit(0)
    for name in labels:
        limit = F.when(F.col(label) == name, F.lit(min(1_000_000, -(-1_000_000 * sample // sizes[name])))).otherwise(limit)
    counted = known.where(place < limit).select(F.col(label).alias("label"), F.col(column).alias("text")) \
        .mapInArrow(_counts(labels, buckets), "label string, bucket long, n long") \
        .groupBy("label", "bucket").agg(F.sum("n").alias("n")).toPandas()
    total = np.full((buckets, len(labels)), smoothing)
    for i, name in enumerate(labels):
        mine = counted[counted["label"] == name]
        bucket, n = mine["bucket"].to_numpy(), mine["n"].to_numpy()
        total[bucket, i] += n
    texts = np.array([sizes[name] for name in labels], np.float64)  # of all rows: the sample has about as many of each
    prior = np.log(texts / texts.sum())
    return Model(labels, np.log(total / total.sum(axis=0)).astype(np.float32), prior)


def classify(df: DataFrame, model: Model, column: str = "text", result: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``df`` with the likeliest label and its probability, for every whole text.

    ``und`` with score 0 where the text is null or has no letter, or where the model knows no label. Ties go to the
    label that sorts first. Columns that have the name of a result are replaced.
    """
    kept = [c for c in df.columns if c not in result]
    shared = df.sparkSession.sparkContext.broadcast(model)
    buckets = model.matrix.shape[0]

    def score(batches):
        own = shared.value
        names = [*own.labels, UNKNOWN]
        for batch in batches:
            data, offsets = utf8(batch.column(column))
            for a, b in slices(offsets, SLICE):
                best, sure = np.full(b - a, -1), np.zeros(b - a)
                if own.labels:
                    logs, seen = np.tile(own.prior, (b - a, 1)), np.zeros(b - a, np.int64)
                    for bucket, at in grams(data, offsets[a:b + 1], buckets):
                        logs += sums_per_text(own.matrix[bucket], at)
                        seen += np.diff(at)
                    logs -= logs.max(axis=1, keepdims=True)
                    chance = np.exp(logs)
                    top = logs.argmax(axis=1)
                    best = np.where(seen > 0, top, -1)
                    sure = np.where(seen > 0, chance[np.arange(b - a), top] / chance.sum(axis=1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(a, b - a) for c in kept), pa.array([names[i] for i in best], pa.string()), pa.array(sure)],
                    names=[*kept, *result])

    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept), f"{result[0]} string, {result[1]} double"])
    return df.mapInArrow(score, schema)


def trained(documents: DataFrame) -> Model:
    """Model of the documents that are not held out (see ``remainder``)."""
    return fit(documents.where(remainder("doc_id", 5) != 0), "lang")


def identified(documents: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents whose language is known with a probability of ``least`` at least, with their own columns."""
    label, score = free_names(documents, ("_label", "_score")).values()
    scored = classify(documents, trained(documents), result=(label, score))
    return scored.where((F.col(label) != UNKNOWN) & (F.col(score) >= least)).select(*documents.columns)


@query("op2_language_id")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return classify(documents.select("doc_id", "text"), trained(documents)).select(
        "doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")
