"""Quality classifier: supervised subword embeddings, averaged per document, softmax output, stochastic gradient descent."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from hearthwatt.llm.frames import remainder, table
from hearthwatt.llm.registry import query
from hearthwatt.llm.text import code_points, mixed, prefix_sums, slices, spans_hash, sums_per_text, utf8, word_spans

BUCKETS, SIZE, ORDERS = 1 << 17, 8, (2, 3)
#: Labelled documents that the model is fitted on, as an expected value: a hash of the key picks them.
SAMPLE = 6000
EPOCHS, RATE, BATCH = 6, 5.0, 32

_SPACE = np.array([b in b" \t\n\r\x0b\x0c" for b in range(256)])


def features(data: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS):
    """Buckets of words, of repeats and of character n-grams of some texts, with the offset of each text among them.

    A word that equals the word before it is one occurrence of the feature "repeat", whatever the word.
    """
    part, places = data[offsets[0]:offsets[-1]], offsets - offsets[0]
    starts, ends, at = word_spans(~_SPACE[part], places)
    words = spans_hash(prefix_sums(part), starts, ends)
    yield (words % np.uint64(buckets)).astype(np.int64), at
    same = np.zeros(len(words) + 1, bool)
    same[1:-1] = words[1:] == words[:-1]
    same[at] = False
    yield np.zeros(int(same.sum()), np.int64), np.concatenate(([0], np.cumsum(same)))[at]
    points, places = code_points(data, offsets)
    text = np.repeat(np.arange(len(places) - 1), np.diff(places))
    for n in ORDERS:
        m = max(0, len(points) - n + 1)
        code = np.full(m, n, np.uint64)
        for k in range(n):
            code = code * np.uint64(0x110000) + points[k:k + m]
        inside = text[:m] == text[len(text) - m:]
        yield (mixed(code[inside]) % np.uint64(buckets)).astype(np.int64), \
            np.concatenate(([0], np.cumsum(inside)))[np.minimum(places, m)]


def _counted(batches):
    """Key, label and distinct buckets with their counts, for each document."""
    for batch in batches:
        data, offsets = utf8(batch.column(2))
        buckets, counts = [], []
        for a, b in slices(offsets):
            parts = list(features(data, offsets[a:b + 1]))
            for i in range(b - a):
                bucket, n = np.unique(np.concatenate([x[at[i]:at[i + 1]] for x, at in parts]), return_counts=True)
                buckets.append(bucket.astype(np.int32))
                counts.append(n.astype(np.float32))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(buckets, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.float32()))],
            names=["place", "label", "buckets", "counts"])


def train(rows: pd.DataFrame, labels: int, buckets: int = BUCKETS, size: int = SIZE, epochs: int = EPOCHS, rate: float = RATE,
          batch: int = BATCH) -> tuple[np.ndarray, np.ndarray]:
    """Contribution of each bucket to each label's logit, and the bias: embeddings times output weights."""
    rng = np.random.default_rng(5)
    embedding = rng.uniform(-1 / size, 1 / size, (buckets, size)).astype(np.float32)
    weights, bias = np.zeros((size, labels), np.float32), np.zeros(labels, np.float32)
    rows = rows.sort_values(["place", "label"], kind="stable")
    lists, counts, wanted = rows["buckets"].tolist(), rows["counts"].tolist(), rows["label"].to_numpy()
    steps, step = max(1, epochs * -(-len(rows) // batch)), 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for first in range(0, len(order), batch):
            chosen, speed = order[first:first + batch], rate * (1 - step / steps)
            step += 1
            bucket = np.concatenate([lists[i] for i in chosen])
            share = np.concatenate([counts[i] / max(1.0, counts[i].sum()) for i in chosen])
            ends = np.cumsum([len(lists[i]) for i in chosen])
            at = np.concatenate(([0], ends))
            mean = sums_per_text(embedding[bucket] * share[:, None], at).astype(np.float32)
            logits = mean @ weights + bias
            chance = np.exp(logits - logits.max(axis=1, keepdims=True))
            chance /= chance.sum(axis=1, keepdims=True)
            chance[np.arange(len(chosen)), wanted[chosen]] -= 1
            back = chance @ weights.T
            weights -= speed / len(chosen) * (mean.T @ chance)
            bias -= speed / len(chosen) * chance.sum(axis=0)
            owner = np.repeat(np.arange(len(chosen)), np.diff(at))
            np.add.at(embedding, bucket, -speed * back[owner] * share[:, None])
    return (embedding @ weights).astype(np.float32), bias


def fit(documents: DataFrame, marks: DataFrame, label: str, column: str = "text", key: str = "doc_id", sample: int = SAMPLE,
        labels: int = 2, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Model of the documents whose mark is one of 0 to ``labels`` - 1; other marks are left out.

    About ``sample`` marks, chosen by a hash of ``key``, are joined with their texts and trained on in one task: that
    bound, and not the input, sets its size. Without examples every score is even.
    """
    known = marks.where(F.col(label).between(0, labels - 1))
    rows = known.count()
    if not rows:
        return np.zeros((buckets, labels), np.float32), np.zeros(labels, np.float32)
    place = F.pmod(F.xxhash64(F.lit("quality"), F.col(key).cast("string")), F.lit(1_000_000_000))
    marked = known.select(F.col(key).alias("key"), place.alias("place"), F.col(label).cast("int").alias("label")) \
        .where(F.col("place") < min(1_000_000_000, -(-1_000_000_000 * sample // rows)))
    counted = documents.select(F.col(key).alias("key"), F.col(column).alias("text")).join(F.broadcast(marked), "key") \
        .select("place", "label", "text") \
        .mapInArrow(_counted, "place long, label int, buckets array<int>, counts array<float>")

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        matrix, bias = train(pdf, labels, buckets)
        return pd.DataFrame({"matrix": [matrix.tobytes()], "bias": [bias.tobytes()]})

    model = counted.groupBy(F.lit(0).alias("all")).applyInPandas(learn, "matrix binary, bias binary").first()
    if model is None:
        return np.zeros((buckets, labels), np.float32), np.zeros(labels, np.float32)
    return np.frombuffer(model.matrix, np.float32).reshape(buckets, labels), np.frombuffer(model.bias, np.float32)


def score(df: DataFrame, model: tuple[np.ndarray, np.ndarray], column: str = "text", result: str = "score") -> DataFrame:
    """``df`` with the probability of label 1 for every whole text. A null or empty text gets the model's bias alone.

    A column that has the name of the result is replaced; repeated rows are scored one by one.
    """
    kept = [c for c in df.columns if c != result]
    shared, buckets = df.sparkSession.sparkContext.broadcast(model), len(model[0])

    def scored(batches):
        matrix, bias = shared.value
        gap = np.ascontiguousarray(matrix[:, 1] - matrix[:, 0])
        for batch in batches:
            data, offsets = utf8(batch.column(column))
            out = np.zeros(len(offsets) - 1)
            for a, b in slices(offsets):
                total, seen = np.zeros(b - a), np.zeros(b - a)
                for bucket, at in features(data, offsets[a:b + 1], buckets):
                    total += sums_per_text(gap[bucket], at)
                    seen += np.diff(at)
                out[a:b] = 1 / (1 + np.exp(-np.clip(total / np.maximum(seen, 1) + (bias[1] - bias[0]), -50, 50)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(out)], names=[*kept, result])

    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept), f"{result} double"])
    return df.select(*kept).mapInArrow(scored, schema)


@query("op6_quality_classifier")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 3) != 1).select("doc_id", "quality")
    scored = score(documents, fit(documents, labels, "quality"))
    return scored.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
