"""The language model and the quality classifier against plain Python: the same n-grams, counts, probabilities and gradient steps."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa

from hearthwatt.llm import language, quality
from hearthwatt.llm.text import _BASE, utf8

MASK = (1 << 64) - 1
TEXTS = [None, "", "  ", "123", "Ab", "ab, c", " the cat.  THE dog", "éÉß İı", "naïve  wörter\n\tund mehr", "a", "日本 語", "x1y2", "the the the cat cat", "𝒳 a"]


def mix(x):
    x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ x >> 27) * 0x94D049BB133111EB) & MASK
    return x ^ x >> 31


def letter_buckets(text, buckets):
    line = [0]
    for i, c in enumerate(text or ""):
        if c.isalpha():
            line.append(ord(c.lower()) if len(c.lower()) == 1 else ord(c))
        elif i and text[i - 1].isalpha():
            line.append(0)
    out = []
    for n in language.ORDERS:
        for i in range(len(line) - n + 1):
            gram = line[i:i + n]
            if n > 1 or gram[0]:
                code = n
                for x in gram:
                    code = (code * _BASE + x) & MASK
                out.append(mix(code) % buckets)
    return out


def test_language_by_plain_counts(spark):
    rng = random.Random(4)
    vocabulary = {"en": "the of and cat house", "de": "der die und katze haus", "fr": "le la et chat maison"}
    rows = [(i, " ".join(rng.choice(vocabulary[name].split()) for _ in range(rng.randrange(1, 30))), name) for i, name in enumerate(rng.choices(list(vocabulary), k=90))]
    rows += [(100, None, "en"), (101, "le chat", None)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "lang", buckets=512)
    known = [r for r in rows if r[1] is not None and r[2] is not None]
    assert model.labels == ["de", "en", "fr"]
    logs = {}
    for name in model.labels:
        counts = Counter(b for _, text, lang in known if lang == name for b in letter_buckets(text, 512))
        total = sum(counts.values()) + 0.5 * 512
        logs[name] = [math.log((counts[b] + 0.5) / total) for b in range(512)]
    texts = [*TEXTS, *(r[1] for r in rows[:20])]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in language.classify(frame, model).collect():
        seen = letter_buckets(texts[r["doc_id"]], 512)
        if not seen:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        score = {name: math.log(sum(lang == name for *_, lang in known) / len(known)) + sum(logs[name][b] for b in seen) for name in model.labels}
        best = max(model.labels, key=score.get)
        assert r["lang_pred"] == best and abs(r["score"] - 1 / sum(math.exp(x - score[best]) for x in score.values())) < 1e-3


def plain_features(text, buckets):
    text = text or ""
    words = text.encode().split()

    def named(word):
        return mix((sum((b + 1) * pow(_BASE, k, 1 << 64) for k, b in enumerate(word)) + len(word)) & MASK)

    out = [named(w) % buckets for w in words] + [0 for a, b in zip(words, words[1:]) if a == b]
    for n in quality.ORDERS:
        for i in range(len(text) - n + 1):
            code = n
            for c in text[i:i + n]:
                code = (code * 0x110000 + ord(c)) & MASK
            out.append(mix(code) % buckets)
    return Counter(out)


def test_quality_features():
    data, offsets = utf8(pa.array(TEXTS, pa.string()))
    parts = list(quality.features(data, offsets, 997))
    for i, text in enumerate(TEXTS):
        assert Counter(np.concatenate([x[at[i]:at[i + 1]] for x, at in parts]).tolist()) == plain_features(text, 997), repr(text)


def test_quality_by_plain_gradient_steps():
    rng = random.Random(6)
    texts = [" ".join(rng.choice(("good fine prose here" if i % 2 else "buy buy now cheap").split()) for _ in range(6)) for i in range(23)]
    buckets, size, epochs, rate, batch = 64, 4, 3, 2.0, 5
    counted = [plain_features(t, buckets) for t in texts]
    frame = pd.DataFrame({"place": range(len(texts)), "label": [i % 2 for i in range(len(texts))], "buckets": [np.array(sorted(c), np.int32) for c in counted],
                          "counts": [np.array([c[b] for b in sorted(c)], np.float32) for c in counted]})
    matrix, bias = quality.train(frame, 2, buckets, size, epochs, rate, batch)

    numbers = np.random.default_rng(5)
    embedding = numbers.uniform(-1 / size, 1 / size, (buckets, size)).tolist()
    weights, plain_bias = [[0.0, 0.0] for _ in range(size)], [0.0, 0.0]
    steps, step = epochs * -(-len(texts) // batch), 0
    for _ in range(epochs):
        order = numbers.permutation(len(texts)).tolist()
        for first in range(0, len(order), batch):
            chosen, speed = order[first:first + batch], rate * (1 - step / steps)
            step += 1
            changes, means, errors = [], [], []
            for i in chosen:
                total = sum(counted[i].values())
                mean = [sum(n * embedding[b][k] for b, n in counted[i].items()) / total for k in range(size)]
                logits = [sum(mean[k] * weights[k][j] for k in range(size)) + plain_bias[j] for j in (0, 1)]
                chance = [math.exp(x) / sum(map(math.exp, logits)) for x in logits]
                chance[i % 2] -= 1
                means.append(mean)
                errors.append(chance)
                back = [sum(chance[j] * weights[k][j] for j in (0, 1)) for k in range(size)]
                changes += [(b, k, speed * back[k] * n / total) for b, n in counted[i].items() for k in range(size)]
            for k in range(size):
                for j in (0, 1):
                    weights[k][j] -= speed / len(chosen) * sum(m[k] * e[j] for m, e in zip(means, errors))
            for j in (0, 1):
                plain_bias[j] -= speed / len(chosen) * sum(e[j] for e in errors)
            for b, k, change in changes:
                embedding[b][k] -= change
    want = [[sum(embedding[b][k] * weights[k][j] for k in range(size)) for j in (0, 1)] for b in range(buckets)]
    assert np.allclose(matrix, want, atol=1e-3) and np.allclose(bias, plain_bias, atol=1e-3) and np.abs(matrix).max() > 0.1
