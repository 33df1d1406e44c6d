"""License scan compared with a scan in plain Python: phrases, altered texts, rows of one id, odd characters."""

from __future__ import annotations

import random
import re

import pytest

from hearthwatt.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text):
    """Places of the phrases, then spans from votes that are counted gram by gram."""
    w = WORD.findall((text or "").translate(UPPER))
    known = [(label, phrase.split(), True) for label, phrase in licenses.PHRASES] + [(label, t.split(), False) for label, t in licenses.TEXTS]
    base, labels, best = [], set(), 0.0
    for label, t, phrase in known:
        size = min(len(t), 3)
        votes = {}
        for i in range(len(w) - size + 1):
            for j in range(len(t) - size + 1):
                if w[i:i + size] == t[j:j + size]:
                    votes[i - j] = votes.get(i - j, 0) + 1
        grams, spans = len(t) - size + 1, []
        for d in sorted(votes):
            if phrase or not spans or d - spans[-1][0] > licenses.DRIFT:
                spans.append([d, 0, d])
            spans[-1][0], spans[-1][1] = d, spans[-1][1] + votes[d]
        if phrase:
            places = [i for i in range(len(w) - len(t) + 1) if w[i:i + len(t)] == t]
            assert places == [d for d, n, _ in spans if n == grams]
            base += [(i, label) for i in places]
        shares = [min(1.0, n / grams) for _, n, _ in spans]
        best = max([best, *shares])
        if not phrase and any(s >= licenses.COVERAGE for s in shares):
            labels.add(label)
    own = sorted({label for _, label in base})
    starts = [i for i, _ in base]
    return len(w), len(base), min(starts, default=None), max(starts, default=None), ",".join(own), ",".join(sorted(labels | set(own))), best


def check(spark, texts):
    docs = spark.createDataFrame([(i % 90 or None, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, row string, hash int")
    got = licenses.license_report(docs)
    assert got.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    rows = sorted((tuple(r)[:-1] for r in got.collect()), key=repr)
    assert rows == sorted([(i % 90 or None, *brute(t)) for i, t in enumerate(texts)], key=repr)
    return rows


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    out = [None, "", " ", "MIT", "mit license", "MIT LICENSE, mit-license; (MIT License)", "general public", "general public license" * 3,
           "mit license " * 500, "ΜIT license", "mıt licenſe", "apache\x00license", "apache license", "apachelicense apache license", "é" * 300 + " apache license é",
           "GENERAL PUBLIC LICENSE general public license", "1 2 3 mit license 4"]
    parts = [t.split() for _, t in licenses.TEXTS] + [t.split() for _, t in licenses.PHRASES]
    for _ in range(180):  # templates with words left out, put in and changed, among others of their words
        words = []
        for _ in range(rng.randrange(1, 5)):
            part = list(rng.choice(parts))
            for _ in range(rng.randrange(4)):
                at = rng.randrange(len(part))
                part[at:at + rng.randrange(2)] = [rng.choice(["of", "the", "license", "Xé", "software"])] * rng.randrange(3) or part[at:at + 1]
            words += [rng.choice(["the", "of", "mit", "license", "lorem", "1"]) for _ in range(rng.randrange(4))] + part
        out.append(rng.choice([" ", "  ", "\n", ", ", "/"]).join(words))
    return out


def test_against_plain_python(spark, texts):
    rows = check(spark, texts)
    assert sum(r[2] > 0 for r in rows) > 60 and sum("text" in r[6] for r in rows) > 40 and sum(0 < r[7] < 1 for r in rows) > 10


def test_spans(spark):
    text = "Lorem ipsum. Permission is hereby granted, free of charge, to any other person obtaining a copy of this software " \
           "and associated documentation files (the Software), to deal in the Software without restriction. See MIT license."
    report = licenses.license_report(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    words = WORD.findall(text.translate(UPPER))
    spans = {s["label"]: s for s in report["spans"]}
    assert set(spans) == {"mit", "mit-text"} and 0.75 <= spans["mit-text"]["coverage"] < 1
    assert words[spans["mit"]["first"]:spans["mit"]["last"] + 1] == ["mit", "license"]
    found = words[spans["mit-text"]["first"]:spans["mit-text"]["last"] + 1]
    assert found[:2] == ["permission", "is"] and found[-1] == "restriction"


def test_own_templates_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b c d e a b"), (1, "a b c d e a b"), (2, "b a")], "doc_id long, text string")
    got = licenses.license_report(docs, phrases=[("ab", "a b"), ("b", "b a")], texts=[("long", "a b c d e")]).collect()
    assert sorted((r["doc_id"], r["n_base"], r["first_word"], r["last_word"], r["labels"], r["score"]) for r in got) == [
        (1, 2, 0, 5, "ab,long", 1.0), (1, 2, 0, 5, "ab,long", 1.0), (2, 1, 0, 0, "b", 1.0)]
    with pytest.raises(ValueError, match="fewer than"):
        licenses.license_report(docs, phrases=[("a", "a")])
    assert licenses.license_report(docs.limit(0)).count() == 0


def test_no_python_on_the_way(spark):
    plan = licenses.license_report(spark.createDataFrame([(1, "x")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert not re.search("ArrowEvalPython|BatchEvalPython|MapInArrow|MapInPandas|FlatMapGroups", plan)
    assert "BroadcastHashJoin" in plan and "Cartesian" not in plan and "NestedLoop" not in plan
