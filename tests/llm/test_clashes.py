"""Columns that are named like those of an operator keep their values through the stages, and words made to hash alike don't."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from hearthwatt.llm import decontamination, neardup, secrets
from hearthwatt.llm.frames import free_names

NAMES = ["n_words", "hit_words", "item_ids", "Spans", "secrets", "_label", "_score", "__label", "label", "score", "lang_pred", "row", "text_", "times", "id"]


def test_stages_keep_the_values_of_clashing_columns(spark, tmp_path):
    words = [f"wort{i}" for i in range(400)]
    texts = [" ".join(words[(7 * i + j * (i + 1)) % 400] for j in range(50)) for i in range(40)]
    texts[5] += " password=hunter2secret"
    docs = spark.createDataFrame([(i, t, "de", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({c: F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")) for c in NAMES})
    folder = f"file://{tmp_path}"
    spark.createDataFrame([(1, texts[9])], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    want = {r["doc_id"]: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        rows = out.collect()
        assert out.columns == docs.columns and len(rows) >= 39
        changed = {"text", "n_chars"} if name == "secret_scan" else set()
        for r in rows:
            assert all(r[c] == want[r["doc_id"]][c] for c in docs.columns if c not in changed), name
        if name == "secret_scan":
            assert [r["doc_id"] for r in rows if r["text"] != want[r["doc_id"]]["text"]] == [5]


def test_text_in_a_clashing_column(spark):
    docs = spark.createDataFrame([(1, "password=hunter2secret x"), (2, "the test item of ten words and a few more words")], "doc_id long, spans string")
    items = spark.createDataFrame([(1, "the test item of ten words and a few more words")], "item_id long, text string")
    assert [tuple(r) for r in decontamination.clean(docs, items, column="spans").collect()] == [(1, "password=hunter2secret x")]
    masked = secrets.redacted(docs.withColumnRenamed("spans", "secrets"), column="secrets").orderBy("doc_id").collect()
    assert masked[0]["secrets"] == "[secret] x" and masked[1]["secrets"].startswith("the test")
    assert free_names(docs, ["SPANS", "new"]) == {"SPANS": "_SPANS", "new": "new"}


def thue_morse(n):
    word = [0]
    while len(word) < n:
        word += [1 - x for x in word]
    return "".join("ab"[x] for x in word)


def test_words_that_any_polynomial_takes_for_equal(spark):
    one = thue_morse(1024)
    two = one.translate(str.maketrans("ab", "ba"))
    rest = " ".join(f"w{i}" for i in range(6))
    docs = spark.createDataFrame([(1, one), (2, two), (3, f"{one} {rest}"), (4, f"{two} {rest}"), (5, one)], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(docs).collect()}
    assert got == {1: (1, 1), 2: (1, 2), 3: (4, 3), 4: (4, 4), 5: (1, 1)}


def test_residues_are_those_of_the_words():
    from hearthwatt.llm.text import PRIME, RESIDUES, spans_residue

    rng = np.random.default_rng(3)
    values = rng.integers(0, 256, 70_000).astype(np.uint8)
    starts = np.sort(rng.integers(0, 69_000, 200))
    ends = starts + rng.integers(0, 900, 200)
    base = RESIDUES.bases[0]
    want = [sum((int(v) + 1) * pow(base, k, PRIME) for k, v in enumerate(values[a:b])) % PRIME for a, b in zip(starts, ends)]
    assert spans_residue(values, starts, ends).tolist() == want
