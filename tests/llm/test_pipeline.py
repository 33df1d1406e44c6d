"""The stages against plain Python over a whole small table."""

from __future__ import annotations

import re
import zlib

import duckdb
import numpy as np

import corpus_pipeline
from hearthwatt.llm import language, neardup, packing, secrets
from hearthwatt.llm.frames import stored

SF = "/root/testdata/sf0.01"
TABLE = [chr(c + 32) if 65 <= c <= 90 else chr(c) if chr(c).isalnum() else " " for c in range(128)]


def words(text):
    return re.sub(r"[\x00-\x7f]", lambda m: TABLE[ord(m[0])], text).split(" ")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    rows = {r.doc_id: r.asDict() for r in docs.collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF), name)
        assert docs.columns == names
        kept[name] = {r.doc_id: r.asDict() for r in docs.collect()}
        assert len(kept[name]) == docs.count() > 0

    scored = {r.doc_id: r for r in language.op2(spark, SF).collect()}
    first = {k: v for k, v in rows.items() if scored[k].lang_pred != "und" and scored[k].score >= 0.5}
    assert kept["language_id"] == first

    frame = spark.createDataFrame([tuple(v[c] for c in names) for v in first.values()], names)
    want = {r.doc_id for r in neardup.near_duplicates(frame, size=5).collect() if r.kept}
    assert kept["minhash_near_dedup"] == {k: first[k] for k in want}
    assert 0 < len(first) - len(want) < 0.3 * len(first)

    items = [[w for w in words(t) if w] for (t,) in duckdb.sql(f"SELECT text FROM '{SF}/benchmark.parquet'").fetchall()]
    windows = {" " + " ".join(item[i:i + 10]) + " " for item in items for i in range(max(1, len(item) - 9))}
    clean = {}
    for k in want:
        text = " " + " ".join(w for w in words(rows[k]["text"]) if w) + " "
        if not any(w in text for w in windows):
            clean[k] = first[k]
    assert kept["benchmark_decontamination"] == clean
    assert 0 < len(want) - len(clean)

    spans = {r.doc_id: r.spans for r in secrets.op8(spark, SF).collect()}
    masked = 0
    for k, row in kept["secret_scan"].items():
        text, merged = rows[k]["text"], []
        for a, b in sorted(tuple(map(int, s.split(":")[1:])) for s in spans[k].split(",") if s):
            if merged and a < merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        for a, b in reversed(merged):
            text = text[:a] + "[secret]" + text[b:]
        masked += bool(merged)
        assert row == clean[k] | {"text": text, "n_chars": len(text) if merged else clean[k]["n_chars"]}
    assert masked > 0 and set(kept["secret_scan"]) == set(clean)


def test_run(spark):
    from tokenizers import Tokenizer

    pieces = corpus_pipeline.run(spark, SF).toPandas()
    assert corpus_pipeline.ORACLE_SQL is None
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    checked = 0
    for doc_id, own in pieces.groupby("doc_id"):
        own = own.sort_values("start")
        assert own["start"].tolist() == [0, *own["length"].cumsum().tolist()[:-1]] and own["length"].sum() == own["doc_tokens"].iloc[0]
        ids = [*tokenizer.encode(texts[doc_id], add_special_tokens=False).ids, 1]
        if len(ids) == own["doc_tokens"].iloc[0]:
            first = own.iloc[0]
            checked += first["ids_crc32"] == zlib.crc32(np.array(ids[:first["length"]], "<u4").tobytes())
    assert checked > 0.9 * pieces["doc_id"].nunique()
    for _, own in pieces.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own["offset"].tolist() == [0, *own["length"].cumsum().tolist()[:-1]] and own["length"].sum() <= 2048
