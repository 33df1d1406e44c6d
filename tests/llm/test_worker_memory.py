"""What Python workers hold: rows at once, and what stays when a stage is over and the next one uses them."""

from __future__ import annotations

import random
import tracemalloc

import pyarrow as pa
from pyspark.sql import functions as F

from hearthwatt.llm import language, neardup, packing

SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_remembered_words_take_few_bytes():
    """Before, 30,000 words stayed as Python objects of some hundred bytes each."""
    letters, words = random.Random(3), packing.WordIds(packing.tokenizer_path())
    texts = [" ".join("".join(letters.choices("abcdefghij", k=9)) for _ in range(300)) for _ in range(100)]
    tracemalloc.start()
    for text in texts:
        words.encode([text])
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 2_000_000


def test_words_used_last_stay(monkeypatch):
    words, learnt = packing.WordIds(packing.tokenizer_path()), []
    learn = words._learn
    monkeypatch.setattr(words, "_learn", lambda new: learnt.extend(new) or learn(new))
    monkeypatch.setattr(packing, "REMEMBERED", 6)
    texts = ["one two three", "four one five", "six one seven", "one two six seven", ""]
    for text in texts:
        want = packing.WordIds(packing.tokenizer_path()).full.encode(text, add_special_tokens=False).ids
        assert words.encode([text]) == [b"".join(i.to_bytes(4, "little") for i in want)]
    assert learnt == ["one", "two", "three", "four", "five", "six", "seven", "two", ""]


def test_few_texts_at_once(spark, monkeypatch):
    """Before, a worker and its executor held up to 10,000 texts, or pairs of sets, each."""
    sketches = neardup._sketches

    def few(size):
        def run(batches):
            def watched():
                for batch in batches:
                    if batch.num_rows > 1000:
                        raise ValueError(f"{batch.num_rows} rows at once")
                    yield batch
            yield from sketches(size)(watched())
        return run

    monkeypatch.setattr(neardup, "_sketches", few)
    before = spark.conf.get(SETTING)
    frame = spark.range(2500).select(F.col("id").alias("doc_id"), F.format_string("a b c d e%d", F.col("id") % 2000).alias("text")).coalesce(1)
    assert neardup.near_duplicates(frame).where("kept").count() == 2000
    assert spark.conf.get(SETTING) == before


def test_languages_leave_in_slices(spark, monkeypatch):
    """Before, all texts of a batch left together."""
    examples = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate([("aa ab ba", "x"), ("yy yz zy", "y")] * 20)], "doc_id long, text string, lang string")
    model = language.fit(examples, "lang")
    texts = ["aab baa " * 30, "zyy yyz " * 30, None, "", "12"] * 40

    class Frame:
        columns, schema, sparkSession = examples.columns, examples.schema, spark

        def mapInArrow(self, score, schema):
            batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": texts, "lang": [None] * len(texts)})
            return [out.to_pylist() for out in score(iter([batch]))]

    whole = language.classify(Frame(), model)
    monkeypatch.setattr(language, "SLICE", 1000)
    sliced = language.classify(Frame(), model)
    assert max(sum(len(r["text"] or "") for r in out) for out in sliced) <= 1000
    one, two = sum(whole, []), sum(sliced, [])
    assert [(r["doc_id"], r["text"], r["lang_pred"], round(r["score"], 9)) for r in one] == [(r["doc_id"], r["text"], r["lang_pred"], round(r["score"], 9)) for r in two]
    assert [r["lang_pred"] for r in one[:5]] == ["x", "y", "und", "und", "und"]
