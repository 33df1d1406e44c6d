"""Words of many texts at once: each that differs is looked up once, and the cut into portions of text changes nothing."""

from __future__ import annotations

import pyarrow as pa
import pytest

from hearthwatt.llm import packing

TEXTS = ["the end. of The end!!", None, "", " ", "ÉTÉ été.\n\n42 İX. Σας", "<|endoftext|> x", "the " * 5000, "wort " * 3 + "junk\tjunk 12,5%"]


class Counted(dict):
    looked = 0

    def get(self, key, default=None):
        self.looked += 1
        return super().get(key, default)

    def __getitem__(self, key):
        self.looked += 1
        return super().__getitem__(key)


def test_a_frequent_word_is_looked_up_once():
    """Before, every word of every text was looked up."""
    words = packing.WordIds(packing.tokenizer_path())
    words.words = Counted()
    first, second = words.encode(["the end of the end . " * 2000, "the start"])
    assert words.words.looked <= 20
    assert first == words.encode(["the end of the end . "])[0] * 2000 and second == words.encode(["the"])[0] + words.encode(["start"])[0]


def pieces(texts, large=False):
    kind = pa.large_string() if large else pa.string()
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, kind)], names=["doc_id", "text"])
    return [row for out in packing._cut(packing.tokenizer_path(), 16, 1)(iter([batch])) for row in zip(*out.to_pydict().values())]


@pytest.mark.parametrize("at_once", [1, 7, 40, 1 << 22])
def test_portions_change_nothing(monkeypatch, at_once):
    want = [row for i, t in enumerate(TEXTS) for row in [(i, *r[1:]) for r in pieces([t])]]
    monkeypatch.setattr(packing, "AT_ONCE", at_once)
    assert pieces(TEXTS) == pieces(TEXTS, True) == want
    assert pieces([]) == []


def test_words_are_forgotten_and_learnt_again(monkeypatch):
    words, texts = packing.WordIds(packing.tokenizer_path()), ["a b c d", "c d e f", "e f a b c d g"]
    want = words.encode(texts)
    monkeypatch.setattr(packing, "REMEMBERED", 5)
    assert [packing.WordIds(packing.tokenizer_path()).encode([t])[0] for t in texts] == want
    small = packing.WordIds(packing.tokenizer_path())
    assert [small.encode([t])[0] for t in texts] == want
