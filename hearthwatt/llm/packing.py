"""Packing: first-fit decreasing with a tournament tree of bin capacities, in randomised groups of pieces."""

from __future__ import annotations

import functools
import os
import re
import unicodedata
import zlib
from array import array
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from hearthwatt.llm.frames import small_batches, stored, table
from hearthwatt.llm.registry import query

SEQUENCE, END = 2048, 1
#: Pieces per group: their lengths are all that one task holds.
GROUP = 3000
#: Words whose ids a worker remembers from one portion of text to the next; beyond, the half used last stays.
REMEMBERED = 1 << 18
#: New words that the tokenizer gets at once.
LEARNT = 4096
#: Bytes of text that are encoded at once, and one text more.
AT_ONCE = 1 << 22
#: Punctuation behind a letter or digit, up to the end of the word: always split from what stands before it.
CLOSING = re.compile(r"[.,;:!?%*#$&)(|+=/](?<=[^\W_].)[.,;:!?%*#$&)(|+=/]*(?=[ \n]|\Z)")

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


class WordIds:
    """Ids of a text as bytes (little-endian, four each). No token of the vocabulary holds or depends on white space, so
    a text's ids are those of its words between spaces; the punctuation behind a word's letters is a word of its own.
    Words met before are looked up, new ones are encoded together. They are remembered as arrays, which
    take less than Python objects: a worker that has packed does the work of other stages later. A run of lower-case letters is what the normaliser
    and the splitter of the vocabulary leave as it is, so it goes straight to the model; from a to z its bytes are its letters, too.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.full = Tokenizer.from_str(Path(path).read_text())
        self.model = Tokenizer(self.full.model)
        self.model.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.bare = Tokenizer(self.full.model)
        self.words: dict[str, bytes] = {}  # those being learnt
        self.known = pa.array([], pa.large_string())
        self.ids = np.empty(0, "<u4")
        self.sizes, self.used, self.portion = np.empty(0, np.int32), np.empty(0, np.int32), 0

    @staticmethod
    def spaced(text: str) -> str:
        """A text with single spaces between its words, in lower case where that changes neither special tokens nor letters in context."""
        if "İ" in text:  # its lower case ends with a mark, which would join the punctuation behind it
            return text.replace("\n", " ")
        if "<|" not in text and "Σ" not in text and (text.isascii() or unicodedata.is_normalized("NFC", text)):
            text = text.lower()
        return CLOSING.sub(r" \g<0>", text).replace("\n", " ")

    def _learn(self, new: list[str]) -> list[bytes]:
        plain = [x for x in new if x.isalpha() and x == x.lower() and (x.isascii() or unicodedata.is_normalized("NFC", x))]
        latin, other = [x for x in plain if x.isascii()], [x for x in plain if not x.isascii()]
        for tokenizer, some in ((self.bare, latin), (self.model, other), (self.full, list(set(new).difference(plain)))):
            for at in range(0, len(some), LEARNT):  # what the tokenizer returns is far larger than the ids
                part = some[at:at + LEARNT]
                encoded = tokenizer.encode_batch_fast(part, add_special_tokens=False)
                self.words.update((x, array("I", e.ids).tobytes()) for x, e in zip(part, encoded))
        ids = [self.words[x] for x in new]
        self.words.clear()
        return ids

    def _forget(self) -> None:
        """Leaves the half of the words that was used last."""
        keep = np.zeros(len(self.known), bool)
        keep[np.argsort(-self.used, kind="stable")[:REMEMBERED // 2]] = True
        self.known, self.ids = self.known.filter(pa.array(keep)), self.ids[np.repeat(keep, self.sizes)]
        self.sizes, self.used = self.sizes[keep], self.used[keep]

    def _places(self, words: pa.Array) -> np.ndarray:
        """Where some words, which all differ, stand among the words remembered; new ones are learnt."""
        if len(self.known) > REMEMBERED:
            self._forget()
        found = pc.index_in(words, value_set=self.known)
        lacking = found.is_null()
        place, new = found.fill_null(0).to_numpy().copy(), words.filter(lacking)
        if len(new):
            place[lacking.to_numpy(zero_copy_only=False)] = len(self.known) + np.arange(len(new))
            ids = self._learn(new.to_numpy(zero_copy_only=False).tolist())
            self.known = pa.concat_arrays([self.known, new])
            self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(ids), "<u4")])
            self.sizes = np.concatenate([self.sizes, np.fromiter(map(len, ids), np.int32, len(ids)) // 4])
            self.used = np.concatenate([self.used, np.empty(len(new), np.int32)])
        self.portion += 1
        self.used[place] = self.portion
        return place

    def encode(self, texts: list[str]) -> list[bytes]:
        """Only the words that differ are looked up one by one; their ids are put in place by numpy."""
        if not texts:
            return []
        split = pc.split_pattern(pa.array(list(map(self.spaced, texts)), pa.large_string()), " ")
        coded = split.flatten().dictionary_encode()
        place = self._places(coded.dictionary)
        first, code = np.cumsum(self.sizes, dtype=np.int64) - self.sizes, coded.indices.to_numpy()
        size = self.sizes[place][code]
        before = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        start = first[place][code] - before[:-1]
        out = self.ids[np.repeat(start, size) + np.arange(before[-1])].tobytes()
        ends = (4 * before[split.offsets.to_numpy()]).tolist()
        return [out[first:last] for first, last in zip(ends, ends[1:])]


@functools.lru_cache(1)
def word_ids(path: str) -> WordIds:
    """One memory of words for all tasks of a worker."""
    return WordIds(path)


def _cut(path: str, sequence: int, end: int):
    tail = np.array([end], "<u4").tobytes()

    def cut(batches):
        words = word_ids(path)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy()
            firsts = np.flatnonzero(np.diff(np.cumsum(sizes, dtype=np.int64) // AT_ONCE, prepend=-1)).tolist()
            for first, last in zip(firsts, [*firsts[1:], batch.num_rows]):
                part = batch.slice(first, last - first)
                rows = []
                for doc_id, ids in zip(part.column(0).to_pylist(), words.encode([t or "" for t in part.column(1).to_pylist()])):
                    ids += tail
                    for at in range(0, len(ids), 4 * sequence):
                        piece = ids[at:at + 4 * sequence]
                        rows.append((doc_id, at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                                 names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
    return cut


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length. The inner nodes of the tree hold the largest free capacity below them, so the
    first bin that fits is found, and a new one opened, in a step per level."""
    n = max(1, len(lengths))
    leaves = 1 << (n - 1).bit_length()
    free = [capacity] * (2 * leaves)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    order = np.argsort(-lengths, kind="stable")
    for i, length in zip(order.tolist(), lengths[order].tolist()):
        node = 1
        while node < leaves:
            node *= 2
            if free[node] < length:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - free[node]
        free[node] -= length
        while node > 1:
            node //= 2
            left, right = free[2 * node], free[2 * node + 1]
            free[node] = left if left > right else right
    return bins, offsets


def pack(documents: DataFrame, path: str | None = None, column: str = "text", key: str = "doc_id", sequence: int = SEQUENCE,
         end: int = END, group: int = GROUP) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A document is its ids and ``end``; a null or empty text is ``end`` alone. It is cut after each ``sequence`` ids,
    so only what is left over shares a sequence. The pieces are dealt at random to groups of about ``group``, which
    no frequent source or repeated row can fill, and each group is packed alone: its largest piece first, each into
    the first sequence with room. Pieces are kept in the shared folder, so a lost task repeats the same deal. Repeated
    rows and rows without ``key`` are documents like others. No rows: no pieces. Other columns are not read.
    """
    chosen = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(column).alias("text"))
    with small_batches(documents.sparkSession):
        pieces = stored(chosen.mapInArrow(_cut(path or tokenizer_path(), sequence, end), PIECES), "pieces")
    groups = max(1, -(-pieces.count() // group))

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("place", kind="stable")
        bins, offsets = first_fit_decreasing(pdf["length"].to_numpy(), sequence)
        return pdf.assign(sequence_id=pdf["part"] * (1 << 32) + bins, offset=offsets).drop(columns=["part", "place"])

    place = F.monotonically_increasing_id()
    return (pieces.withColumn("place", place)
            .withColumn("part", F.pmod(F.xxhash64("place", F.lit(17)), F.lit(groups)))
            .groupBy("part").applyInPandas(packed, f"{PIECES}, sequence_id long, offset long"))


@query("op3_packing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
