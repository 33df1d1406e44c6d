"""Benchmark decontamination: one Aho-Corasick automaton over the words of all test items scans each text once."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from hearthwatt.llm.frames import beside, table
from hearthwatt.llm.registry import query
from hearthwatt.llm.text import byte_table

WINDOW = 10
#: Normalised benchmark bytes in one automaton (about 40 times as much memory); larger benchmarks take several passes.
AUTOMATON_BYTES = 4 << 20

_WORD = b"0123456789abcdefghijklmnopqrstuvwxyz"
_TABLE = bytes(int(x) or 0x20 for x in byte_table(_WORD))
RESULTS = ("n_words", "hit_words", "item_ids", "spans")
_FOUND = "n_words long, hit_words array<long>, item_ids array<string>, spans array<struct<start:long,end:long>>"


def words(text: bytes) -> list[bytes]:
    """Lower-cased words of a UTF-8 text: digits, letters and everything beyond ASCII."""
    return text.translate(_TABLE).split()


def windows(item: list[bytes], size: int) -> Iterator[tuple[bytes, ...]]:
    """All runs of ``size`` words; an item of fewer words is one window, an empty one has none."""
    if item:
        for i in range(max(1, len(item) - size + 1)):
            yield tuple(item[i:i + size])


class Scanner:
    """Automaton over word numbers. Windows of several items are stored once, with all their items."""

    def __init__(self, items: list[tuple[str, bytes]], size: int):
        import ahocorasick

        owners: dict[tuple[bytes, ...], set[str]] = {}
        for item_id, text in items:
            for window in windows(words(text), size):
                owners.setdefault(window, set()).add(item_id)
        self.number = {w: i + 1 for i, w in enumerate(sorted({w for window in owners for w in window}))}
        self.found = [(len(window), ids) for window, ids in owners.items()]
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for k, window in enumerate(owners):
            self.automaton.add_word(tuple(self.number[w] for w in window), k)
        if owners:
            self.automaton.make_automaton()

    def scan(self, found: list[bytes]) -> tuple[list[int], set[str]]:
        """Word positions inside any occurrence, and the items that occur."""
        if not self.found or not found:
            return [], set()
        number, flags, ids = self.number.get, bytearray(len(found)), set()
        for end, k in self.automaton.iter(tuple([number(w, 0) for w in found])):
            length, owners = self.found[k]
            flags[end - length + 1:end + 1] = b"\x01" * length
            ids |= owners
        return [i for i, flag in enumerate(flags) if flag] if ids else [], ids


def hit_spans(text: bytes, hits: list[int]) -> list[dict[str, int]]:
    """Runs of hit words as code point ranges of the original text."""
    places = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(_TABLE))]
    runs: list[list[int]] = []
    for i in hits:
        if runs and runs[-1][1] == i:
            runs[-1][1] = i + 1
        else:
            runs.append([i, i + 1])
    return [{"start": len(text[:places[a][0]].decode("utf-8", "replace")),
             "end": len(text[:places[b - 1][1]].decode("utf-8", "replace"))} for a, b in runs]


def _pass(df: DataFrame, column: str, items, size: int, kept: list[str]) -> DataFrame:
    """One scan; adds to what an earlier scan of the same rows found."""
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept), _FOUND])

    def scan(batches):
        scanner = Scanner(items.value, size)
        for batch in batches:
            texts = batch.column(column).cast(pa.binary()).to_pylist()
            before = batch.column("hit_words").to_pylist() if "hit_words" in batch.schema.names else [None] * len(texts)
            ids_before = batch.column("item_ids").to_pylist() if "item_ids" in batch.schema.names else [None] * len(texts)
            rows = []
            for text, hit, ids in zip(texts, before, ids_before):
                found = words(text) if text else []
                hits, items_found = scanner.scan(found)
                hits = sorted({*hits, *(hit or ())})
                rows.append((len(found), hits, sorted({*items_found, *(ids or ())}), hit_spans(text, hits) if hits else []))
            n, hits, ids, spans = map(list, zip(*rows)) if rows else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(n, pa.int64()), pa.array(hits, pa.list_(pa.int64())),
                 pa.array(ids, pa.list_(pa.string())),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                names=[*kept, "n_words", "hit_words", "item_ids", "spans"])

    return df.mapInArrow(scan, schema)


def decontaminate(documents: DataFrame, benchmark: DataFrame, column: str = "text", item_key: str = "item_id",
                  item_column: str = "text", size: int = WINDOW, automaton_bytes: int = AUTOMATON_BYTES) -> DataFrame:
    """Every row of ``documents`` with ``n_words``, ``hit_words`` (word numbers inside any window of a test item),
    ``item_ids`` (items with occurring windows, sorted as text) and ``spans`` (hit runs as code point ranges).

    Words are runs of digits, ASCII letters (lower-cased) and characters beyond ASCII. An item of fewer than ``size``
    words is one window; an item without words or without an id is none. The items are broadcast, so their size is
    measured first: beyond ``automaton_bytes`` they are split by a hash of their id, and each part scans the rows again.
    A null or empty text has no words and no hits; repeated rows are scanned one by one; an empty benchmark hits
    nothing. Columns of ``documents`` that have the name of a result are replaced.
    """
    spark = documents.sparkSession
    kept = [c for c in documents.columns if c not in RESULTS]
    items = benchmark.select(F.col(item_key).cast("string").alias("id"), F.col(item_column).cast("binary").alias("item")) \
        .where("id IS NOT NULL AND item IS NOT NULL")
    total = items.agg(F.sum(F.length("item"))).first()[0] or 0
    parts = max(1, -(-total // automaton_bytes))
    df = documents.select(*kept)
    for part in range(parts):
        mine = items.where(F.pmod(F.xxhash64("id"), F.lit(parts)) == part)
        rows = [(r.id, bytes(r.item)) for r in mine.toLocalIterator()]
        df = _pass(df, column, spark.sparkContext.broadcast(rows), size, kept)
    return df


def clean(documents: DataFrame, benchmark: DataFrame, column: str = "text", **options) -> DataFrame:
    """The documents without any hit, with their own columns, whatever their names."""
    return beside(documents, RESULTS, column, lambda docs, text: decontaminate(docs, benchmark, text, **options).where(F.size("hit_words") == 0))


SQL = r"""
WITH item AS (
    SELECT CAST(item_id AS VARCHAR) AS item_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
win AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS words
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM item WHERE len(w) > 0)),
doc AS (
    SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
    FROM documents),
place AS (
    SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS words
    FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
          FROM doc, (SELECT DISTINCT size FROM win) WHERE len(w) >= size)),
hit AS (SELECT doc_id, i, place.size, item_id FROM place JOIN win ON place.size = win.size AND place.words = win.words),
word_hits AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hit) GROUP BY 1),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM hit GROUP BY 1)
SELECT doc.doc_id, len(w) AS n_words, coalesce(word_hits.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(word_hits.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN word_hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op1_decontamination", SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", F.size("hit_words").cast("long").alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"))
