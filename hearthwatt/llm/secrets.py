"""Secret scans: known patterns, and random strings that a public vocabulary can only spell in many short tokens."""

from __future__ import annotations

import base64
import functools
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from hearthwatt.llm.frames import beside, table
from hearthwatt.llm.registry import query
from hearthwatt.llm.text import byte_table, slices, utf8, word_spans

KINDS = ("assign", "access", "hex", "random")

# The patterns that every result must follow.
ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX_LEAST, ACCESS_LEAST, VALUE_LEAST = 24, 20, 6
KEYWORDS = (b"passw", b"secret", b"token", b"api")

#: A candidate string: its least length, and the most characters a token may cover on average.
RANDOM_LEAST, RANDOM_RATIO = 20, 2.2
#: Lengths of hexadecimal digests (MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512): known forms, not secrets by themselves.
DIGESTS = (32, 40, 56, 64, 96, 128)

_HEX = np.array([chr(b) in "0123456789abcdef" for b in range(256)])
_TOKEN = np.array([bool(re.match(r"[A-Za-z0-9+/_=-]", chr(b))) and b < 128 for b in range(256)])
_IDENTIFIER = re.compile(rb"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|[0-9_+/=-]+|[A-Za-z]+([_/-]+[A-Za-z]+)*[_/=-]*[0-9]{0,6}|(.)\3*", re.S)
#: What separates the parts of a run; a UUID is one part.
_PARTS = re.compile(rb"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|[^/_=-]+")
_WORD = re.compile(rb"[A-Za-z]+[0-9]{0,6}")


@functools.lru_cache(2)
def encoding(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def is_random(value: bytes, tokens) -> bool:
    """Whether a string has letters and digits, is no digest or identifier, and gets few characters per token."""
    if not (re.search(rb"[0-9]", value) and re.search(rb"[A-Za-z]", value)) or _IDENTIFIER.fullmatch(value):
        return False
    return not _is_digest(value) and _ratio(value, tokens) <= RANDOM_RATIO


def _is_digest(value: bytes) -> bool:
    return len(value) in DIGESTS and bool(re.fullmatch(rb"[0-9a-f]+|[0-9A-F]+", value))


def _ratio(value: bytes, tokens) -> float:
    return len(value) / len(tokens.encode_ordinary(value.decode("ascii")))


def random_spans(value: bytes, tokens) -> list[tuple[int, int]]:
    """Start and end of the random strings in a run: the run itself, or else its parts, alone or several in a row.

    Words, numbers and known forms end a row, so words that are joined to a random string do not raise its ratio.
    """
    if is_random(value, tokens):
        return [(0, len(value))]
    if not re.search(rb"[0-9]", value):
        return []
    out, row = [], []

    def close():
        if row and row[-1] - row[0] >= RANDOM_LEAST and is_random(value[row[0]:row[-1]], tokens):
            out.append((row[0], row[-1]))
        row.clear()

    for part in _PARTS.finditer(value):
        text = part.group()
        alone = len(text) >= RANDOM_LEAST and is_random(text, tokens)
        plain = _ratio(text, tokens) > RANDOM_RATIO if _WORD.fullmatch(text) else _IDENTIFIER.fullmatch(text) or _is_digest(text)
        if alone or plain:
            close()
        if alone:
            out.append(part.span())
        elif not plain:
            row += part.span()
    close()
    return out


def long_runs(data: np.ndarray, offsets: np.ndarray, member: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, start and end (within the text) of all maximal runs of member bytes of the least length."""
    starts, ends, _ = word_spans(member[data[offsets[0]:offsets[-1]]], offsets - offsets[0])
    long = ends - starts >= least
    starts, ends = starts[long], ends[long]
    text = np.searchsorted(offsets - offsets[0], starts, side="right") - 1
    return text, starts - (offsets[text] - offsets[0]), ends - (offsets[text] - offsets[0])


def scan(data: np.ndarray, offsets: np.ndarray, tokens) -> list[list[tuple[int, int, int]]]:
    """For each text the sorted (start, number of the kind, end), in bytes."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(offsets) - 1)]
    for a, b in slices(offsets):
        window = offsets[a:b + 1]
        for text, start, end in zip(*map(np.ndarray.tolist, long_runs(data, window, _HEX, HEX_LEAST))):
            found[a + text].append((start, 2, end))
        for text, start, end in zip(*map(np.ndarray.tolist, long_runs(data, window, _TOKEN, RANDOM_LEAST))):
            at = int(offsets[a + text])
            found[a + text] += [(start + x, 3, start + y) for x, y in random_spans(data[at + start:at + end].tobytes(), tokens)]
        for i in range(a, b):
            text = data[offsets[i]:offsets[i + 1]].tobytes()
            if b"AKIA" in text:
                found[i] += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
            low = text.lower()
            if any(word in low for word in KEYWORDS):
                found[i] += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= VALUE_LEAST]
            found[i].sort()
    return found


def in_code_points(text: bytes, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    if not found or text.isascii():
        return found
    return [(len(text[:start].decode("utf-8", "replace")), kind, len(text[:end].decode("utf-8", "replace"))) for start, kind, end in found]


def secrets(documents: DataFrame, column: str = "text", path: str | None = None) -> DataFrame:
    """Every row with ``secrets``: kind, start and end of each find, in code points, by start and then kind.

    The kinds ``assign``, ``access`` and ``hex`` follow fixed patterns, leftmost and without overlap within a kind. Kind
    ``random`` are strings of 20 characters or more without white space that the vocabulary at ``path`` covers with at
    most 2.2 characters a token, or parts of such strings between ``/``, ``_``, ``=`` and ``-``; digests of known lengths, UUIDs, numbers and plain words are excluded. A null or empty
    text has none; repeated rows are scanned one by one. A column named ``secrets`` is replaced.
    """
    kept = [c for c in documents.columns if c != "secrets"]
    path = path or vocabulary_path()

    def find(batches):
        tokens = encoding(path)
        for batch in batches:
            data, offsets = utf8(batch.column(column))
            values = [[{"kind": KINDS[kind], "start": start, "end": end} for start, kind, end in
                       in_code_points(data[offsets[i]:offsets[i + 1]].tobytes(), spans)]
                      if spans else [] for i, spans in enumerate(scan(data, offsets, tokens))]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(values, kind)], names=[*kept, "secrets"])

    schema = ", ".join([*(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in kept),
                        "secrets array<struct<kind:string,start:long,end:long>>"])
    return documents.select(*kept).mapInArrow(find, schema)


def redacted(documents: DataFrame, column: str = "text", mask: str = "[secret]", path: str | None = None) -> DataFrame:
    """The documents, with all their own columns, with ``mask`` in place of each run of overlapping finds; ``n_chars`` is corrected
    where there is one."""
    return beside(documents, ["secrets"], column, lambda docs, text: _masked(docs, text, mask, path))


def _masked(documents: DataFrame, column: str, mask: str, path: str | None) -> DataFrame:
    found = secrets(documents, column, path)
    spans = F.col("secrets")
    merged = F.aggregate(
        spans, F.expr("CAST(array() AS ARRAY<STRUCT<start:BIGINT,end:BIGINT>>)"),
        lambda acc, x: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["end"] > x["start"]),
                              F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                                  F.element_at(acc, -1)["start"].alias("start"),
                                  F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end")))))
        .otherwise(F.concat(acc, F.array(F.struct(x["start"].alias("start"), x["end"].alias("end"))))))
    done = F.aggregate(
        merged, F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda acc, x: F.struct(
            F.concat(acc["out"], F.substring(F.col(column), (acc["at"] + 1).cast("int"), (x["start"] - acc["at"]).cast("int")), F.lit(mask)).alias("out"),
            x["end"].alias("at")))
    text = F.when(F.size(spans) == 0, F.col(column)).otherwise(
        F.concat(done["out"], F.substring(F.col(column), (done["at"] + 1).cast("int"), F.lit(2147483647))))
    changed = found.withColumn(column, text)
    if "n_chars" in documents.columns:
        changed = changed.withColumn("n_chars", F.when(F.size(spans) == 0, F.col("n_chars")).otherwise(
            F.char_length(column).cast(documents.schema["n_chars"].dataType)))
    return changed


def _listed(spans) -> F.Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


@query("op8_secret_scan")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "secrets")
    count = lambda kind: F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("secrets", lambda x: x["kind"] != "random")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"), _listed(F.col("secrets")).alias("spans"))
