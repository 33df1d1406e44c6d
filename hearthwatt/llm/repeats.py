"""Removal of repeated passages: suffixes are dealt to buckets by a cover sample and sorted one bucket at a time.

Every string of ``LENGTH`` bytes holds one cover position: the start of its ``GRAM`` bytes with the smallest hash. Equal
strings hold it at the same place, whatever surrounds them, as two suffixes meet in a difference cover; but a cover
chosen by content takes 3 positions in 100, a periodic one for strings of 100 bytes 11 at least.

1. The ``GRAM`` bytes at all cover positions are ranked, bucket by bucket, for the one thing that is asked of their
   order: whether they occur again. Where they do not, no suffix of the bucket can be repeated.
2. The suffixes around the other cover positions go, as short pieces of text, to the bucket of their cover rank. A
   bucket is sorted a slice at a time: long ties, pieces that agree as a whole, are settled by the rank of the piece;
   what is left is sorted by ``LENGTH`` bytes.

Ranks are 64-bit hashes; a bucket's number adds bits to them, and there are more buckets where there is more text.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from hearthwatt.llm.frames import stored, table
from hearthwatt.llm.registry import query
from hearthwatt.llm.text import mixed, prefix_sums, slices, spans_hash, utf8

LENGTH, GRAM = 100, 32
WINDOW = LENGTH - GRAM + 1
#: Text whose ranks a task merges before it sends them, and text per bucket.
UNIT_BYTES, BUCKET_BYTES = 16 << 20, 4 << 20
#: A cover string that occurs so often is dealt by its suffixes instead, so that no bucket has to hold them all.
HOT_LEAST, HOT_STRINGS = 1024, 1 << 20
#: Pieces that are sorted together at most, unless they share one cover string.
SLICE = 40_000

_ROWS = "place int, doc_id long, kind int, start long, end long, body binary"
_SCHEMA = pa.schema([("place", pa.int32()), ("doc_id", pa.int64()), ("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("body", pa.binary())])
#: Kinds of rows, in the order in which a document's rows are read.
TEXT, FOUND, DONE, ASK, HOT = 0, 1, 2, 3, 4


def _rows(place, doc_id, kind: int, start, end, body=None) -> pa.RecordBatch:
    n = len(doc_id)
    full = lambda x, t: pa.array(x, t) if x is not None and not np.isscalar(x) else pa.array(np.full(n, 0 if x is None else x), t)
    return pa.RecordBatch.from_arrays(
        [full(place, pa.int32()), full(doc_id, pa.int64()), full(kind, pa.int32()), full(start, pa.int64()), full(end, pa.int64()),
         pa.array(body, pa.binary()) if body is not None else pa.nulls(n, pa.binary())], schema=_SCHEMA)


def _packed(*arrays: np.ndarray) -> bytes:
    import zstandard

    head = np.array([len(arrays), *(len(a.view(np.uint8)) for a in arrays)], np.int64)
    return zstandard.ZstdCompressor(level=1).compress(head.tobytes() + b"".join(a.tobytes() for a in arrays))


def _unpacked(body: bytes) -> list[np.ndarray]:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8)
    n = int(raw[:8].view(np.int64)[0])
    ends = 8 * (n + 1) + np.cumsum(raw[8:8 * (n + 1)].view(np.int64))
    return [raw[end - size:end] for end, size in zip(ends, raw[8:8 * (n + 1)].view(np.int64))]


def _window_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive values, from running minima of blocks of that width, forwards and backwards."""
    n = len(values)
    blocks = np.concatenate((values, np.full(-n % width, np.iinfo(values.dtype).max, values.dtype))).reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n - width + 1], before[width - 1:n])


class Cover:
    """Cover positions of some texts: ``at`` and their hash ``rank``, with the range ``first`` to ``last`` of the strings
    that each belongs to. All places count from the first text's start."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.part, self.places = data[offsets[0]:offsets[-1]], offsets - offsets[0]
        self.sums = prefix_sums(self.part)
        self.at = self.first = self.last = np.empty(0, np.int64)
        self.rank, self.text = np.empty(0, np.uint64), self.at
        n = len(self.part)
        if n < LENGTH:
            return
        grams = np.arange(n - GRAM + 1)
        rank = spans_hash(self.sums, grams, grams + GRAM)
        bits = np.uint64(max(24, n.bit_length()))
        least = _window_least(rank >> bits << bits | grams.astype(np.uint64), WINDOW) & np.uint64((1 << int(bits)) - 1)
        string = np.flatnonzero(self._whole(n))
        at = least[string].astype(np.int64)
        text = np.searchsorted(self.places, string, side="right") - 1
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(at)) - 1 if len(at) else starts
        self.at, self.first, self.last, self.text = at[starts], string[starts], string[ends], text[starts]
        self.rank = rank[self.at]

    def piece(self) -> np.ndarray:
        """Rank of the whole piece of text whose strings belong to each cover position."""
        return mixed(spans_hash(self.sums, self.first, self.last + LENGTH) + (self.at - self.first).astype(np.uint64))

    def _whole(self, n: int) -> np.ndarray:
        """Whether the string that starts at a place lies within one text."""
        whole = np.ones(n - LENGTH + 1, bool)
        for end in self.places[1:]:
            whole[max(0, end - LENGTH + 1):end] = False
        return whole


def _places(rank: np.ndarray, buckets: int) -> np.ndarray:
    return ((rank >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _identity(rank: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and half a hash: what stands for a cover string in step 1."""
    return _places(rank, buckets) << 32 | (rank & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _ask_ranks(buckets: int):
    """Step 1, in the texts' order: each unit of text sends every cover string once, with how often it has it and, for
    one that it has once, the rank of its piece: if an earlier place has the same, all its strings are repeated."""
    def send(held):
        rank, doc, at, piece = (np.concatenate(x) for x in zip(*held))
        unique, first, place, count = np.unique(_identity(rank, buckets), return_index=True, return_inverse=True, return_counts=True)
        again = np.flatnonzero(count[place] > 1)
        yield _rows(None, doc[again], FOUND, at[again], 0)
        bucket, low = unique >> 32, (unique & 0xFFFFFFFF).astype(np.uint32)
        cuts = np.searchsorted(bucket, np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(cuts)):
            mine = np.arange(cuts[b], cuts[b + 1])
            mine = mine[np.argsort(first[mine])]
            docs = doc[first[mine]]
            yield _rows([b], [0], ASK, None, None, [_packed(
                low[mine], np.minimum(count[mine], 0xFFFFFFFF).astype(np.uint32), np.diff(docs, prepend=0), at[first[mine]].astype(np.uint32),
                (piece[first[mine]] & np.uint64(0xFFFFFFFF)).astype(np.uint32))])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            ids = batch.column(0).to_numpy()
            for a, b in slices(offsets):
                cover = Cover(data, offsets[a:b + 1])
                held.append((cover.rank, ids[a + cover.text], cover.at - cover.places[cover.text], cover.piece()))
                size += len(cover.part)
                if size >= UNIT_BYTES:
                    yield from send(held)
                    held, size = [], 0
        if held:
            yield from send(held)
    return run


def _streamed(batches, column: int) -> Iterator[pa.Table]:
    """The rows of sorted batches, cut only where the value of a column changes."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        value = batch.column(column).to_numpy()
        cut = int(np.searchsorted(value, value[-1], side="left"))
        if cut or (held and held[-1].column(column)[-1].as_py() != value[0]):
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def _by_place(answer):
    """Answers to the requests of each bucket; other rows pass through."""
    def run(batches):
        for rows in _streamed(batches, 0):
            kind, place = rows["kind"].to_numpy(), rows["place"].to_numpy()
            asking = kind == ASK
            yield from rows.filter(pa.array(~asking)).to_batches()
            asked = np.flatnonzero(asking)
            bodies = rows["body"].take(pa.array(asked)).to_pylist()
            cuts = np.flatnonzero(np.diff(place[asked])) + 1
            for own in np.split(np.arange(len(asked)), cuts):
                if len(own):
                    yield from answer(int(place[asked[own[0]]]), [bodies[i] for i in own])
    return run


def _answer_ranks(hot_least: int, place: int, bodies: list[bytes]):
    """The cover positions that occur elsewhere, with ``end`` 1 if an earlier place has the whole piece."""
    columns = [[a.view(t) for a, t in zip(_unpacked(body), (np.uint32, np.uint32, np.int64, np.uint32, np.uint32))] for body in bodies]
    low, count, doc, at, piece = (np.concatenate(x) for x in zip(*((a, b, np.cumsum(c), d, e) for a, b, c, d, e in columns)))
    unique, string = np.unique(low, return_inverse=True)
    total = np.bincount(string, count).astype(np.int64)
    again = np.flatnonzero((total[string] > 1) & (count == 1))
    again = again[np.lexsort((at[again], doc[again]))]
    late = _later(doc[again], at[again], low[again].astype(np.uint64) << np.uint64(32) | piece[again])
    yield _rows(None, doc[again], FOUND, at[again].astype(np.int64), late.astype(np.int64))
    hot = np.flatnonzero(total >= hot_least)
    yield _rows(None, np.zeros(len(hot), np.int64), HOT, place << 32 | unique[hot].astype(np.int64), total[hot])


def _later(doc: np.ndarray, at: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether the same key stands at an earlier place. Rows must be in the order of document and place."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    head = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    out = np.empty(len(key), bool)
    out[order] = (doc[head] != doc[order]) | (at[head] != at[order])
    return out


def _flat(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ..., for each start as many as its length says."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def _runs(doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, first and last of consecutive places."""
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1 if len(at) else first
    return doc[first], at[first], at[last]


def _found(doc: np.ndarray, first: np.ndarray, last: np.ndarray) -> pa.RecordBatch:
    return _rows(None, doc, FOUND, first, last + LENGTH)


def _ask_suffixes(buckets: int, hot):
    """Step 2, over the rows of each document (its text, then its cover positions that occur elsewhere, in order)."""
    def send(held):
        """Requests of a unit; pieces that it holds before are settled here."""
        doc, first, last, at, rank, piece, start, frequent, keys, data = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((first, doc))
        late = np.zeros(len(doc), bool)
        late[order] = _later(doc[order], first[order], piece[order])
        yield _found(doc[late], first[late], last[late])
        if len(keys):
            row = np.flatnonzero(frequent)
            strings = (last - first + 1)[row]
            own, place = np.repeat(doc[row], strings), _flat(first[row], strings)
            new = np.repeat(~late[row], strings)
            own, place, keys = own[new], place[new], keys[new]
            order = np.lexsort((place, own))
            own, place, keys = own[order], place[order], keys[order]
            again = _later(own, place, keys)
            yield _found(*_runs(own[again], place[again]))
            own, place, keys = own[~again], place[~again], keys[~again]
            bucket = (mixed(keys) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(cuts)):
                mine = order[cuts[b]:cuts[b + 1]]
                yield _rows([b], [0], ASK, None, None, [_packed(keys[mine], np.diff(own[mine], prepend=0), place[mine].astype(np.uint32))])
        keep = np.flatnonzero(~late & ~frequent)
        bucket = _places(rank[keep], buckets)
        order = keep[np.argsort(bucket, kind="stable")]
        cuts = np.searchsorted(np.sort(bucket), np.arange(buckets + 1))
        size = last - first + LENGTH
        for b in np.flatnonzero(np.diff(cuts)):
            mine = order[cuts[b]:cuts[b + 1]]
            yield _rows([b], [0], ASK, None, None, [_packed(
                np.diff(doc[mine], prepend=0), first[mine].astype(np.uint32), (last - first)[mine].astype(np.uint8),
                (at - first)[mine].astype(np.uint8), data[_flat(start[mine], size[mine])])])

    def run(batches):
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=1)
        held, size, base = [], 0, 0
        for rows in _streamed(batches, 0):
            kind = rows["kind"].to_numpy()
            ids = rows["doc_id"].to_numpy()
            places, settled, owners = (x[kind == FOUND] for x in (rows["start"].to_numpy(), rows["end"].to_numpy(), ids))
            texts = rows["body"].filter(pa.array(kind == TEXT)).combine_chunks()
            docs = ids[kind == TEXT]
            low, high = np.searchsorted(owners, docs, "left"), np.searchsorted(owners, docs, "right")
            data, offsets = utf8(texts)
            for a, b in slices(offsets):
                sure = [i for i in range(a, b) if low[i] == high[i]]
                if sure:
                    bodies = [data[offsets[i]:offsets[i + 1]].tobytes() for i in sure]
                    yield _rows(None, docs[sure], DONE, [len(x) for x in bodies], None, [hashlib.sha256(x).digest() for x in bodies])
                asked = [i for i in range(a, b) if low[i] < high[i]]
                if not asked:
                    continue
                yield _rows(None, docs[asked], TEXT, None, None, [squeeze.compress(data[offsets[i]:offsets[i + 1]].tobytes()) for i in asked])
                part = np.concatenate([data[offsets[i]:offsets[i + 1]] for i in asked])
                cover = Cover(part, np.concatenate(([0], np.cumsum([offsets[i + 1] - offsets[i] for i in asked]))))
                known = np.zeros(len(part) + 1, np.int8)
                for text, i in enumerate(asked):
                    at = cover.places[text] + places[low[i]:high[i]]
                    inside = at < cover.places[text + 1]
                    known[at[inside]] = 1 + settled[low[i]:high[i]][inside]
                use = np.flatnonzero(known[cover.at] == 2)
                new = np.ones(len(use) + 1, bool)  # strings of neighbours follow each other
                new[1:-1] = (cover.first[use[1:]] != cover.last[use[:-1]] + 1) | (cover.text[use[1:]] != cover.text[use[:-1]])
                head, tail = use[new[:-1]], use[new[1:]]
                start = cover.places[cover.text[head]]
                yield _found(docs[np.array(asked)][cover.text[head]], cover.first[head] - start, cover.last[tail] - start)
                use = np.flatnonzero(known[cover.at] == 1)
                first, last, own = cover.first[use], cover.last[use], cover.text[use]
                start = cover.places[own]
                piece = cover.piece()[use]

                frequent = np.isin(_identity(cover.rank[use], buckets), hot.value)
                string = _flat(first[frequent], (last - first + 1)[frequent])
                held.append((docs[np.array(asked)][own], first - start, last - start, cover.at[use] - start, cover.rank[use], piece,
                             first + base, frequent, spans_hash(cover.sums, string, string + LENGTH), part))
                size, base = size + len(part), base + len(part)
                if size >= UNIT_BYTES:
                    yield from send(held)
                    held, size, base = [], 0, 0
        if held:
            yield from send(held)
    return run


def _answer_suffixes(place: int, bodies: list[bytes]):
    parts = [_unpacked(body) for body in bodies]
    direct = [p for p in parts if len(p) == 3]
    if direct:
        key = np.concatenate([p[0].view(np.uint64) for p in direct])
        doc = np.concatenate([np.cumsum(p[1].view(np.int64)) for p in direct])
        at = np.concatenate([p[2].view(np.uint32) for p in direct]).astype(np.int64)
        order = np.lexsort((at, doc))
        key, doc, at = key[order], doc[order], at[order]
        late = _later(doc, at, key)
        yield _found(*_runs(doc[late], at[late]))
    pieces = [p for p in parts if len(p) == 5]
    if not pieces:
        return
    doc = np.concatenate([np.cumsum(p[0].view(np.int64)) for p in pieces])
    first = np.concatenate([p[1].view(np.uint32) for p in pieces]).astype(np.int64)
    more = np.concatenate([p[2] for p in pieces]).astype(np.int64)
    cover = np.concatenate([p[3] for p in pieces]).astype(np.int64)
    data = np.concatenate([p[4] for p in pieces])
    starts = np.cumsum(more + LENGTH) - (more + LENGTH)
    sums = prefix_sums(data)
    rank = spans_hash(sums, starts + cover, starts + cover + GRAM)
    order = np.lexsort((first, doc))
    whole = mixed(spans_hash(sums, starts, starts + more + LENGTH) + cover.astype(np.uint64))
    late = np.zeros(len(doc), bool)
    late[order] = _later(doc[order], first[order], whole[order])
    yield _found(doc[late], first[late], first[late] + more[late])
    rest = np.flatnonzero(~late)
    rest = rest[np.lexsort((first[rest], doc[rest], rank[rest]))]
    borders = np.append(np.flatnonzero(np.diff(rank[rest], prepend=~rank[rest[0]] if len(rest) else 0)), len(rest))
    a = 0
    while a < len(rest):
        b = int(borders[max(np.searchsorted(borders, a + SLICE, "right") - 1, np.searchsorted(borders, a, "right"))])
        some = rest[a:b]
        some = some[np.lexsort((first[some], doc[some]))]
        strings = more[some] + 1
        at = _flat(starts[some], strings)
        own, where = np.repeat(doc[some], strings), _flat(first[some], strings)
        again = _later(own, where, spans_hash(sums, at, at + LENGTH))
        yield _found(*_runs(own[again], where[again]))
        a = b


def _removed(batches):
    """Results, from the rows of each document: its text and the ranges to remove, or its result."""
    import zstandard

    expand = zstandard.ZstdDecompressor()
    for rows in _streamed(batches, 0):
        kind, ids = rows["kind"].to_numpy(), rows["doc_id"].to_numpy()
        start, end, body = rows["start"].to_numpy(), rows["end"].to_numpy(), rows["body"]
        found = kind == FOUND
        owners, starts, ends = ids[found], start[found], end[found]
        out = [(int(ids[i]), int(start[i]), 0, 0, body[int(i)].as_py().hex(), []) for i in np.flatnonzero(kind == DONE)]
        for i in np.flatnonzero(kind == TEXT):
            text = expand.decompress(body[int(i)].as_py())
            low, high = np.searchsorted(owners, ids[i], "left"), np.searchsorted(owners, ids[i], "right")
            spans: list[list[int]] = []
            for a, b in sorted(zip(starts[low:high].tolist(), np.minimum(ends[low:high], len(text)).tolist())):
                if spans and a <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], b)
                elif a < b:
                    spans.append([a, b])
            kept, at = [], 0
            for a, b in spans:
                kept.append(text[at:a])
                at = b
            kept.append(text[at:])
            out.append((int(ids[i]), len(text), sum(b - a for a, b in spans), len(spans), hashlib.sha256(b"".join(kept)).hexdigest(), spans))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64()))))],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])


def repeated_passages(documents: DataFrame, column: str = "text", key: str = "doc_id", hot_least: int = HOT_LEAST) -> DataFrame:
    """One row per row of ``documents``: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and ``spans``, the removed
    ranges of bytes.

    A byte of the UTF-8 text goes if a string of 100 bytes covers it that also starts earlier: in a document of smaller
    id, or further to the front. Matches end with their document; a null text is empty. Rows that repeat an id and its
    text are one document, and each gets its result; an id is expected to name one text. A row without id is left
    as it is and removes nothing. No rows: no results. Other columns are not read.
    """
    spark = documents.sparkSession
    chosen = documents.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(column), F.lit("")).alias("text"))
    named = chosen.where("doc_id IS NOT NULL")
    total = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // (64 << 20)))
    spread = F.when(F.col("kind") == ASK, F.col("place")).otherwise(F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets))).cast("int")
    asked = named.mapInArrow(_ask_ranks(buckets), _ROWS).withColumn("place", spread)
    ranked = stored(asked.repartition(parts, "place").sortWithinPartitions("place").mapInArrow(_by_place(functools.partial(_answer_ranks, hot_least)), _ROWS)
                    .select("doc_id", "kind", "start", "end"), "ranks")
    least = max(hot_least, total // HOT_STRINGS)
    hot = ranked.where((F.col("kind") == HOT) & (F.col("end") >= least)).select("start").toPandas()["start"].to_numpy()
    rows = named.select("doc_id", F.lit(TEXT).alias("kind"), F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end"),
                        F.col("text").cast("binary").alias("body")) \
        .union(ranked.where(F.col("kind") == FOUND).select("doc_id", "kind", "start", "end", F.lit(None).cast("binary")))
    asked = rows.repartition(parts, "doc_id").sortWithinPartitions("doc_id", "kind") \
        .mapInArrow(_ask_suffixes(buckets, spark.sparkContext.broadcast(hot)), _ROWS)
    answered = asked.withColumn("place", spread).repartition(parts, "place").sortWithinPartitions("place") \
        .mapInArrow(_by_place(_answer_suffixes), _ROWS).drop("place")
    done = answered.repartition(parts, "doc_id").sortWithinPartitions("doc_id", "kind").mapInArrow(
        _removed, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>")
    lone = chosen.where("doc_id IS NULL").select(
        "doc_id", F.octet_length("text").cast("long"), F.lit(0).cast("long"), F.lit(0).cast("long"), F.sha2(F.col("text").cast("binary"), 256),
        F.expr("CAST(array() AS ARRAY<ARRAY<BIGINT>>)"))
    return done.union(lone)


SQL = """
WITH doc AS MATERIALIZED (SELECT row_number() OVER (ORDER BY doc_id) AS d, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
place AS MATERIALIZED (SELECT d, i, substr(h, 2 * i + 1, 200) AS s FROM (SELECT d, h, unnest(range(0, len(h) // 2 - 99)) AS i FROM doc WHERE len(h) >= 200)),
again AS (SELECT d, i FROM (SELECT d, i, row_number() OVER (PARTITION BY s ORDER BY d, i) AS nth FROM place) WHERE nth > 1),
step AS (SELECT d, i, CASE WHEN lag(i) OVER w >= i - 100 THEN 0 ELSE 1 END AS fresh FROM again WINDOW w AS (PARTITION BY d ORDER BY i)),
span AS (SELECT d, min(i) AS first, max(i) + 100 AS last FROM (SELECT d, i, sum(fresh) OVER (PARTITION BY d ORDER BY i) AS k FROM step) GROUP BY d, k),
kept AS (SELECT d, coalesce(lag(last) OVER w, 0) AS a, first AS b FROM span WINDOW w AS (PARTITION BY d ORDER BY first)
         UNION ALL SELECT d, coalesce(max(last), 0), max(len(h) // 2) FROM doc LEFT JOIN span USING (d) GROUP BY d),
rest AS (SELECT d, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS h FROM kept JOIN doc USING (d) GROUP BY d),
total AS (SELECT d, sum(last - first) AS n, count(*) AS spans FROM span GROUP BY d)
SELECT doc_id, len(doc.h) // 2 AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(rest.h)) AS kept_sha256
FROM doc JOIN rest USING (d) LEFT JOIN total USING (d)
"""


@query("op4_repeated_passages", SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents")).drop("spans")
