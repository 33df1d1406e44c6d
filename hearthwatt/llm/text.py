"""Texts of Arrow batches as numpy arrays: bounded slices, code points, words and their hashes."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes that are worked on at once; one longer text is a slice of its own.
SLICE_BYTES = 1 << 19

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offset of each; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)), offsets.astype(np.int64)


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold at most ``limit`` bytes together, one row at least."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts between the offsets, and the offset of each text among them."""
    part = data[offsets[0]:offsets[-1]]
    points = np.frombuffer(part.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    if len(points) == len(part):
        return points, offsets - offsets[0]
    seen = np.concatenate(([0], np.cumsum((part & 0xC0) != 0x80)))
    return points, seen[offsets - offsets[0]]


class Powers:
    """Powers of the odd base of the rolling hash and of its inverse, modulo 2**64; grown on demand."""

    def __init__(self, base: int = _BASE):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, base in (("up", self.base), ("down", self.inverse)):
                steps = np.full(max(n, 1 << 16), base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up[:n], self.down[:n]


POWERS = Powers()


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit values, so that all bits depend on all."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix_sums(values: np.ndarray, powers: Powers = POWERS) -> np.ndarray:
    """S with S[j] - S[i] = the polynomial of values[i:j], times base**i."""
    up, _ = powers.upto(len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    return sums


def spans_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers = POWERS) -> np.ndarray:
    """Mixed hash of values[start:end] for each span, from ``prefix_sums``."""
    _, down = powers.upto(len(sums))
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


#: A prime below 2**31: products of residues fit in 64 bits, and so do sums of as many residues as a text has bytes.
PRIME = (1 << 31) - 1


class Residues:
    """Powers of a base and of its inverse modulo PRIME, grown on demand."""

    def __init__(self, base: int = 1_000_003_579 % PRIME):
        self.bases = base, pow(base, -1, PRIME)
        self.tables = [np.ones(1, np.uint32), np.ones(1, np.uint32)]

    def upto(self, n: int) -> list[np.ndarray]:
        for k, base in enumerate(self.bases):
            while len(self.tables[k]) < n:
                old = self.tables[k]
                step = np.uint64(pow(base, len(old), PRIME))
                self.tables[k] = np.concatenate((old, (old * step % np.uint64(PRIME)).astype(np.uint32)))
        return [table[:n] for table in self.tables]


RESIDUES = Residues()


def spans_residue(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomials of values[start:end] modulo a prime. Words that make every polynomial modulo 2**64 alike differ here."""
    up, down = RESIDUES.upto(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    part = sums[1:]
    np.add(values, np.uint64(1), out=part)
    part *= up[:-1]
    part %= np.uint64(PRIME)
    np.cumsum(sums, out=sums)
    return (sums[ends] - sums[starts]) % np.uint64(PRIME) * down[starts] % np.uint64(PRIME)


def word_spans(is_word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of word characters, which end at text borders, and the first run of each text.

    ``offsets`` are relative to ``is_word``; the last returned array has one entry more than there are texts.
    """
    n = len(is_word)
    starts_at = np.zeros(n + 1, bool)
    ends_at = np.zeros(n + 1, bool)
    if n:
        starts_at[0], ends_at[n] = is_word[0], is_word[-1]
        starts_at[1:n] = is_word[1:] & ~is_word[:-1]
        ends_at[1:n] = is_word[:-1] & ~is_word[1:]
        inner = offsets[(offsets > 0) & (offsets < n)]
        cut = inner[is_word[inner] & is_word[inner - 1]]
        starts_at[cut] = ends_at[cut] = True
    starts, ends = np.flatnonzero(starts_at), np.flatnonzero(ends_at)
    return starts, ends, np.searchsorted(starts, offsets)


@functools.lru_cache(1)
def _letters() -> np.ndarray:
    """Lower-case code point of each letter, 0 for all other characters."""
    table = np.zeros(0x110000, np.uint32)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            low = char.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


def letter_grams(data: np.ndarray, offsets: np.ndarray, orders) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of all n-grams of lower-case letters and word borders, with the offset of each text among them, by order.

    A border stands before and after each word; whatever is no letter is part of a border.
    """
    points, places = code_points(data, offsets)
    low = _letters()[points]
    letter = low > 0
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    first = places[(places > 0) & (places < len(keep))]
    keep[first] &= letter[first]  # the border after a text's last word is not the next text's
    count = np.concatenate(([0], np.cumsum(keep)))
    low = np.insert(low[keep].astype(np.uint64), count[places][:-1], 0)
    places = count[places] + np.arange(len(places))
    text = np.repeat(np.arange(len(places) - 1), np.diff(places))
    for n in orders:
        m = len(low) - n + 1
        if m <= 0:
            yield np.empty(0, np.uint64), np.zeros(len(places), np.int64)
            continue
        code = np.full(m, n, np.uint64)
        for k in range(n):
            code = code * np.uint64(_BASE) + low[k:k + m]
        inside = text[:m] == text[n - 1:]
        if n == 1:
            inside &= low > 0
        at = np.concatenate(([0], np.cumsum(inside)))
        yield mixed(code[inside]), at[np.minimum(places, m)]


def sums_per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of values (one row each) over the ranges between offsets; empty ranges give zero."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), np.float64)
    np.cumsum(values, axis=0, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def byte_table(word: bytes, lower: bool = True) -> np.ndarray:
    """Lower-cased byte for each byte that ``word`` lists or that lies beyond ASCII, zero for others."""
    table = np.zeros(256, np.uint8)
    for b in range(256):
        low = b + 32 if lower and 65 <= b <= 90 else b
        if b >= 128 or low in word:
            table[b] = low
    return table
