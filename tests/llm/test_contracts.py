"""Each operator's query against a brute-force version over a whole small table."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from check_queries import compare, connect
from hearthwatt.llm import decontamination, language, neardup, packing, quality, secrets, toxicity, warc

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def rows_of(sf_dir, name):
    return duckdb.sql(f"SELECT * FROM '{sf_dir}/{name}.parquet'").fetchall()


@pytest.fixture(scope="module")
def texts():
    return {r[0]: r[1] or "" for r in rows_of(MEDIUM, "documents")}


def roots(nodes, links):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def test_decontamination(spark):
    con = connect(MEDIUM)
    assert compare(decontamination.op1(spark, MEDIUM), con, decontamination.SQL) == ""
    assert decontamination.op1(spark, MEDIUM).where("contaminated").count() > 0


def test_language(spark):
    wrong = total = 0
    known = {r[0]: r[2] for r in rows_of(MEDIUM, "documents")}
    found = language.op2(spark, MEDIUM).collect()
    assert sorted(r.doc_id for r in found) == sorted(known)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
        if r.held_out:
            total += 1
            wrong += r.lang_pred != known[r.doc_id]
    assert wrong <= 0.03 * total


def test_packing(spark, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    by_document, by_sequence = defaultdict(list), defaultdict(list)
    for r in packing.op3(spark, MEDIUM).collect():
        by_document[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_document) == set(texts)
    for doc_id, text in texts.items():
        ids, at = [*tokenizer.encode(text, add_special_tokens=False).ids, 1], 0
        for r in sorted(by_document[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.length > 0
            at += r.length
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:at], "<u4").tobytes())
        assert at == len(ids)
    filled = []
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
        filled.append(at)
    assert sum(filled) >= 0.97 * 2048 * len(filled)


def test_quality(spark):
    label = {r[0]: r[1] for r in rows_of(MEDIUM, "labels")}
    held = [r for r in quality.op6(spark, MEDIUM).collect() if r.held_out and r.doc_id in label]
    assert sum(r.predicted == label[r.doc_id] for r in held) >= 0.9 * len(held)


def base_spans(text):
    found = []
    for i, (pattern, group, least) in enumerate((
            (r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
            (r"(AKIA[A-Z0-9]+)", 1, 20), (r"([0-9a-f]+)", 1, 24))):
        found += [(m.start(), i, m.end()) for m in re.finditer(pattern, text) if len(m[group]) >= least]
    return sorted(found)


def test_secrets(spark, texts):
    names, found = ("assign", "access", "hex"), 0
    for r in secrets.op8(spark, MEDIUM).collect():
        want = base_spans(texts[r.doc_id])
        listed = [f"{names[k]}:{a}:{b}" for a, k, b in want]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in want) for i in range(3)]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(r.spans.split(","))
        found += len(want)
    assert found > 20


def shingle_sets(texts, size):
    sets = {}
    for doc_id, text in texts.items():
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)) if w]
        sets[doc_id] = {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()
    return sets


def similar_pairs(sets):
    holders, common = defaultdict(list), defaultdict(int)
    for doc_id, members in sets.items():
        for s in members:
            holders[s].append(doc_id)
    for ids in holders.values():
        for i, a in enumerate(sorted(ids)):
            for b in sorted(ids)[i + 1:]:
                common[a, b] += 1
    return [(a, b) for (a, b), n in common.items() if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n)]


def test_near_duplicates(spark, texts):
    sets = shingle_sets(texts, 4)
    want = roots(sets, similar_pairs(sets))
    got = {r.doc_id: r for r in neardup.op9(spark, MEDIUM).collect()}
    assert {k: r.component_id for k, r in got.items()} == want
    assert {k: r.n_shingles for k, r in got.items()} == {k: len(s) for k, s in sets.items()}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_crowd_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BUCKET", 4)
    monkeypatch.setattr(neardup, "TILE", 16)
    rng, texts = np.random.default_rng(4), {}
    base = [f"w{i}" for i in range(120)]
    for doc_id in range(250):
        words = list(base)
        for place in rng.integers(0, 120, rng.integers(1, 8)):
            words[place] = f"x{rng.integers(40)}"
        texts[doc_id] = " ".join(words)
    sets = shingle_sets(texts, 4)
    want = roots(sets, similar_pairs(sets))
    found = neardup.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    same = sum(r.component_id == want[r.doc_id] for r in found)
    assert 2 < len(set(want.values())) < 200 and same >= 0.98 * len(texts)


def test_common_counts():
    rng = np.random.default_rng(2)
    sides = []
    for n in (150, 130):
        sets = [np.unique(rng.choice(500, rng.integers(0, 90)).astype(np.uint64)) for _ in range(n)]
        sets = [np.union1d(s, np.arange(1000, 1010, dtype=np.uint64)) if i % 7 else s for i, s in enumerate(sets)]
        sides.append((sets, np.concatenate(sets), np.concatenate(([0], np.cumsum([len(s) for s in sets])))))
    (a, xs, x_at), (b, ys, y_at) = sides
    want = [[len(np.intersect1d(x, y)) for y in b] for x in a]
    assert neardup.common_counts(xs, x_at, ys, y_at).tolist() == want


def test_warc(spark):
    assert compare(warc.op7(spark, MEDIUM), connect(MEDIUM), warc.SQL) == ""


def test_toxicity(spark):
    label = {r[0]: r[2] for r in rows_of(MEDIUM, "labels")}
    found = toxicity.op10(spark, MEDIUM).collect()
    held = [r for r in found if r.held_out and r.doc_id in label]
    assert sum(r.predicted == label[r.doc_id] for r in held) >= 0.9 * len(held)


def test_vectors(spark):
    from hearthwatt.llm import vectors

    rng, rows = np.random.default_rng(1), []
    for vec_id, values, *_ in rows_of(MEDIUM, "embeddings"):
        base = np.array(values)
        size = 60 if vec_id == 3 else 4
        noise = rng.normal(0, 0.02 * np.sqrt((base ** 2).sum() / len(base)) * 10, (size, len(base)))
        rows += [(len(rows) + i, [float(x) for x in np.float32(base + e)], 1) for i, e in enumerate(noise)]
    rows += [(len(rows) + i, rows[7][1], 2) for i in range(30)]
    ids = [r[0] for r in rows]
    unit = np.array([r[1] for r in rows], np.float64)
    unit /= np.sqrt((unit ** 2).sum(axis=1))[:, None]
    links = [(ids[i], ids[j]) for i, j in zip(*np.nonzero(np.triu(unit @ unit.T >= 0.95, 1)))]
    odd = [(-1, None, 0), (-2, [0.0] * 64, 0), (-3, [None] * 64, 0), (-4, [float("nan")] * 64, 0), (-5, [], 0), (-6, [1.0], 0), (None, rows[7][1], 0)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, n long")
    found = vectors.linked_vectors(table).collect()
    assert len(found) == len(rows) + len(odd)
    got = {r.vec_id: r for r in found}
    assert all((got[r[0]].n_links, got[r[0]].component_id, got[r[0]].kept) == (0, r[0], True) for r in odd)
    total, wanted = sum(r.n_links for r in got.values()), 2 * len(links)
    assert wanted > 3000 and 0.98 * wanted <= total <= wanted
    component = roots(ids, links)
    assert sum(got[i].component_id == component[i] for i in ids) >= 0.98 * len(ids)
    assert vectors.linked_vectors(table.limit(0)).count() == 0


def removed(texts):
    """Results by doc_id: (bytes, removed, spans, hash of what is kept)."""
    seen, out = set(), {}
    for doc_id in sorted(texts):
        text = texts[doc_id].encode()
        gone = bytearray(len(text))
        for p in range(len(text) - 99):
            s = text[p:p + 100]
            if s in seen:
                gone[p:p + 100] = b"\x01" * 100
            seen.add(s)
        spans = len(re.findall(rb"\x01+", gone))
        out[doc_id] = (len(text), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(text, gone) if not g)).hexdigest())
    return out


def test_repeats(spark, texts):
    from hearthwatt.llm import repeats

    want = removed(texts)
    assert sum(w[1] for w in want.values()) > 10_000
    for hot in (1024, 3):
        found = repeats.repeated_passages(spark.read.parquet(f"{MEDIUM}/documents.parquet"), hot_least=hot)
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found.collect()}
        assert got == want
