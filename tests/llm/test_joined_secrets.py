"""Random strings that are joined to words, and what must not be taken for one."""

from __future__ import annotations

import random
import string

from hearthwatt.llm import secrets


def test_joined_secrets(spark):
    tokens, word = secrets.encoding(secrets.vocabulary_path()), random.Random(3)
    values = ["".join(word.choice(string.ascii_letters + string.digits) for _ in range(24)) for _ in range(500)]
    values = [v for v in values if secrets.is_random(v.encode(), tokens)]
    assert len(values) > 450
    before, after = "see service/account/credentials/production/", "/static-images_products now"
    rows = [(i, before + v + after) for i, v in enumerate(values)]
    pair = [v[:13] + "/" + v[13:] for v in values]  # the string holds a separator itself
    rows += [(1000 + i, before + v + after) for i, v in enumerate(pair)]
    for form in ("123e4567-e89b-12d3-a456-426614174000", "d41d8cd98f00b204e9800998ecf8427e", "2024-01-15-10-30-00-0000000", "release_20240115"):
        rows.append((3000 + len(rows), before + form + after))
    found = secrets.secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    spans = {r.doc_id: [(s.start, s.end) for s in r.secrets if s.kind == "random"] for r in found}
    at = len(before)
    # A few runs are random as a whole; the others give the part alone.
    assert all(len(spans[i]) == 1 and spans[i][0][0] <= at and spans[i][0][1] >= at + 24 for i in range(len(values)))
    assert sum(spans[i] == [(at, at + 24)] for i in range(len(values))) > 400
    assert sum(len(spans[1000 + i]) == 1 and spans[1000 + i][0][1] >= at + 25 for i in range(len(pair))) >= 0.95 * len(pair)
    assert all(not s for i, s in spans.items() if i >= 3000)
