"""All queries of the subpackage with their SQL, as the entry point takes them."""

from __future__ import annotations

from hearthwatt.llm import (  # noqa: F401  (they register their queries)
    clusters, decontamination, language, licenses, negatives, neardup, packing, quality, repeats, secrets, toxicity, vectors, warc,
)
from hearthwatt.llm.registry import ORACLES, QUERIES  # noqa: F401
