"""The prior of a language does not depend on the size of the sample."""

from __future__ import annotations

import numpy as np

from hearthwatt.llm import language


def test_prior_is_the_share_of_all_rows(spark):
    rows = [(i, "the house of the man", "en") for i in range(640)] + [(1000 + i, "la casa del hombre", "es") for i in range(100)]
    examples = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for sample in (20, 4000):
        model = language.fit(examples, "lang", sample=sample)
        assert model.labels == ["en", "es"] and np.allclose(model.prior, np.log([640 / 740, 100 / 740]))
