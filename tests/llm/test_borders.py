"""Pairs of very long documents at the border of similarity."""

from __future__ import annotations

import numpy as np
import pandas as pd

from hearthwatt.llm import neardup


def test_long_sets_just_below_the_border():
    same, union = 5_400_003, 6_750_004  # 100 * same is 20 below 80 * union, and single precision rounds it up to that

    def tiles(size):
        members = [np.arange(n, dtype=np.uint64).tobytes() for n in (size, same)]
        return neardup._tiles(80)(pd.DataFrame({"rep": [1, 2], "component": [1, 2], "members": members, "tile": [0, 1], "low": 0, "high": 1}))

    assert len(tiles(union)) == 0
    assert tiles(union - 1).values.tolist() == [[1, 2]]
