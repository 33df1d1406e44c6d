"""Filling a span from the rows alone, against a plain loop: long gaps, rows off the grid, repeated and placeless rows."""

from __future__ import annotations

import io
import random
import re
from collections import Counter
from contextlib import redirect_stdout
from datetime import datetime, timedelta

import pytest

from hearthwatt.operators import grid

START = datetime(2026, 3, 27, 10, 7, 30)
SCHEMA = "zone string, ts timestamp_ntz, w double"


def plain(rows, step):
    """Slots from the first whole second of a zone to its last row; only a row at a slot gives its value."""
    out = []
    for zone in {r[0] for r in rows}:
        times = [r[1] for r in rows if r[0] == zone and r[1] is not None]
        if not times:
            continue
        at, held, source = min(times).replace(microsecond=0), None, None
        while at <= max(times):
            if at >= min(times):
                here = [r[2] for r in rows if r[:2] == (zone, at)] if zone is not None else []
                given = next((v for v in here if v is not None), None)
                held, source = (held, source) if given is None else (given, at)
                out += [(zone, at, held, held is not None and given is None, source)] * max(1, len(here))
            at += timedelta(seconds=step)
    return Counter(out)


@pytest.mark.parametrize("step", [60, 900, 86400, 7 * 86400])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_fills_like_a_plain_loop(spark, step, seed):
    rng, rows = random.Random(seed), []
    for zone, first in (("a", START), ("b", START + timedelta(microseconds=250)), (None, START), ("c", datetime(1969, 12, 30, 23, 59))):
        at = first
        for _ in range(60):
            value = rng.choice([None, round(rng.random(), 3)])
            off = rng.choice([timedelta()] * 3 + [timedelta(seconds=step / 3), timedelta(microseconds=1)])
            rows += [(zone, at + off, value)] * rng.choice([1, 1, 1, 2])
            at += step * timedelta(seconds=rng.choice([1, 1, 1, 2, 5, 96, 250]))
            if zone == "b" and len(rows) % 7 == 0:  # onto the whole seconds that zone b's grid has
                at = at.replace(microsecond=0)
        rows.append((zone, None, 7.0))
    rows += [("d", None, 1.0), ("e", START, None)]
    rng.shuffle(rows)
    got = grid.forward_fill(spark.createDataFrame(rows, SCHEMA), "w", step_seconds=step).collect()
    assert Counter(tuple(r) for r in got) == plain(rows, step)


def test_the_grid_is_not_shuffled(spark):
    """Before, every slot of the grid went through four shuffles; now slots are written after the last one."""
    days = [("a", START, 1.0), ("a", START + timedelta(days=2000), 2.0)]
    out = grid.forward_fill(spark.createDataFrame(days, SCHEMA), "w", step_seconds=86400)
    text = io.StringIO()
    with redirect_stdout(text):
        out.explain()
    at_depth = [(len(re.match(r"[\s:|+\-]*", line).group()), line) for line in text.getvalue().splitlines()]
    for i, (depth, line) in enumerate(at_depth):
        if "Exchange" in line:
            below = []
            for d, other in at_depth[i + 1:]:
                if d <= depth:
                    break
                below.append(other)
            assert not any("Generate explode" in other for other in below)
    assert out.count() == 2001
