"""Timers over large batches of one site: pieces in order, against a plain sort, in bounded memory."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pandas as pd
import pytest

from hearthwatt.streaming import stateful

FIRST = 1_700_000_000_000_000


class Value:
    def __init__(self):
        self.row = None

    def exists(self):
        return self.row is not None

    def get(self):
        return self.row

    def update(self, row):
        self.row = row

    def clear(self):
        self.row = None


class Handle:
    def __init__(self):
        self.timers = set()

    def getValueState(self, name, schema):
        return Value()

    def listTimers(self):
        return set(self.timers)

    def deleteTimer(self, at):
        self.timers.discard(at)

    def registerTimer(self, at):
        self.timers.add(at)


def started(processor):
    processor.init(Handle())
    return processor


def frames(n, seed=1, each=10_000):
    rng = np.random.default_rng(seed)
    for at in range(0, n, each):
        us = FIRST + rng.integers(0, n // 3 + 1, min(each, n - at)) * 60_000_000
        kind = rng.integers(0, 900, len(us))
        text = [None if k > 890 else "ALLOW" if k > 800 else "PROHIBIT" if k > 760 else f"PROHIBIT_{k:02d}" for k in kind]
        yield pd.DataFrame({"us": us, "command": text})


def test_pieces_are_in_order():
    parts = [(np.array([5, 1, 5]), np.array([0, 1, 2], np.int32)), (np.array([], np.int64), np.array([], np.int32))]
    [(us, code)] = stateful.in_order(parts)
    assert us.tolist() == [1, 5, 5] and code.tolist() == [1, 0, 2]
    assert list(stateful.in_order([])) == []


@pytest.mark.parametrize("run, step", [(4, 1), (64, 8), (1 << 17, 1 << 12)])
def test_commands_like_a_plain_sort(monkeypatch, run, step):
    monkeypatch.setattr(stateful, "RUN", run)
    monkeypatch.setattr(stateful, "_STEP", step)
    rows = [r for f in frames(3000, each=50) for r in zip(f["us"], f["command"]) if r[1] and stateful.parse(r[1])]
    want, until, last = [], None, None
    for now, command in sorted(rows):
        mode, minutes = stateful.parse(command)
        if until is not None and until <= now:
            want.append((until, "ALLOW", "timeout"))
        want.append((now, mode, "command"))
        until, last = None if minutes is None else now + minutes * 60_000_000, now
    processor = started(stateful.AutoRevert())
    got = pd.concat(processor.handleInputRows(("s",), frames(3000, each=50), None))
    assert list(zip(got["us"], got["mode"], got["cause"])) == want
    assert processor.last.get() == (last,) and (processor.pending.get() or (None,)) == (until,)


def test_a_large_batch_is_held_in_pieces():
    """Before, all rows of a site and all of its output were Python objects at once."""
    for processor in (stateful.AutoRevert(), stateful.StaleAlerts(1)):
        tracemalloc.start()
        emitted = sum(map(len, started(processor).handleInputRows(("s",), frames(500_000), None)))
        peak = tracemalloc.get_traced_memory()[1] / 500_000
        tracemalloc.stop()
        assert emitted > 1_000 and peak < 100, f"{peak} bytes a row"


def test_a_missing_time_is_refused():
    for processor in (stateful.AutoRevert(), stateful.StaleAlerts(1)):
        rows = iter([pd.DataFrame({"us": [FIRST, None], "command": ["ALLOW", "PROHIBIT"]})])
        with pytest.raises(ValueError):
            list(started(processor).handleInputRows(("s",), rows, None))
