"""Per-site timers. The state of a site is one pending time, whatever the number of its rows.

Times enter and leave as microseconds since 1970, so the session zone plays no part; only timers are rounded up to milliseconds.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

COMMAND = re.compile(r"^(ALLOW|PROHIBIT)(?:_(\d+))?$")
MAX_MINUTES = 720


def parse(command: str) -> tuple[str, int | None] | None:
    """Mode and minutes of a command, or None if it is not valid."""
    found = COMMAND.match(command or "")
    if found is None:
        return None
    mode, digits = found.group(1), found.group(2)
    if digits is None:
        return mode, None
    minutes = int(digits)
    return ("PROHIBIT", minutes) if mode == "PROHIBIT" and 1 <= minutes <= MAX_MINUTES else None


DAY_MICROS = 86_400_000_000


def _millis(micros: int) -> int:
    """The first millisecond at or after a time; timers know no finer ones."""
    return -(-micros // 1000)


#: Rows that are sorted and handed on together; beyond them a row of a batch is held as 12 bytes.
RUN = 1 << 17
_STEP = 1 << 12


def in_order(parts: Iterable[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Times and codes of the rows of a site, by time, in pieces of about ``RUN`` rows; rows of one time are in one piece."""
    runs: list[tuple[np.ndarray, np.ndarray]] = []
    some: list[tuple[np.ndarray, np.ndarray]] = []

    def joined(pieces: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        us, code = (np.concatenate(column) for column in zip(*pieces))
        order = np.argsort(us, kind="stable")
        return us[order], code[order]

    for part in parts:
        some.append(part)
        if sum(len(us) for us, _ in some) >= RUN:
            runs.append(joined(some))
            some = []
    if some:
        runs.append(joined(some))
    if not runs:
        return
    marks = np.sort(np.concatenate([us[::_STEP] for us, _ in runs]))
    begin = [0] * len(runs)
    for cut in [*np.unique(marks[RUN // _STEP::RUN // _STEP]), None]:
        end = [len(us) if cut is None else int(np.searchsorted(us, cut)) for us, _ in runs]
        yield joined([(us[a:b], code[a:b]) for (us, code), a, b in zip(runs, begin, end)])
        begin = end


def _times(batch: pd.DataFrame) -> np.ndarray:
    return batch["us"].astype("int64").to_numpy()  # refuses a missing time


class AutoRevert(StatefulProcessor):
    """Emits each command and, when a timed prohibition runs out first, the return to ALLOW.

    A site may start with the state that a batch of older commands has left: the time of its newest command, and when that runs
    out if it does so later on. The state of a site that has been silent for ``forget_days`` is dropped.
    """

    def __init__(self, forget_days: int = 400) -> None:
        self.keep = forget_days * DAY_MICROS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getValueState("pending", "until bigint")
        self.last = handle.getValueState("last", "at bigint")

    def _set(self, until: int | None, last: int | None) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if until is None:
            self.pending.clear()
        else:
            self.pending.update((until,))
            self.handle.registerTimer(_millis(until))
        if last is not None:
            self.last.update((last,))
            self.handle.registerTimer(_millis(last + self.keep))

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        row = initialState.iloc[0]
        self._set(None if pd.isna(row["until"]) else int(row["until"]), int(row["us"]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        until = self.pending.get()[0] if self.pending.exists() else None
        last = self.last.get()[0] if self.last.exists() else None
        known: dict[str, int] = {}
        parsed: list[tuple[str, int | None]] = []

        def code(command: str) -> int:
            if command not in known:
                found = parse(command)
                if found is None:
                    return -1
                known[command] = len(parsed)
                parsed.append(found)
            return known[command]

        def valid() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for batch in rows:
                batch = batch[batch["command"].notna()]
                codes = np.fromiter(map(code, batch["command"]), np.int32, len(batch))
                yield _times(batch[codes >= 0]), codes[codes >= 0]

        columns = ["site_id", "us", "mode", "cause"]
        for times, codes in in_order(valid()):
            out = []
            rank = np.argsort(np.argsort(list(known)))  # of one time, by text
            order = np.lexsort((rank[codes], times)) if len(codes) else codes
            for now, (mode, minutes) in zip(times[order].tolist(), map(parsed.__getitem__, codes[order].tolist())):
                if last is not None and now < last:  # late: a newer command is in force already
                    out.append((key[0], now, mode, "command"))
                    continue
                last = now
                if until is not None and until <= now:
                    out.append((key[0], until, "ALLOW", "timeout"))
                until = now + minutes * 60_000_000 if minutes is not None else None
                out.append((key[0], now, mode, "command"))
            yield pd.DataFrame(out, columns=columns)
        self._set(until, last)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at, out = expiredTimerInfo.getExpiryTimeInMs(), []
        until = self.pending.get()[0] if self.pending.exists() else None
        if until is not None and _millis(until) == at:
            self.pending.clear()
            out.append((key[0], until, "ALLOW", "timeout"))
        if self.last.exists() and _millis(self.last.get()[0] + self.keep) == at:
            self.last.clear()
        yield pd.DataFrame(out, columns=["site_id", "us", "mode", "cause"])

    def close(self) -> None:
        pass


class StaleAlerts(StatefulProcessor):
    """Emits a row when a site stays silent longer than allowed."""

    def __init__(self, minutes: int) -> None:
        self.limit = timedelta(minutes=minutes) // timedelta(microseconds=1)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "at bigint, alerted boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last, alerted = self.seen.get() if self.seen.exists() else (None, False)
        for times, _ in in_order((us, np.zeros(len(us), np.int32)) for us in map(_times, rows)):
            out = []
            for at in times.tolist():
                if last is not None and at - last > self.limit and not alerted:
                    out.append((key[0], last + self.limit, last))
                if last is None or at > last:
                    last, alerted = at, False
            yield pd.DataFrame(out, columns=["site_id", "us", "since_us"])
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.seen.update((last, alerted))
        if not alerted:
            self.handle.registerTimer(_millis(last + self.limit))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        columns = ["site_id", "us", "since_us"]
        last, alerted = self.seen.get() if self.seen.exists() else (None, True)
        due = last is not None and not alerted and _millis(last + self.limit) == expiredTimerInfo.getExpiryTimeInMs()
        if due:
            self.seen.update((last, True))
            yield pd.DataFrame([(key[0], last + self.limit, last)], columns=columns)
        else:
            yield pd.DataFrame(columns=columns)

    def close(self) -> None:
        pass
