"""Stateful processors: events of a patient in time order, with a bounded state.

A micro-batch may hold years of one patient, in any order.  Its rows arrive chunk by chunk;
a single chunk is sorted at once, several are first laid down by day in the state store
and taken up again day by day.  So a processor sees a patient's new events in order,
while no more than a chunk, or a day, is in memory.  What it keeps between micro-batches is
an anchor, or a day and the watermark of readings.
"""

from __future__ import annotations

from collections import deque
from heapq import heappop, heappush
from itertools import chain
from typing import Any, Iterator

import numpy as np
import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from caseflow.functions import timegrid as tg
from caseflow.operators.features import HIGH, LOW, TINY

#: Rows handed on at once.
_ROWS = 20_000


class InOrder(StatefulProcessor):
    """Base of processors: sorted input, and one timer after which a quiet patient is forgotten."""

    state_columns = ""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._kept = handle.getValueState("kept", f"timer bigint, {self.state_columns}")
        self._spill = handle.getMapState("spill", "day bigint, part bigint", "t array<bigint>, v array<double>")

    def close(self) -> None:
        pass

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        self._kept.clear()
        return iter([])

    def _keep(self, old: tuple | None, state: tuple, quiet_us: int, timers: Any) -> None:
        """Store the state until ``quiet_us``, or the next watermark if that is past."""
        at = max(quiet_us // 1000, timers.getCurrentWatermarkInMs() + 1)
        if old is None or old[0] != at:
            if old is not None:
                self._handle.deleteTimer(old[0])
            self._handle.registerTimer(at)
        self._kept.update((at, *state))

    def in_order(self, rows: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Times and values of a micro-batch, sorted, a chunk or a day at a time."""
        chunks = (_arrays(r) for r in rows if len(r))
        first, second = next(chunks, None), next(chunks, None)
        if first is None:
            return
        if second is None:
            yield _sorted(*first)
            return
        parts: dict[int, int] = {}
        for t, v in chain([first, second], chunks):
            days = t // tg.DAY
            for day in np.unique(days).tolist():
                part = parts.get(day, 0)
                mine = days == day
                self._spill.updateValue((day, part), (t[mine].tolist(), v[mine].tolist()))
                parts[day] = part + 1
        for day in sorted(parts):
            lists = []
            for part in range(parts[day]):
                lists.append(self._spill.getValue((day, part)))
                self._spill.removeKey((day, part))
            yield _sorted(*(np.array([x for got in lists for x in got[k]], kind) for k, kind in ((0, "int64"), (1, "float64"))))


def _arrays(chunk: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    t = chunk["at_us"].to_numpy("int64")
    return t, chunk["reading"].to_numpy("float64") if "reading" in chunk else np.zeros(len(t))


def _sorted(t: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(t, kind="stable")
    return t[order], v[order]


class Anchors(InOrder):
    """Each event with its anchor; the state is the current anchor."""

    state_columns = "anchor bigint"

    def __init__(self, key: str, gap: int):
        self._key, self._gap = key, gap

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        old = self._kept.get()
        anchor, seen = old[1] if old else None, False
        for t, _ in self.in_order(rows):
            anchors, anchor = self._walk(t, anchor)
            seen = True
            yield pd.DataFrame({self._key: [key[0]] * len(t), "event_us": t, "anchor_us": anchors})
        if seen:
            self._keep(old, (anchor,), anchor + 2 * self._gap, timerValues)

    def _walk(self, t: np.ndarray, anchor: int | None) -> tuple[np.ndarray, int | None]:
        """Anchors of sorted times, one search per anchor; a time before the anchor is its own."""
        out, at = t.copy(), 0
        if anchor is not None:
            at = int(np.searchsorted(t, anchor + self._gap, side="right"))
            out[int(np.searchsorted(t, anchor)) : at] = anchor
        while at < len(t):
            anchor = int(t[at])
            end = int(np.searchsorted(t, anchor + self._gap, side="right"))
            out[at:end] = anchor
            at = end
        return out, anchor


class Values:
    """A multiset of readings that knows its smallest most frequent value.

    Each count has a heap of the values that reached it; entries whose value has another
    count by now are skipped when they come up, and swept when they are many.
    """

    def __init__(self):
        self.counts: dict[float, int] = {}
        self._at: dict[int, int] = {}
        self._heaps: dict[int, list[float]] = {}
        self._pushed = self.top = 0

    def _move(self, value: float, before: int, after: int) -> None:
        if before:
            self._at[before] -= 1
        if after:
            self.counts[value] = after
            self._at[after] = self._at.get(after, 0) + 1
            heappush(self._heaps.setdefault(after, []), value)
            self._pushed += 1
        else:
            del self.counts[value]
        self.top = max(self.top, after)
        while self.top and not self._at[self.top]:
            self.top -= 1
        if self._pushed > 4 * len(self.counts) + 1000:
            self._sweep()

    def _sweep(self) -> None:
        self._heaps, self._pushed = {}, len(self.counts)
        for value, n in sorted(self.counts.items()):
            self._heaps.setdefault(n, []).append(value)

    def add(self, value: float) -> None:
        n = self.counts.get(value, 0)
        self._move(value, n, n + 1)

    def remove(self, value: float) -> None:
        n = self.counts[value]
        self._move(value, n, n - 1)

    def mode(self) -> float | None:
        if not self.top:
            return None
        heap = self._heaps[self.top]
        while self.counts.get(heap[0]) != self.top:
            heappop(heap)
        return heap[0]


class Window:
    """What a window that moves with time holds: count, shares, and the values' multiset."""

    def __init__(self):
        self.rows: deque[tuple[int, float]] = deque()
        self.values = Values()
        self.zero = self.high = self.low = 0

    def _count(self, v: float, by: int) -> None:
        self.zero += by * (v == 0)
        self.high += by * (v >= HIGH)
        self.low += by * (v <= LOW)

    def add(self, t: int, v: float) -> None:
        self.rows.append((t, v))
        if v == v:
            self.values.add(v)
            self._count(v, 1)

    def drop_before(self, t: int) -> None:
        while self.rows and self.rows[0][0] < t:
            v = self.rows.popleft()[1]
            if v == v:
                self.values.remove(v)
                self._count(v, -1)

    def info(self) -> tuple:
        """Counts at the mode, of zeros, high and low readings, and of all; a mode below the least
        reported value is replaced by it before counting."""
        mode = self.values.mode()
        at_mode = self.values.top if mode is not None and mode >= TINY else self.values.counts.get(TINY, 0)
        return at_mode, self.zero, self.high, self.low, len(self.rows)


class SlidingInfo(InOrder):
    """Every new reading with what its window holds; the state is the readings that a later one,
    up to ``delay`` late, can still look back to."""

    state_columns = "t array<bigint>, v array<double>"

    def __init__(self, key: str, lo: int, hi: int, delay: int):
        self._key, self._lo, self._hi, self._delay = key, lo, hi, delay

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        old = self._kept.get()
        window, recent, waiting, out = Window(), deque(), deque(), []
        seen = False

        def look(upto: int | None) -> None:
            """Answer the waiting readings whose window ends by then."""
            while waiting and (upto is None or upto >= waiting[0] + self._hi):
                t = waiting.popleft()
                window.drop_before(t + self._lo)
                out.append((t, *window.info()))

        for t, v, is_new in self._merged(old, rows):
            look(t)
            window.add(t, v)
            recent.append((t, v))
            while recent[0][0] < t - self._delay + self._lo:
                recent.popleft()
            if is_new:
                waiting.append(t)
                seen = True
            if len(out) >= _ROWS:
                yield self._frame(key, out)
                out.clear()
        look(None)
        if out:
            yield self._frame(key, out)
        if seen:
            quiet = recent[-1][0] + self._delay - self._lo
            self._keep(old, ([t for t, _ in recent], [v for _, v in recent]), quiet, timerValues)

    def _merged(self, old: tuple | None, rows: Iterator[pd.DataFrame]) -> Iterator[tuple[int, float, bool]]:
        """Kept and new readings by time; at equal times the kept ones come first."""
        old_t, old_v = (np.array(x, kind) for x, kind in zip(old[1:] if old else ([], []), ("int64", "float64")))
        for t, v in self.in_order(rows):
            cut = int(np.searchsorted(old_t, t[-1], side="right")) if len(t) else 0
            both_t, both_v = np.concatenate([old_t[:cut], t]), np.concatenate([old_v[:cut], v])
            order = np.argsort(both_t, kind="stable")
            yield from zip(both_t[order].tolist(), both_v[order].tolist(), (order >= cut).tolist())
            old_t, old_v = old_t[cut:], old_v[cut:]
        yield from zip(old_t.tolist(), old_v.tolist(), [False] * len(old_t))

    def _frame(self, key: Any, out: list[tuple]) -> pd.DataFrame:
        t, at_mode, zero, high, low, n = (np.array(x) for x in zip(*out))
        share = lambda x: np.round(x / n, 6)
        return pd.DataFrame(
            {
                self._key: [key[0]] * len(out),
                "obs_us": t,
                "ModePercent": np.round(np.maximum(at_mode / n, TINY), 6),
                "ZeroPercent": share(zero),
                "Geq400Percent": share(high),
                "Leq20Percent": share(low),
                "RecNum": n,
            }
        )
