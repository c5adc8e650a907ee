"""State machines of the keyed-state detectors.

This module imports nothing of the package: its classes travel to the workers by value, so the
package need not be installed there.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

CARD_ALERT = ("device_id string, transaction_id string, event_ms bigint, large_amount_vnd bigint, "
              "chain_len bigint, chain_start_ms bigint, evidence_id string")
TRAVEL_ALERT = ("user_id string, transaction_id string, event_ms bigint, prev_transaction_id string, "
                "km double, gap_ms bigint")
# Number of the one slice of a key that is not split.
WHOLE = -1


def _fields(ddl: str) -> list[tuple[str, str]]:
    return [(name, kind) for name, kind in (c.split() for c in ddl.split(", "))]


def _columns(rows: Iterator[pd.DataFrame], held: str) -> list[list]:
    """The held columns of one pool as plain lists, without the records that only move the watermark.

    One missing number makes a whole pandas column floating; the state wants integers back.
    """
    out: list[list] = [[] for _ in _fields(held)]
    for chunk in rows:
        chunk = chunk[chunk["transaction_id"].notna()]
        for column, (name, kind) in zip(out, _fields(held), strict=True):
            values = chunk[name].tolist()
            if kind == "bigint" and chunk[name].dtype.kind != "i":
                values = [None if x is None or x != x else int(x) for x in values]
            column += values
    return out


class Ordered(StatefulProcessor):
    """Holds rows until the watermark has passed them, then runs them by key, in the order of time and id.

    A row below the watermark is late and never gets here, so the order is final: a state machine sees the
    same sequence however its rows were spread over micro-batches.

    The grouping key is a pool of keys, because every access to the state store is a round trip: a call per
    key would cost more than its rows. One timer per pool stands at the next time something is due, the
    oldest held row or the end of what a key keeps. Timer, held rows (by column, so that none is
    wrapped by itself) and what the machines keep are one state variable.

    What belongs together is told by (key, slice). A key that carries much of the traffic is split into time
    slices of ``slice_ms``; the end of a slice is handed to the next one as ``carried`` rows, which set the
    scene there and alert nothing. All other keys are one slice, :data:`WHOLE`.
    """

    HELD = "key string, slice bigint, transaction_id string, ms bigint, carried boolean"
    KEPT = ""
    slice_ms = 0

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        held = ", ".join(f"{name} array<{kind}>" for name, kind in _fields(self.HELD))
        self.cell = handle.getValueState("cell", f"timer bigint, held struct<{held}>, kept array<struct<{self.KEPT}>>")

    def judge(self, rows: list[tuple], kept: list[tuple]) -> tuple[pd.DataFrame | None, list[tuple]]:
        """Run rows (key, slice, transaction_id, ms, ...), in order of time and id; alerts or nothing, and what to keep."""

    def ends(self, kept: list[tuple]) -> list[int]:
        """When each kept row is of no more use."""

    def _read(self) -> tuple[int | None, list[list], list[tuple]]:
        found = self.cell.get()
        if found is None:
            return None, [[] for _ in _fields(self.HELD)], []
        timer, held, kept = found
        return timer, [list(c) for c in held], [tuple(r) for r in kept]

    def _alive(self, kept: list[tuple], watermark: int) -> list[tuple[int, tuple]]:
        """Kept rows still of use, with the time their use ends."""
        ends = [end if r[1] == WHOLE else min(end, (r[1] + 1) * self.slice_ms)
                for r, end in zip(kept, self.ends(kept), strict=True)]
        return [(end, r) for end, r in zip(ends, kept, strict=True) if end >= watermark]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = _columns(rows, self.HELD)
        if new[0]:
            timer, held, kept = self._read()
            due = min(new[3]) + 1  # a timer fires as soon as the watermark reaches it
            if timer is None or due < timer:
                if timer is not None:
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(due)
                timer = due
            self.cell.update((timer, tuple(h + n for h, n in zip(held, new, strict=True)), kept))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        _, held, kept = self._read()
        ready, rest = [], []
        for row in zip(*held, strict=True):
            (ready if row[3] < watermark else rest).append(row)
        if ready:
            alerts, kept = self.judge(sorted(ready, key=lambda r: (r[3], r[2])), kept)
            if alerts is not None:
                yield alerts
        alive = self._alive(kept, watermark)
        due = [r[3] for r in rest] + [end for end, _ in alive]
        if due:
            self.handle.registerTimer(min(due) + 1)
            waiting = tuple(map(list, zip(*rest, strict=True))) if rest else tuple([] for _ in held)
            self.cell.update((min(due) + 1, waiting, [r for _, r in alive]))
        else:
            self.cell.clear()

    def close(self) -> None:
        pass


class CardTestingState(Ordered):
    """Streak of small failures per device. An alert emits one row per evidence transaction.

    ``anchored``: the streak counts from its first failure and starts anew two minutes after it. Otherwise
    it is what failed in a row in the last two minutes, which a slice can know from the rows carried into
    it.
    """

    HELD = Ordered.HELD + ", amount_vnd bigint, status string"
    KEPT = "key string, slice bigint, transaction_id string, ms bigint"

    def __init__(self, small_below_vnd: int, large_above_vnd: int, min_failures: int, within_ms: int,
                 anchored: bool = True, slice_ms: int = 0):
        self.small_below_vnd, self.large_above_vnd = small_below_vnd, large_above_vnd
        self.min_failures, self.within_ms = min_failures, within_ms
        self.anchored, self.slice_ms = anchored, slice_ms

    def judge(self, rows, kept):
        streaks, alerts = defaultdict(list), []
        for key, slice_, txn, ms in kept:
            streaks[key, slice_].append((txn, ms))
        for key, slice_, txn, ms, carried, amount, status in rows:
            streak = streaks[key, slice_]
            if streak and ms - streak[0][1] > self.within_ms:
                streak[:] = [] if self.anchored else [f for f in streak if ms - f[1] <= self.within_ms]
            if status == "FAILED" and amount is not None and amount < self.small_below_vnd:
                streak.append((txn, ms))
                continue
            if (status == "SUCCESS" and amount is not None and amount > self.large_above_vnd
                    and len(streak) >= self.min_failures and not carried):
                alerts += [(key, txn, ms, amount, len(streak), streak[0][1], e) for e, _ in streak]
            streak.clear()
        found = pd.DataFrame(alerts, columns=[name for name, _ in _fields(CARD_ALERT)]) if alerts else None
        return found, [(*of, *f) for of, streak in streaks.items() for f in streak]

    def ends(self, kept):
        # a streak ends as a whole, counted from its first failure or from its last
        deciding = {}
        for key, slice_, _, ms in kept:
            if not (self.anchored and (key, slice_) in deciding):
                deciding[key, slice_] = ms
        return [deciding[r[:2]] + self.within_ms for r in kept]


class TravelState(Ordered):
    """Last position per user, forgotten after a day without transactions."""

    HELD = Ordered.HELD + ", lat double, lon double"
    KEPT = "key string, slice bigint, transaction_id string, ms bigint, lat double, lon double"

    def __init__(self, min_km: float, max_gap_ms: int, ttl_ms: int, radius_km: float, slice_ms: int = 0):
        self.min_km, self.max_gap_ms, self.ttl_ms, self.radius_km = min_km, max_gap_ms, ttl_ms, radius_km
        self.slice_ms = slice_ms

    def judge(self, rows, kept):
        # the sort is stable: by key, what is kept before the rows, these in their order
        line = sorted([(*r[:4], True, *r[4:]) for r in kept] + rows, key=lambda r: (r[0] is None, r[0] or "", r[1]))
        key, slice_, txn, ms, carried, lat, lon = zip(*line, strict=True)
        key, slice_, txn = np.array(key, dtype=object), np.array(slice_), np.array(txn, dtype=object)
        ms, carried = np.array(ms), np.array(carried)
        phi, lam = np.radians(np.array(lat, dtype=float)), np.radians(np.array(lon, dtype=float))
        chord = (np.sin(np.diff(phi) / 2) ** 2
                 + np.cos(phi[:-1]) * np.cos(phi[1:]) * np.sin(np.diff(lam) / 2) ** 2)
        km = 2 * self.radius_km * np.arcsin(np.sqrt(np.minimum(chord, 1.0)))
        gap = np.diff(ms)
        same = (key[1:] == key[:-1]).astype(bool) & (slice_[1:] == slice_[:-1])
        last = [(*line[n][:4], *line[n][5:]) for n in np.flatnonzero(np.append(~same, True))]
        hit = same & (km > self.min_km) & (gap < self.max_gap_ms) & ~carried[1:]
        if not hit.any():
            return None, last
        return pd.DataFrame({
            "user_id": key[1:][hit], "transaction_id": txn[1:][hit], "event_ms": ms[1:][hit].astype("int64"),
            "prev_transaction_id": txn[:-1][hit], "km": km[hit], "gap_ms": gap[hit].astype("int64")}), last

    def ends(self, kept):
        return [r[3] + self.ttl_ms for r in kept]
