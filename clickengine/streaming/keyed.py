"""More stateful processors: event-time OVER frames, cumulating windows, count
windows, changelogs, live rules and history joins on streams.

Rows whose order is event time wait in ``TimeBuckets`` until the watermark has
passed them, whatever their order of arrival; the other processors follow the
arrival sequence inside a micro-batch, like ``processors``.  Whole numbers
come in as strings, so that a null among them doesn't turn them into floats.
``streaming.forms`` wraps each of them with the columns of its batch form.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from clickengine.streaming.processors import FRAME_ROWS, TimeBuckets, _sorted, _us


def _key(key) -> str | None:
    return None if key[0] is None or key[0] != key[0] else str(key[0])


def _ints(column) -> list[int | None]:
    return [None if v is None or v != v else int(v) for v in column]


def _frames(rows: Iterator[tuple], columns: list[str], types: dict | None = None) -> Iterator[pd.DataFrame]:
    """Rows as frames of at most ``FRAME_ROWS``; a column of ``types`` may hold nulls among whole numbers."""
    def frame(part):
        return pd.DataFrame(part, columns=columns, dtype=object).astype(types or {})

    part = []
    for r in rows:
        part.append(r)
        if len(part) == FRAME_ROWS:
            yield frame(part)
            part = []
    yield frame(part)


class _Processor(StatefulProcessor):
    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        return iter([])

    def close(self) -> None:
        pass


# ------------------------------------------------------------------ WN13

class OverRowsAvg(_Processor):
    """``AVG(value) OVER (PARTITION BY key ORDER BY ts, seq ROWS BETWEEN p PRECEDING AND
    CURRENT ROW)`` with whole-number division (WN13).  A row is emitted once the watermark has
    passed it; the last p values of the key stay as a ring.  Nulls don't count.
    Input: ts, seq, value (string); output: ``key, seq, avg``."""

    OUTPUT = "key string, seq long, avg long"

    def __init__(self, ts: str, seq: str, value: str, preceding: int, width_ms: int = 3_600_000):
        self.ts, self.seq, self.value, self.p, self.width = ts, seq, value, preceding, width_ms

    def init(self, handle) -> None:
        self.kept = TimeBuckets(handle, "kept", "long", self.width)
        self.ring = handle.getListState("ring", "value long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows, [self.ts, self.seq], key)
        if len(pdf):
            self.kept.add(list(zip(_us(pdf[self.ts]), pdf[self.seq], _ints(pdf[self.value]))))
        yield from self._release(key, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._release(key, timerValues)

    def _release(self, key, timerValues) -> Iterator[pd.DataFrame]:
        ready = self.kept.release(timerValues.getCurrentWatermarkInMs())
        if not ready:
            return
        before = [r[0] for r in self.ring.get()] if self.ring.exists() else []
        values = before + [v for _, _, v in ready]

        def frames():
            total = sum(v for v in before if v is not None)
            n = sum(v is not None for v in before)
            for i, (_, seq, v) in enumerate(ready, len(before)):
                if v is not None:
                    total, n = total + v, n + 1
                out = i - self.p - 1
                if out >= 0 and values[out] is not None:
                    total, n = total - values[out], n - 1
                # truncating, as the batch form
                yield _key(key), int(seq), None if not n else (total // n if total >= 0 else -(-total // n))

        yield from _frames(frames(), ["key", "seq", "avg"], {"avg": "Int64"})
        if self.p:
            self.ring.put([(v,) for v in values[-self.p:]])


# ------------------------------------------------------------------ WN12

class CumulateCounts(_Processor):
    """Cumulating windows over pane counts (WN12).  Each row of the input is one pane of one
    step, [pane, pane + step), with its count; it feeds every later end of its base window
    [base, base + max).  A window is emitted once, when the watermark passes its end.  The state holds
    the panes of the open bases, and per base the last end emitted.
    Input: ``pane_us, n`` and a watermarked time; output: ``key, base_ms, end_ms, cnt``."""

    OUTPUT = "key string, base_ms long, end_ms long, cnt long"

    def __init__(self, step_ms: int, max_ms: int):
        self.step, self.max = step_ms, max_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.panes = handle.getMapState("panes", "pane long", "n long")
        self.done = handle.getMapState("done", "base long", "end long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            for us, n in zip(pdf["pane_us"], pdf["n"]):
                pane = int(us) // 1000
                old = self.panes.getValue((pane,))[0] if self.panes.containsKey((pane,)) else 0
                self.panes.updateValue((pane,), (old + int(n),))
                self.handle.registerTimer(pane + self.step)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        wm = timerValues.getCurrentWatermarkInMs()
        end = expiredTimerInfo.getExpiryTimeInMs()
        base = (end - 1) // self.max * self.max
        if self.done.containsKey((base,)):
            end = max(end, self.done.getValue((base,))[0] + self.step)
        panes = {p: n for (p,), (n,) in self.panes.iterator() if base <= p < base + self.max}
        out = []
        # a timer set here only fires in the next batch, so all ends passed by now are emitted at once
        while end <= min(wm, base + self.max) and panes:
            out.append((_key(key), base, end, sum(n for p, n in panes.items() if p < end)))
            end += self.step
        if end > base + self.max:
            for p in panes:
                self.panes.removeKey((p,))
            if self.done.containsKey((base,)):
                self.done.removeKey((base,))
        elif out:
            self.done.updateValue((base,), (out[-1][2],))
            self.handle.registerTimer(end)
        yield from _frames(iter(out), ["key", "base_ms", "end_ms", "cnt"])


# ------------------------------------------------------------------ WN5

class CountWindow(_Processor):
    """Count windows in arrival order (WN5): a window of the last ``size`` rows of the key every
    ``slide`` rows (tumbling without).  The state is a ring of partial results of
    gcd(size, slide) rows each, not of rows.
    Input: seq, value (string); output: ``key, end_rn, n_rows, first_seq, total, top``."""

    OUTPUT = "key string, end_rn long, n_rows long, first_seq long, total long, top long"

    def __init__(self, seq: str, value: str, size: int, slide: int | None):
        self.seq, self.value, self.size, self.every = seq, value, size, slide or size
        self.pane = math.gcd(size, self.every)

    def init(self, handle) -> None:
        self.rows = handle.getValueState("rows", "n long")
        self.ring = handle.getListState("ring", "first long, n long, total long, top long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows, [self.seq], key)
        if not len(pdf):
            return
        rn = self.rows.get()[0] if self.rows.exists() else 0
        ring = [tuple(r) for r in self.ring.get()] if self.ring.exists() else []
        out = []
        for seq, v in zip(pdf[self.seq], _ints(pdf[self.value])):
            if rn % self.pane == 0:
                ring.append((int(seq), 0, None, None))
                ring = ring[-(self.size // self.pane):]
            first, n, total, top = ring[-1]
            if v is not None:
                total, top = (total or 0) + v, v if top is None else max(top, v)
            ring[-1] = (first, n + 1, total, top)
            rn += 1
            if rn % self.every == 0:
                sums = [r[2] for r in ring if r[2] is not None]
                out.append((_key(key), rn, sum(r[1] for r in ring), ring[0][0], sum(sums) if sums else None,
                            max(r[3] for r in ring if r[3] is not None) if sums else None))
        self.rows.update((rn,))
        self.ring.put(ring)
        yield from _frames(iter(out), ["key", "end_rn", "n_rows", "first_seq", "total", "top"], {"total": "Int64", "top": "Int64"})


# ------------------------------------------------------------------ AG13, SK10

class ChangelogCount(_Processor):
    """Retractions of a running group count (AG13, SK10): the first row of a key inserts ``+I`` its
    count, every later one takes the old count back ``-U`` and puts the new one ``+U``.
    Output: ``key, seq, op, cnt, pos`` (``pos`` orders the two rows of one input row)."""

    OUTPUT = "key string, seq long, op string, cnt long, pos long"

    def __init__(self, seq: str):
        self.seq = seq

    def init(self, handle) -> None:
        self.count = handle.getValueState("count", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows, [self.seq], key)
        if not len(pdf):
            return
        n = self.count.get()[0] if self.count.exists() else 0
        name = _key(key)

        def changes():
            for i, seq in enumerate(pdf[self.seq], n):
                if i:
                    yield name, int(seq), "-U", i, 0
                    yield name, int(seq), "+U", i + 1, 1
                else:
                    yield name, int(seq), "+I", 1, 0

        yield from _frames(changes(), ["key", "seq", "op", "cnt", "pos"])
        self.count.update((n + len(pdf),))


# ------------------------------------------------------------------ JN6, ST13

class LiveRules(_Processor):
    """Rules that arrive while the query runs (JN6, ST13).  Keys are dealt into buckets, and every bucket
    gets every rule; a row matches if its key's previous and current action are those of the rule in
    force, the newest one with a smaller sequence number.  State: the rules, and the last action of
    each key.
    Input: ``bucket, kind ('row' or 'rule'), name, seq, action1, action2`` (a row's action is action1);
    output: ``name, seq, action1, action2``."""

    OUTPUT = "name string, seq long, action1 string, action2 string"

    def init(self, handle) -> None:
        self.rules = handle.getListState("rules", "seq long, action1 string, action2 string")
        self.last = handle.getMapState("last", "name string", "action string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows, ["seq"])
        is_rule = pdf["kind"] == "rule"
        new = [(int(s), _text(a), _text(b)) for s, a, b in zip(pdf["seq"][is_rule], pdf["action1"][is_rule], pdf["action2"][is_rule])]
        known = sorted([tuple(r) for r in self.rules.get()] + new if self.rules.exists() else new, key=lambda r: r[0])
        if new:
            self.rules.appendList(new)
        starts = [r[0] for r in known]
        last: dict[str, str | None] = {}
        out = []
        for name, seq, action in zip(pdf["name"][~is_rule], pdf["seq"][~is_rule], pdf["action1"][~is_rule]):
            slot = "null" if _text(name) is None else f"={name}"     # null keys are a key like any other
            if slot not in last:
                last[slot] = self.last.getValue((slot,))[0] if self.last.containsKey((slot,)) else None
            rule = bisect.bisect_left(starts, seq) - 1
            action = _text(action)
            if rule >= 0 and last[slot] is not None and (last[slot], action) == known[rule][1:]:
                out.append((_text(name), int(seq), last[slot], action))
            last[slot] = action
        for slot, action in last.items():
            self.last.updateValue((slot,), (action,))
        yield from _frames(iter(out), ["name", "seq", "action1", "action2"])


def _text(v) -> str | None:
    return None if v is None or v != v else str(v)


# ------------------------------------------------------------------ JN4

class HistoryJoin(_Processor):
    """Full-history join of two streams (JN4): every row of a key meets all rows of the other side, those
    before it and those after it.  Both sides are list states with a time to live (processing time),
    counted from a row's arrival.
    Input: ``side ('l' or 'r'), row`` (any text); output: ``l, r``."""

    OUTPUT = "l string, r string"

    def __init__(self, ttl_ms: int):
        self.ttl = ttl_ms

    def init(self, handle) -> None:
        self.kept = {s: handle.getListState(f"rows_{s}", "row string", self.ttl) for s in "lr"}

    def _old(self, side: str) -> Iterator[str]:
        return (r[0] for r in self.kept[side].get()) if self.kept[side].exists() else iter([])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = {"l": [], "r": []}
        for pdf in rows:
            for side, row in zip(pdf["side"], pdf["row"]):
                new[side].append(row)

        def pairs():
            if new["l"]:
                for b in self._old("r"):
                    yield from ((a, b) for a in new["l"])
            if new["r"]:
                for a in self._old("l"):
                    yield from ((a, b) for b in new["r"])
            yield from ((a, b) for a in new["l"] for b in new["r"])

        yield from _frames(pairs(), ["l", "r"])
        for side, part in new.items():
            if part:
                self.kept[side].appendList([(r,) for r in part])


# ------------------------------------------------------------------ ST12

class ExpiringValue:
    """Value state whose time to live starts anew with every read as well as every write, and whose expired value
    can be read once more (ST12).  The store's own TTL does neither, so the time of the last use is kept beside
    the value.  ``now`` is the processing time in milliseconds."""

    def __init__(self, handle, name: str, schema: str, ttl_ms: int):
        self.state, self.ttl = handle.getValueState(name, f"{schema}, used_ms long"), ttl_ms

    def get(self, now: int) -> tuple[tuple | None, bool]:
        """(value, expired): a live value is refreshed, an expired one is handed out and gone."""
        if not self.state.exists():
            return None, False
        *value, used = self.state.get()
        if now >= used + self.ttl:
            self.state.clear()
            return tuple(value), True
        self.update(tuple(value), now)
        return tuple(value), False

    def update(self, value: tuple, now: int) -> None:
        self.state.update((*value, now))


class ExpiringCount(_Processor):
    """A count per key that starts again once the key has been idle for ``ttl_ms`` (ST12); the batch that finds
    it expired reports what it was.  Run with ``time_mode="ProcessingTime"``.
    Output: ``key, cnt, expired`` (the expired count first)."""

    OUTPUT = "key string, cnt long, expired boolean"

    def __init__(self, ttl_ms: int):
        self.ttl = ttl_ms

    def init(self, handle) -> None:
        self.count = ExpiringValue(handle, "count", "n long", self.ttl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        new = sum(len(r) for r in rows)
        old, expired = self.count.get(now)
        n = new if old is None or expired else old[0] + new
        self.count.update((n,), now)
        out = [(_key(key), n, False)]
        yield from _frames(iter([(_key(key), old[0], True), *out] if expired else out), ["key", "cnt", "expired"])
