"""Stateful processors for ``groupBy(key).transformWithStateInPandas`` (ST4-ST12,
WN6, CE1-CE4, JN6).

Each processor keeps per-key state in Spark's state store (RocksDB provider,
checkpointed with the query) and registers event-time timers; Spark runs
one processor instance per partition and calls it per key, so the work is
distributed by key like any other keyed operator.  Rows of one key inside a
micro-batch are processed in a deterministic order (event time, then arrival
sequence), which makes the results equal to the batch closed forms for
in-order input.

Timer parity (SURVEY S2): the reference fires a timer at t once its
watermark (max - delay - 1 ms) reaches t, i.e. when max - delay > t; Spark
fires when its watermark (max - delay) >= the registered time.  Timers are
therefore registered at t + 1 ms and reported as t.

``run`` wires a processor: ``run(df, key, processor, schema)``.
"""

from __future__ import annotations

from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import (ExpiredTimerInfo, StatefulProcessor,
                                                      StatefulProcessorHandle, TimerValues)

from clickengine.streaming.replay import SENTINEL_ID, SENTINEL_KEY

#: Rows of one output frame: a processor that makes many yields them in parts.
FRAME_ROWS = 10_000


def run(df: DataFrame, key: str, processor: StatefulProcessor, schema: str,
        output_mode: str = "Append", time_mode: str = "EventTime") -> DataFrame:
    return df.groupBy(key).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode=output_mode, timeMode=time_mode)


def _sorted(rows: Iterator[pd.DataFrame], by: list[str], key=None) -> pd.DataFrame:
    """The key's rows of this micro-batch in processing order.  The end-of-input
    marker, known by its reserved key, carries no event; a row without an
    ordering value has no place in the order and is an error."""
    frames = [r for r in rows if len(r)]
    if not frames or (key is not None and str(key[0]) in (SENTINEL_KEY, str(SENTINEL_ID))):
        return pd.DataFrame()
    pdf = pd.concat(frames, ignore_index=True)
    if pdf[by].isna().any(axis=None):
        raise ValueError(f"a row of key {key} has no {' or '.join(by)}")
    return pdf.sort_values(by, kind="stable")


def _ms(series: pd.Series) -> pd.Series:
    """Timestamp series -> epoch milliseconds (int64)."""
    return (series.astype("datetime64[us]").astype("int64") // 1000) if series.dtype.kind == "M" else series


def _us(series: pd.Series) -> pd.Series:
    """Timestamp series -> epoch micro-seconds (int64)."""
    return series.astype("datetime64[us]").astype("int64") if series.dtype.kind == "M" else series * 1000


# ------------------------------------------------------------------ ST4

class EventTimers(StatefulProcessor):
    """On every row register a timer at ts + delay; emit one row on arrival
    and one when a timer fires (same key + time fires once).
    Input: key, ts (timestamp); output: ``key, kind, at_ms``."""

    OUTPUT = "key string, kind string, at_ms long"

    def __init__(self, key: str, ts: str, delay_ms: int):
        self.key, self.ts, self.delay = key, ts, delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows, [self.ts], key)
        ms = _ms(pdf[self.ts]) if len(pdf) else pd.Series([], dtype="int64")
        for t in ms:
            self.handle.registerTimer(int(t) + self.delay + 1)
        yield pd.DataFrame({"key": [str(key[0])] * len(ms), "kind": ["arrival"] * len(ms), "at_ms": ms.astype("int64")})

    def handleExpiredTimer(self, key, timerValues: TimerValues,
                           expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"key": [str(key[0])], "kind": ["fired"],
                            "at_ms": [expiredTimerInfo.getExpiryTimeInMs() - 1]})

    def close(self) -> None:
        pass


# ------------------------------------------------------------------ ST6

class PeriodicCount(StatefulProcessor):
    """From the key's first event t0, a timer every ``period`` reports the
    key's count of rows with time <= the tick (S5).  State: value state
    (t0, fired count, next tick index) and map state tick index -> rows.
    Output: ``key, tick_ms, cnt``."""

    OUTPUT = "key string, tick_ms long, cnt long"

    def __init__(self, ts: str, period_ms: int):
        self.ts, self.p = ts, period_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.meta = handle.getValueState("meta", "t0 long, total long")
        self.pending = handle.getMapState("pending", "k long", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows, [self.ts], key)
        if not len(pdf):
            return iter([])
        ms = _ms(pdf[self.ts])
        if self.meta.exists():
            t0, total = self.meta.get()
        else:
            t0, total = int(ms.iloc[0]), 0
            self.handle.registerTimer(t0 + self.p + 1)
        for k, n in (-(-(ms - t0) // self.p)).clip(lower=1).value_counts().items():
            k = int(k)
            cur = self.pending.getValue((k,))[0] if self.pending.containsKey((k,)) else 0
            self.pending.updateValue((k,), (cur + int(n),))
        self.meta.update((t0, total))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        t0, total = self.meta.get()
        wm = timerValues.getCurrentWatermarkInMs()
        tick = expiredTimerInfo.getExpiryTimeInMs() - 1
        pending = {pk: n for (pk,), (n,) in self.pending.iterator()}
        out = []
        # The re-armed timer would only fire in the next micro-batch: emit
        # every tick the watermark has already passed, in order, here.
        while True:
            k = (tick - t0) // self.p
            for pk in sorted(p for p in pending if p <= k):
                total += pending.pop(pk)
                self.pending.removeKey((pk,))
            out.append((str(key[0]), tick, total))
            tick += self.p
            if tick + 1 > wm:
                break
            if len(out) == FRAME_ROWS:
                yield pd.DataFrame(out, columns=["key", "tick_ms", "cnt"])
                out = []
        self.meta.update((t0, total))
        self.handle.registerTimer(tick + 1)
        yield pd.DataFrame(out, columns=["key", "tick_ms", "cnt"])

    def close(self) -> None:
        pass


# ------------------------------------------------------------------ WN6, ST11

class AvgEveryN(StatefulProcessor):
    """Every ``n`` rows of a key (arrival order) emit the average time, then
    reset (value state holding the (count, sum) accumulator).
    Output: ``key, batch_no, avg_ms``."""

    OUTPUT = "key string, batch_no long, avg_ms long"

    def __init__(self, seq: str, ts: str, n: int):
        self.seq, self.ts, self.n = seq, ts, n

    def init(self, handle) -> None:
        self.acc = handle.getValueState("acc", "cnt long, total long, batches long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows, [self.seq], key)
        cnt, total, batches = self.acc.get() if self.acc.exists() else (0, 0, 0)
        out = []
        for t in (_ms(pdf[self.ts]) if len(pdf) else []):
            cnt, total = cnt + 1, total + int(t)
            if cnt == self.n:
                out.append((str(key[0]), batches, total // self.n))
                cnt, total, batches = 0, 0, batches + 1
        self.acc.update((cnt, total, batches))
        yield pd.DataFrame(out, columns=["key", "batch_no", "avg_ms"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        return iter([])

    def close(self) -> None:
        pass


# ------------------------------------------------------------------ CE3

class FailStateMachine(StatefulProcessor):
    """Arrival-order state machine: a failure moves one state forward, any
    other type resets; alert on each failure completing ``n`` in a row.
    Output: ``key, seq``."""

    OUTPUT = "key string, seq long"

    def __init__(self, seq: str, event_type: str, fail: str, n: int = 3):
        self.seq, self.type, self.fail, self.n = seq, event_type, fail, n

    def init(self, handle) -> None:
        self.run_len = handle.getValueState("run", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows, [self.seq], key)
        run = self.run_len.get()[0] if self.run_len.exists() else 0
        out = []
        for s, t in zip(pdf.get(self.seq, []), pdf.get(self.type, [])):
            run = run + 1 if t == self.fail else 0
            if run >= self.n:
                out.append((str(key[0]), int(s)))
        self.run_len.update((run,))
        yield pd.DataFrame(out, columns=["key", "seq"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        return iter([])

    def close(self) -> None:
        pass


# ------------------------------------------------------------------ CE1, CE2, CE4

class TimeBuckets:
    """Rows (micro-seconds, sequence, value) of one key, kept until the watermark has passed them.
    They lie in map state by time bucket: adding a row rewrites its own bucket, releasing
    reads the buckets that the watermark has reached, and the rest stays untouched.  One timer stands
    at the earliest kept row."""

    def __init__(self, handle, name: str, kind: str, width_ms: int):
        self.handle, self.width = handle, width_ms * 1000
        self.rows = handle.getMapState(name, "bucket long", f"us array<long>, seq array<long>, value array<{kind}>")

    def _get(self, bucket: int) -> list[tuple]:
        return list(zip(*self.rows.getValue((bucket,)))) if self.rows.containsKey((bucket,)) else []

    def _put(self, bucket: int, rows: list[tuple]) -> None:
        self.rows.updateValue((bucket,), tuple([*c] for c in zip(*rows)))

    def add(self, new: list[tuple]) -> None:
        parts: dict[int, list[tuple]] = {}
        for us, seq, value in new:
            parts.setdefault(int(us) // self.width, []).append((int(us), int(seq), value))
        for bucket, rows in parts.items():
            self._put(bucket, self._get(bucket) + rows)

    def release(self, wm_ms: int) -> list[tuple]:
        """The rows before the watermark, in order; they leave the state."""
        buckets = sorted(b for (b,) in self.rows.keys())
        ready, wm = [], wm_ms * 1000
        for b in buckets:
            if b * self.width >= wm:
                self._wait(b)
                break
            rows = self._get(b)
            ready += [r for r in rows if r[0] < wm]
            rest = [r for r in rows if r[0] >= wm]
            if rest:
                if len(rest) < len(rows):
                    self._put(b, rest)
                self._wait(b)
                break
            self.rows.removeKey((b,))
        return sorted(ready, key=lambda r: r[:2])

    def _wait(self, bucket: int) -> None:
        self.handle.registerTimer(min(self.rows.getValue((bucket,))[0]) // 1000 + 1)


class _EventTimeOrder(StatefulProcessor):
    """Rows of a key are kept until the watermark has passed them, then handled in
    (event time, sequence) order, whatever the order of arrival."""

    def __init__(self, seq: str, ts: str, event_type: str, width_ms: int = 3_600_000):
        self.seq, self.ts, self.type, self.width = seq, ts, event_type, width_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.kept = TimeBuckets(handle, "kept", "string", self.width)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows, [self.ts, self.seq], key)
        if len(pdf):
            self.kept.add(list(zip(_us(pdf[self.ts]), pdf[self.seq], pdf[self.type])))
        yield from self._release(key, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._release(key, timerValues)

    def _release(self, key, timerValues) -> Iterator[pd.DataFrame]:
        wm = timerValues.getCurrentWatermarkInMs()
        ready = [(us // 1000, seq, value) for us, seq, value in self.kept.release(wm)]
        yield self._handle(str(key[0]), ready, wm)

    def _handle(self, key: str, ready: list, wm: int) -> pd.DataFrame:
        raise NotImplementedError

    def close(self) -> None:
        pass


class StrictSequence(_EventTimeOrder):
    """The key's last rows in event-time order have the types ``steps``, one
    after the other (CE1); the same type n times is CE2.  Matches overlap.
    Output: ``key, seq`` (of the last row), ``times_ms`` of the rows."""

    OUTPUT = "key string, seq long, times_ms array<long>"

    def __init__(self, seq: str, ts: str, event_type: str, steps: list[str]):
        super().__init__(seq, ts, event_type)
        self.steps = steps

    def init(self, handle) -> None:
        super().init(handle)
        self.last = handle.getListState("last", "ms long, seq long, type string")

    def _handle(self, key, ready, wm) -> pd.DataFrame:
        n = len(self.steps)
        before = [tuple(r) for r in self.last.get()] if self.last.exists() else []
        rows = before + ready
        out = []
        for end in range(max(len(before) + 1, n), len(rows) + 1):
            part = rows[end - n:end]
            if [r[2] for r in part] == self.steps:
                out.append((key, part[-1][1], [r[0] for r in part]))
        if ready and n > 1:
            self.last.clear()
            self.last.put(rows[-(n - 1):])
        return pd.DataFrame(out, columns=["key", "seq", "times_ms"])


class FollowedWithin(_EventTimeOrder):
    """``first`` followed by ``then`` within ``within_ms`` (relaxed, CE4) in
    event-time order: a ``then`` row matches every pending ``first`` row before
    it that is less than ``within`` older; a pending row times out when the
    watermark has passed its time.
    Output: ``key, seq, first_ms, then_ms, status``."""

    OUTPUT = "key string, seq long, first_ms long, then_ms long, status string"

    def __init__(self, seq: str, ts: str, event_type: str, first: str, then: str, within_ms: int):
        super().__init__(seq, ts, event_type)
        self.first, self.then, self.w = first, then, within_ms

    def init(self, handle) -> None:
        super().init(handle)
        self.pending = handle.getListState("pending", "ms long, seq long")

    def _handle(self, key, ready, wm) -> pd.DataFrame:
        pending = [tuple(r) for r in self.pending.get()] if self.pending.exists() else []
        out = []
        for t, seq, kind in ready:
            if kind == self.then:
                out += [(key, s, p, t, "matched") for p, s in pending if t - p < self.w]
                pending = [(p, s) for p, s in pending if t - p >= self.w]
            if kind == self.first:
                pending.append((t, seq))
        out += [(key, s, p, None, "timeout") for p, s in pending if p + self.w <= wm]
        pending = [(p, s) for p, s in pending if p + self.w > wm]
        self.pending.clear()
        if pending:
            self.pending.put(pending)
            self.handle.registerTimer(min(pending)[0] + self.w)
        return pd.DataFrame(out, columns=["key", "seq", "first_ms", "then_ms", "status"]).astype({"then_ms": "Int64"})


# ------------------------------------------------------------------ ST7-ST12

class KeyedStateSummary(StatefulProcessor):
    """The state kinds of the keyed-state program in one processor:
    value state (count, with TTL), list state (all urls, with TTL), map state
    (url -> count), a reducing state (first url, last time) and an
    aggregating state (sum, count -> average).  Emits the key's summary after
    every batch; each state is written once a batch and distinct url.  State
    TTL is processing-time based in Spark: run it with
    ``time_mode="ProcessingTime"``.
    Output: ``key, cnt, first_url, last_ms, avg_ms, n_urls, urls``."""

    OUTPUT = "key string, cnt long, first_url string, last_ms long, avg_ms long, n_urls long, urls array<string>"

    def __init__(self, seq: str, url: str, ts: str, ttl_ms: int | None = 3_600_000):
        self.seq, self.url, self.ts, self.ttl = seq, url, ts, ttl_ms

    def init(self, handle) -> None:
        self.count = handle.getValueState("count", "n long", self.ttl)
        self.visited = handle.getListState("visited", "url string", self.ttl)
        self.urls = handle.getMapState("urls", "url string", "n long")
        self.reduced = handle.getValueState("reduced", "first_url string, last_ms long")
        self.agg = handle.getValueState("agg", "total long, n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows, [self.seq], key)
        if not len(pdf):
            return
        times = _ms(pdf[self.ts])
        n = (self.count.get()[0] if self.count.exists() else 0) + len(pdf)
        first = self.reduced.get()[0] if self.reduced.exists() else pdf[self.url].iloc[0]
        total, m = self.agg.get() if self.agg.exists() else (0, 0)
        total, m = total + int(times.sum()), m + len(pdf)
        for u, c in pdf[self.url].value_counts().items():
            old = self.urls.getValue((u,))[0] if self.urls.containsKey((u,)) else 0
            self.urls.updateValue((u,), (old + int(c),))
        self.count.update((n,))          # a write refreshes the TTL
        self.reduced.update((first, int(times.iloc[-1])))
        self.agg.update((total, m))
        self.visited.appendList([(u,) for u in pdf[self.url]])
        yield pd.DataFrame({"key": [str(key[0])], "cnt": [n], "first_url": [first], "last_ms": [int(times.iloc[-1])],
                            "avg_ms": [total // m], "n_urls": [sum(1 for _ in self.urls.keys())],
                            "urls": [[r[0] for r in self.visited.get()]]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        return iter([])

    def close(self) -> None:
        pass


# ------------------------------------------------------------------ JN6

class PreviousAction(StatefulProcessor):
    """Value state of a user's previous action (JN6 streaming): emits
    ``key, seq, prev_action, action`` per row; a stream-static join with the
    pattern validity table then finds the matches."""

    OUTPUT = "key string, seq long, prev_action string, action string"

    def __init__(self, seq: str, action: str):
        self.seq, self.action = seq, action

    def init(self, handle) -> None:
        self.prev = handle.getValueState("prev", "action string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows, [self.seq], key)
        prev = self.prev.get()[0] if self.prev.exists() else None
        out = []
        for s, a in zip(pdf.get(self.seq, []), pdf.get(self.action, [])):
            out.append((str(key[0]), int(s), prev, a))
            prev = a
        if prev is not None:
            self.prev.update((prev,))
        yield pd.DataFrame(out, columns=["key", "seq", "prev_action", "action"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        return iter([])

    def close(self) -> None:
        pass


# ------------------------------------------------------------------ ST5

class ProcessingTimeTimers(StatefulProcessor):
    """Processing-time timer (ST5): every row registers a timer ``delay_ms``
    after its arrival (wall clock); the timer emits one row.  Run with
    ``time_mode="ProcessingTime"``.  Output: ``key, kind, at_ms``."""

    OUTPUT = "key string, kind string, at_ms long"

    def __init__(self, delay_ms: int):
        self.delay = delay_ms

    def init(self, handle) -> None:
        self.handle = handle

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n = sum(len(r) for r in rows)
        now = timerValues.getCurrentProcessingTimeInMs()
        self.handle.registerTimer(now + self.delay)
        yield pd.DataFrame({"key": [str(key[0])] * n, "kind": ["arrival"] * n, "at_ms": [now] * n})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"key": [str(key[0])], "kind": ["fired"], "at_ms": [expiredTimerInfo.getExpiryTimeInMs()]})

    def close(self) -> None:
        pass
