"""Stateful operators in batches and streams from one step function (see :mod:`tidemark.streaming.steps`).

:func:`replay` runs a table through a step, key by key and in order. Rows stream through sorted partitions, so a
key's events are never held together: memory is one state, however hot the key. :func:`stream` holds the state in
Spark's state store, with TTL or event-time timers. Emitted values are JSON text.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import datetime, timezone
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.streaming.steps import Step

OUT = "key string, ts long, value string"
#: The same with an event time that a stateful operator behind may use.
TIMED = "key string, at timestamp, value string"
_CLOSED = 1 << 62
#: Time of the row that holds a key's stored state.
_STORED = -(1 << 62)
_text = json.JSONEncoder(sort_keys=True).encode


def _packed(df: DataFrame, key: str, fields: list[str], ts: str) -> DataFrame:
    ms = F.unix_millis(ts) if dict(df.dtypes)[ts].startswith("timestamp") else F.col(ts)
    return df.select(F.col(key).cast("string").alias("key"), ms.alias("ts"), F.to_json(F.struct(*[F.col(f) for f in fields])).alias("event"))


def snapshot(df: DataFrame, key: str, fields: list[str], step: Step, ts: str = "ts", initial: DataFrame | None = None) -> DataFrame:
    """key, state (JSON) of each key behind its last row: what :func:`stream` and :func:`replay` can start from."""

    def shown(state: dict, e: dict) -> tuple[dict, list[dict]]:
        state, _ = step(state, e)
        return state, [state]

    return replay(df, key, fields, shown, ts, final_only=True, initial=initial).select("key", F.col("value").alias("state"))


def replay(df: DataFrame, key: str, fields: list[str], step: Step, ts: str = "ts", final_only: bool = False, close: bool = False, initial: DataFrame | None = None) -> DataFrame:
    """key, ts, value (JSON) for all that ``step`` emits, or only each key's last. ``close``: behind its last row a key's
    step is called once more, with ``closing`` and a time beyond all gaps. ``initial``: stored states (key, state as JSON)
    that keys start from."""
    rows = _packed(df.filter(F.col(key).isNotNull()), key, fields, ts)
    if initial is not None:
        rows = rows.unionByName(initial.select(F.col("key").cast("string").alias("key"), F.lit(_STORED).alias("ts"), F.col("state").alias("event")))
    rows = rows.repartition("key").sortWithinPartitions("key", "ts", "event")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, at, state, last = None, 0, {}, None

        def end() -> list[tuple]:
            """What the key that ends here still emits."""
            found = [] if last is None or not final_only else [last]
            if close and now is not None:
                more = [(now, at, _text(x)) for x in step(state, {"ts": _CLOSED, "closing": True})[1]]
                found = more[-1:] or found if final_only else more
            return found

        for f in frames:
            out = []
            for k, t, e in zip(f["key"], f["ts"], f["event"]):
                if k != now:
                    out += end()
                    now, state, last = k, {}, None
                if t == _STORED:
                    state = json.loads(e)
                    continue
                at = int(t)
                state, emitted = step(state, json.loads(e) | {"ts": at})
                for x in emitted:
                    last = (k, at, _text(x))
                    if not final_only:
                        out.append(last)
            yield pd.DataFrame(out, columns=["key", "ts", "value"])
        yield pd.DataFrame(end(), columns=["key", "ts", "value"])

    return rows.mapInPandas(run, OUT)


class _Runner(StatefulProcessor):
    """Holds a key's state as JSON. ``gap_ms``: an event-time timer calls the step with ``closing`` once the key has
    been quiet for so long; a key has one timer, and an older one goes. ``ttl_ms`` without a gap is the store's own, on
    the wall clock; with one, Spark keeps a single clock, so state written longer ago in event time reads as none."""

    def __init__(self, step: Step, ttl_ms: int | None, gap_ms: int | None, timed: bool = False):
        self._step, self._ttl, self._gap, self._timed = step, ttl_ms, gap_ms, timed

    def _shown(self, key: str, emitted: list[tuple[int, dict]]) -> pd.DataFrame:
        if self._timed:
            return pd.DataFrame([(key, datetime.fromtimestamp(x["at"] / 1000, timezone.utc), json.dumps(x, sort_keys=True)) for _, x in emitted], columns=["key", "at", "value"], dtype=object)
        return pd.DataFrame([(key, t, json.dumps(x, sort_keys=True)) for t, x in emitted], columns=["key", "ts", "value"])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        own = {"ttlDurationMs": self._ttl} if self._ttl and not self._gap else {}
        self._state = handle.getValueState("state", "json string", **own)

    def _arm(self, at: int | None) -> None:
        """The key's one timer."""
        for t in list(self._handle.listTimers()):
            if t != at:
                self._handle.deleteTimer(t)
        if at is not None:
            self._handle.registerTimer(at)

    def _fresh(self, state: dict, now: int) -> dict:
        return {} if self._gap and self._ttl and state and now - state["last"] > self._ttl else state

    def _load(self) -> dict:
        return json.loads(self._state.get()[0]) if self._state.exists() else {}

    def _save(self, state: dict) -> None:
        if state:
            self._state.update((json.dumps(state),))
        else:
            self._state.clear()

    def handleInitialState(self, key, initialState, timerValues) -> None:
        state = json.loads(initialState["state"].iloc[0])
        self._save(state)
        if self._gap and state:
            self._arm(state["last"] + self._gap + 1)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        events = sorted((int(t), e) for f in rows for t, e in zip(f["ms"], f["event"]))
        state, out = self._load(), []
        for t, e in events:
            state, emitted = self._step(self._fresh(state, t), json.loads(e) | {"ts": t})
            out += [(t, x) for x in emitted]
        self._save(state)
        if self._gap:
            self._arm(state["last"] + self._gap + 1 if state else None)
        yield self._shown(key[0], out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        t = expiredTimerInfo.getExpiryTimeInMs()
        state, emitted = self._step(self._fresh(self._load(), t), {"ts": t, "closing": True})
        self._save(state)
        yield self._shown(key[0], [(t, x) for x in emitted])

    def close(self) -> None:
        pass


def stream(
    df: DataFrame, key: str, fields: list[str], step: Step, ts: str = "ts", watermark: str | None = "10 seconds", ttl_ms: int | None = None, gap_ms: int | None = None, timed: bool = False,
    initial: DataFrame | None = None,
) -> DataFrame:
    """The streaming twin of :func:`replay`. Needs the RocksDB state store. Rows of a micro-batch are stepped in the
    order of (ts, event); across batches, as they arrive. ``timed``: what the step emits has a time ``at``, which becomes the
    result's event time, so that a stateful operator can follow; that one takes ``watermark`` None, as it has one already.
    ``initial``: stored states (key, state as JSON) that a new query starts from, loaded once into the state store."""
    d = df.filter(F.col(key).isNotNull())
    d = d.withWatermark(ts, watermark) if watermark else d
    d = d.select(F.col(key).cast("string").alias("key"), F.col(ts), F.unix_millis(ts).alias("ms"), F.to_json(F.struct(*[F.col(f) for f in fields])).alias("event"))
    mode = "EventTime" if gap_ms or timed else "ProcessingTime" if ttl_ms else "None"
    runner = _Runner(step, ttl_ms, gap_ms, timed)
    stored = None if initial is None else initial.select(F.col("key").cast("string").alias("key"), "state").groupBy("key")
    if timed:
        return d.groupBy("key").transformWithStateInPandas(runner, TIMED, "append", mode, stored, "at")
    return d.groupBy("key").transformWithStateInPandas(runner, OUT, "append", mode, stored)


class _FirstInWindows(StatefulProcessor):
    """Emits a row for each sliding window in which it is among the key's first ``cap`` to arrive, at a time inside the window. The
    state has a count for each window that isn't over."""

    def __init__(self, cap: int, size_ms: int, slide_ms: int, tie: str, ts: str):
        self._cap, self._size, self._slide, self._tie, self._ts = cap, size_ms, slide_ms, tie, ts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getValueState("counts", "json string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        counts = {int(k): n for k, n in json.loads(self._state.get()[0]).items()} if self._state.exists() else {}
        frame = pd.concat(list(rows), ignore_index=True).sort_values(["event_ms", self._tie], kind="stable")
        taken, ends = [], []
        for i, ms in zip(frame.index, frame["event_ms"]):
            first = int(ms) // self._slide * self._slide + self._slide
            for end in range(first, first + self._size, self._slide):
                if counts.get(end, 0) < self._cap:
                    counts[end] = counts.get(end, 0) + 1
                    taken.append(i)
                    ends.append(end)
        over = timerValues.getCurrentWatermarkInMs()
        self._state.update((json.dumps({k: n for k, n in counts.items() if k > over}),))
        out = frame.loc[taken].drop(columns=["event_ms", self._ts]).astype(object)
        # a millisecond before the end: inside the window's last slide and not before the row itself
        out["window_at"] = pd.Series([datetime.fromtimestamp((e - 1) / 1000, timezone.utc) for e in ends], index=out.index, dtype=object)
        yield out.reset_index(drop=True)

    def close(self) -> None:
        pass


def first_in_windows(df: DataFrame, keys: list[str], cap: int, size_s: int, slide_s: int, tie: str, ts: str = "ts") -> DataFrame:
    """The columns of a stream with watermark but its event time, and ``window_at``, the event time from here on: rows in the windows that count
    them. Needs the RocksDB state store."""
    kept = [c for c in df.columns if c != ts]
    rows = df.select(*kept, ts, F.unix_millis(ts).alias("event_ms")).filter(reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*kept).schema)
    runner = _FirstInWindows(cap, size_s * 1000, slide_s * 1000, tie, ts)
    return rows.groupBy(*keys).transformWithStateInPandas(runner, f"{schema}, window_at timestamp", "append", "EventTime", eventTimeColumnName="window_at")


class Ticker(StatefulProcessor):
    """Counts of a key, emitted by a processing-time timer that sets itself again every ``every_ms``. A key's first rows arm
    it; while it is armed, later ones don't."""

    def __init__(self, every_ms: int = 300_000, ttl_ms: int = 86_400_000):
        self._every, self._ttl = every_ms, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._n = handle.getValueState("n", "n long", ttlDurationMs=self._ttl)
        self._kinds = handle.getMapState("kinds", "kind string", "n long", ttlDurationMs=self._ttl)
        self._last = handle.getListState("last", "kind string", ttlDurationMs=self._ttl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n = self._n.get()[0] if self._n.exists() else 0
        for f in rows:
            for kind in f["kind"]:
                n += 1
                self._kinds.updateValue((kind,), ((self._kinds.getValue((kind,))[0] if self._kinds.containsKey((kind,)) else 0) + 1,))
                self._last.put([*list(self._last.get())[-9:], (kind,)])
        self._n.update((n,))
        if not list(self._handle.listTimers()):
            self._handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self._every)
        yield pd.DataFrame([], columns=["key", "ts", "value"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        t = expiredTimerInfo.getExpiryTimeInMs()
        n = self._n.get()[0] if self._n.exists() else 0
        kinds = {k[0]: v[0] for k, v in self._kinds.iterator()}
        self._handle.registerTimer(t + self._every)
        yield pd.DataFrame([(key[0], t, json.dumps({"n": n, "kinds": kinds}, sort_keys=True))], columns=["key", "ts", "value"])

    def close(self) -> None:
        pass
