"""The first hours of a post as a co-process: interactions and start records in one keyed state, a row whenever counters grow and a last
one when time is up. Its batch twin is :func:`tidemark.operators.aggregates.item_cohorts`."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators.aggregates import item_conditions

HOUR_MS = 3_600_000


class _Cohort(StatefulProcessor):
    """A post's start, the counters of distinct tokens, each token's conditions as bits of a mask (a map in the state store, of
    which a batch reads its own tokens alone), and interactions that came before the start is known.

    A later start record moves the start, not the end of a cohort that runs. ``hold``: interactions without a start wait for
    it as long as a cohort lasts; otherwise they are dropped."""

    def __init__(self, names: list[str], length_ms: int, hold: bool):
        self._names, self._length, self._hold = names, length_ms, hold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._head = handle.getValueState("head", "start_ms long, end_ms long, counts string")
        self._tokens = handle.getMapState("tokens", "token string", "mask long")
        self._early = handle.getListState("early", "ms long, token string, mask long")

    def _count(self, counts: list[int], token: str, mask: int) -> bool:
        known = self._tokens.getValue((token,))[0] if self._tokens.containsKey((token,)) else 0
        new = mask & ~known
        if new:
            self._tokens.updateValue((token,), (known | mask,))
            for i in range(len(counts)):
                counts[i] += new >> i & 1
        return bool(new)

    def _rows(self, key: tuple, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame([(key[0], *r) for r in rows], columns=["post_id", "start_ms", "emit_ms", "final", *self._names])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        start, end, counts = None, None, None
        if self._head.exists():
            start, end, held = self._head.get()
            counts = json.loads(held)
        events, waiting = [], list(self._early.get()) if self._early.exists() else []
        for f in rows:
            for ms, start_ms, token, mask in zip(f["ms"], f["start_ms"], f["token"], f["mask"]):
                events.append((int(ms), None if pd.isna(start_ms) else int(start_ms), token, int(mask)))
        grown = False
        # a start record before interactions of its time
        for ms, start_ms, token, mask in sorted(events, key=lambda e: (e[0], e[1] is None, e[2] or "", e[3])):
            fresh = []
            if start_ms is not None:
                start = start_ms
                if end is None:
                    end, counts = start + self._length, [0] * len(self._names)
                    self._handle.registerTimer(end + 1)
                    fresh, waiting = [tuple(x) for x in waiting], []
            elif end is not None:
                fresh = [(ms, token, mask)]
            elif self._hold:
                if not waiting:
                    self._handle.registerTimer(ms + self._length + 1)
                waiting.append((ms, token, mask))
            for at, t, m in fresh:
                if t is not None and start <= at <= start + self._length:
                    grown |= self._count(counts, t, m)
        if self._hold:
            self._early.clear() if not waiting else self._early.put([tuple(x) for x in waiting])
        if end is not None:
            self._head.update((start, end, json.dumps(counts)))
        yield self._rows(key, [(start, start + self._length, False, *counts)] if grown else [])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at = expiredTimerInfo.getExpiryTimeInMs()
        out = []
        if self._head.exists():
            start, end, held = self._head.get()
            if at > end:
                counts = json.loads(held)
                out = [(start, start + self._length, True, *counts)] if any(counts) else []
                self._head.clear()
                self._tokens.clear()
        elif self._early.exists():
            left = [tuple(x) for x in self._early.get() if x[0] + self._length + 1 > at]
            self._early.clear()
            if left:
                self._early.put(left)
                self._handle.registerTimer(min(x[0] for x in left) + self._length + 1)
        yield self._rows(key, out)

    def close(self) -> None:
        pass


def item_cohort_stream(events: DataFrame, starts: DataFrame, hours: int = 48, hold: bool = True, watermark: str = "10 minutes") -> DataFrame:
    """post_id, start_ms, emit_ms (when the cohort closes), final, and the eleven counters of distinct tokens of a post over the ``hours``
    from its start record on: a row for each micro-batch in which they grow, and the final one. ``starts``: post_id, start_ts, and ts,
    the time at which the record was made, by which it may be late. Needs the RocksDB state store."""
    conds = item_conditions()
    mask = sum((F.when(c, 1 << i).otherwise(0).cast("long") for i, c in enumerate(conds.values())), F.lit(0).cast("long"))
    none = F.lit(None)
    e = events.select("post_id", "ts", F.unix_millis("ts").alias("ms"), none.cast("long").alias("start_ms"), F.col("rec_token").alias("token"), mask.alias("mask"))
    s = starts.select("post_id", "ts", F.unix_millis("ts").alias("ms"), F.unix_millis("start_ts").alias("start_ms"), none.cast("string").alias("token"), F.lit(0).cast("long").alias("mask"))
    rows = e.unionByName(s).filter(F.col("post_id").isNotNull()).withWatermark("ts", watermark)
    schema = "post_id long, start_ms long, emit_ms long, final boolean, " + ", ".join(f"`{n}` long" for n in conds)
    return rows.groupBy("post_id").transformWithStateInPandas(_Cohort(list(conds), hours * HOUR_MS, hold), schema, "append", "EventTime")
