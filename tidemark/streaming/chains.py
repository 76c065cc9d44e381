"""Stateful operators that feed each other, the same in batches and in streams."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.aggregates import RECENT_LISTS
from tidemark.streaming import stateful, steps

_SUMMARY = "uid long, post_id long, author long, length double, standing double, progress double, playback double, at long, final boolean, " + ", ".join(f"`{f}` boolean" for f in steps.SUMMARY_FLAGS)
_EVENT = ["uid", "post_id", "author", "length", "standing_time", "progress_time", "playback_time", *steps.SUMMARY_FLAGS]
#: A session that enters a list.
TRIGGERS = " or ".join(f"({cond})" for _, cond, _, _ in RECENT_LISTS.values())


def session_summaries(posts: DataFrame, gap_ms: int = 70_000, watermark: str = "10 seconds") -> DataFrame:
    """Summaries of sessions of a token and post, early at the first strong event and final at the gap's end: the columns of the
    session aggregate, ``final`` and the timestamp ``at``, which is the event time of streams. Streams hold a state
    (:func:`steps.post_summaries`), batches take running aggregates of the same rows in the same order."""
    e = posts.withColumn("key", F.concat_ws("|", "rec_token", "post_id"))
    if not posts.isStreaming:
        return _batch_summaries(e, gap_ms)
    s = stateful.stream(e, "key", _EVENT, partial(steps.post_summaries, gap_ms=gap_ms), watermark=watermark, gap_ms=gap_ms, timed=True)
    d = s.withColumn("_s", F.from_json("value", _SUMMARY))
    return d.select("at", *[F.col(f"_s.{n}").alias(n) for n, _ in _fields() if n != "at"])


def _fields() -> list[tuple[str, str]]:
    """Names and types of a summary."""
    return [(n.strip("`"), kind) for n, kind in (f.split() for f in _SUMMARY.split(", "))]


def _batch_summaries(e: DataFrame, gap_ms: int) -> DataFrame:
    """A row shows the sums of its session so far: an early summary if it is the first strong one, a final one if it is the last."""
    ms = F.unix_millis("ts") if dict(e.dtypes)["ts"].startswith("timestamp") else F.col("ts")
    known = {f: F.coalesce(f, F.lit(False)) for f in steps.SUMMARY_FLAGS} | {x: F.coalesce(x, F.lit(0.0)) for x in ("standing_time", "playback_time", "progress_time")}
    e = e.select("key", ms.alias("_ms"), F.to_json(F.struct(*_EVENT)).alias("_event"), "uid", "post_id", "author", "length", *[x.alias(n) for n, x in known.items()])
    strong = (F.col("standing_time") > 10) | (F.col("playback_time") > 8)
    for f in steps.SUMMARY_FLAGS:
        strong = strong | F.col(f)
    key = W.partitionBy("key").orderBy("_ms", "_event")
    apart = lambda before, after: F.coalesce(after > before + gap_ms, F.lit(True))
    e = e.withColumns({"_first": apart(F.lag("_ms").over(key), F.col("_ms")), "_last": apart(F.col("_ms"), F.lead("_ms").over(key)), "_strong": strong})
    e = e.withColumn("_no", F.sum(F.col("_first").cast("long")).over(key))
    so_far = W.partitionBy("key", "_no").orderBy("_ms", "_event").rowsBetween(W.unboundedPreceding, W.currentRow)
    above = lambda x: F.first(F.when(F.col(x) > 0, F.col(x)), ignorenulls=True).over(so_far)
    shown = {
        "uid": F.first("uid").over(so_far), "post_id": F.first("post_id").over(so_far), "author": F.coalesce(above("author"), F.lit(0)), "length": F.coalesce(above("length"), F.lit(0.0)),
        "standing": F.sum("standing_time").over(so_far), "progress": F.greatest(F.lit(0.0), F.max("progress_time").over(so_far)), "playback": F.sum("playback_time").over(so_far),
    } | {f: F.max(f).over(so_far) for f in steps.SUMMARY_FLAGS}
    moment = lambda at, final: F.struct(at.alias("at"), F.lit(final).alias("final"))
    early = F.col("_strong") & (F.sum(F.col("_strong").cast("long")).over(so_far) == 1)
    s = e.select("_ms", "_last", early.alias("_early"), *[x.alias(n) for n, x in shown.items()])
    s = s.withColumn("_m", F.explode(F.array_compact(F.array(F.when(F.col("_early"), moment(F.col("_ms"), False)), F.when(F.col("_last"), moment(F.col("_ms") + gap_ms, True))))))
    return s.select(F.timestamp_millis("_m.at").alias("at"), *[(F.col("_m.final") if n == "final" else F.col(n)).cast(kind).alias(n) for n, kind in _fields() if n != "at"])


def _listed(state: dict, e: dict, sizes: dict[str, int], expire_ms: int) -> tuple[dict, list[dict]]:
    state, shown = steps.latest_lists(state, e, sizes, expire_ms)
    return state, [{"post_id": e["post_id"], "final": e["final"], "lists": x} for x in shown]


def latest_user_lists(posts: DataFrame, gap_ms: int = 70_000, watermark: str = "10 seconds", sizes: dict[str, int] | None = None, expire_ms: int = 12 * 3_600_000) -> DataFrame:
    """key (the user), ts, value (post_id, final, lists) after each summary that enters a list: sessions with early firing, and behind them
    a user's sixteen lists. In streams both states live in one query."""
    kept = {n: size for n, (_, _, size, _) in RECENT_LISTS.items()} | (sizes or {})
    lists = F.struct(*[F.when(F.expr(cond), F.col(ident)).alias(n) for n, (ident, cond, _, _) in RECENT_LISTS.items()])
    scores = F.struct(*[F.col(score).alias(n) for n, (_, _, _, score) in RECENT_LISTS.items() if score])
    s = session_summaries(posts, gap_ms, watermark).filter(TRIGGERS).withColumns({"lists": lists, "scores": scores})
    step, fields = partial(_listed, sizes=kept, expire_ms=expire_ms), ["post_id", "final", "lists", "scores"]
    if posts.isStreaming:
        return stateful.stream(s, "uid", fields, step, ts="at", watermark=None)
    return stateful.replay(s, "uid", fields, step, ts="at")
