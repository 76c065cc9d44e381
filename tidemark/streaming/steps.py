"""Steps of the stateful operators: small functions from a key's state and one event to its new state and what it
emits. Batches replay them per key with ``mapInPandas`` and streams hold the same state in
``transformWithStateInPandas`` (see :mod:`tidemark.streaming.stateful`). State is a JSON-like dict; times are epoch
milliseconds of the event, never the wall clock.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

#: Weights of feedback in recent queues (tag, author), in weighted interests, and their half-lives in hours.
QUEUE_WEIGHTS = {"positive": (1.2, 1.0), "short": (0.5, 0.1), "report": (0.1, 0.1), "uninterested": (0.1, 0.1)}
INTEREST_WEIGHTS = {"positive": 0.3, "short": 0.2, "report": 0.5, "uninterested": 0.5}
HALF_LIFE_HOURS = {"positive": 6.0, "negative": 24.0}
QUEUE_SIZE, INTEREST_SIZE = 5, 10
DAYS = {"no_zone": (3, 7, 14), "block": (1, 3, 7)}
IST = timezone(timedelta(hours=5, minutes=30))

Step = Callable[[dict, dict], tuple[dict, list[dict]]]


def requeue(queue: list, key, value, size: int) -> list:
    """A first-in-first-out list of (key, value): a key that comes again moves to the end, the oldest go."""
    return ([x for x in queue if x[0] != key] + [[key, value]])[-size:]


def put_recent(held: dict, key: str, value, now: int, size: int) -> dict:
    """A map that evicts the entry updated longest ago; entries are lists that end with their time."""
    if key not in held and len(held) >= size:
        held.pop(min(held, key=lambda k: (held[k][-1], k)))
    held[key] = [*(value if isinstance(value, list) else [value]), now]
    return held


def feedback_queues(state: dict, e: dict) -> tuple[dict, list[dict]]:
    """Recent liked and disliked tags and authors of a user. Dislike wins: a like of what is in the disliked queue is
    ignored, a dislike takes it out of the liked queue. Event: feedback, tag, author."""
    q = {k: list(state.get(k, [])) for k in ("positive_tags", "negative_tags", "positive_authors", "negative_authors")}
    weights = QUEUE_WEIGHTS[e["feedback"]]
    tag = (e.get("tag") or "").strip()
    author = e.get("author") or 0
    for kind, key, ok, w in (("tags", tag, bool(tag), weights[0]), ("authors", author, author > 0, weights[1])):
        if not ok:
            continue
        up, down = f"positive_{kind}", f"negative_{kind}"
        if e["feedback"] == "positive":
            if all(x[0] != key for x in q[down]):
                q[up] = requeue(q[up], key, w, QUEUE_SIZE)
        else:
            q[up] = [x for x in q[up] if x[0] != key]
            q[down] = requeue(q[down], key, w, QUEUE_SIZE)
    return q, [dict(q)] if any(q.values()) else []


def negative_tags(state: dict, e: dict) -> tuple[dict, list[dict]]:
    """The unweighted twin: the tags of the last short views."""
    q = list(state.get("tags", []))
    tag = (e.get("tag") or "").strip()
    if e["feedback"] == "short" and tag:
        q = requeue(q, tag, 1, QUEUE_SIZE)
    return {"tags": q}, [{"tags": [x[0] for x in q]}] if q else []


def _decayed(entry: list, now: int) -> tuple[float, float]:
    hours = max(0, now - entry[2]) / 3_600_000
    return entry[0] * 0.5 ** (hours / HALF_LIFE_HOURS["positive"]), entry[1] * 0.5 ** (hours / HALF_LIFE_HOURS["negative"])


def net_weight(net: float, mode: str = "reference") -> float:
    from math import exp

    s = lambda x: 1 / (1 + exp(-x))
    if mode == "monotone":
        return s(net)
    return 1 + s(net) if net > 0 else s(-net) if net < 0 else 1.0


def weighted_interests(state: dict, e: dict, mode: str = "reference") -> tuple[dict, list[dict]]:
    """Tags and authors with decayed likes and dislikes; the ten of largest weight that differ from 1 by over 0.01.
    State keeps raw scores and times: [likes, dislikes, time]. Event: feedback, tag, author, ts."""
    held = {k: dict(state.get(k, {})) for k in ("tags", "authors")}
    now, plus = e["ts"], e["feedback"] == "positive"
    tag, author = (e.get("tag") or "").strip(), e.get("author") or 0
    for kind, key in (("tags", tag), ("authors", str(author) if author > 0 else "")):
        if not key:
            continue
        m = held[kind]
        up, down = _decayed(m[key], now) if key in m else (0.0, 0.0)
        w = INTEREST_WEIGHTS[e["feedback"]]
        put_recent(m, key, [up + w, down] if plus else [up, down + w], now, INTEREST_SIZE)
    out = {}
    for kind, m in held.items():
        scored = [(k, net_weight((lambda d: d[0] - d[1])(_decayed(v, now)), mode)) for k, v in m.items()]
        out[kind] = sorted(([k, round(w, 6)] for k, w in scored if abs(w - 1) > 0.01), key=lambda x: (-x[1], x[0]))[:INTEREST_SIZE]
    return held, [out] if any(held.values()) else []


def recent_anchors(state: dict, e: dict, size: int = 20, expire_ms: int = 15 * 60_000) -> tuple[dict, list[dict]]:
    """Anchors a user met, latest last, at most ``size`` and none older than ``expire_ms``. Event: event, anchor_id, ts."""
    if e["event"] not in ("live_exposure", "enter_liveroom"):
        return state, []
    q = requeue(state.get("anchors", []), e["anchor_id"], e["ts"], 1 << 30)
    q = [x for x in q if x[1] + expire_ms >= e["ts"]][-size:]
    return {"anchors": q}, [{"anchors": [x[0] for x in q]}]


def latest_lists(state: dict, e: dict, sizes: dict[str, int] | None = None, expire_ms: int = 12 * 3_600_000) -> tuple[dict, list[dict]]:
    """A user's lists by name, each id at its latest time, oldest first. Event: lists (name to id), ts, and scores
    (name to score) for lists of ids with scores."""
    ts, scores, held = e["ts"], e.get("scores") or {}, {}
    for name, entries in state.items():
        held[name] = [x for x in entries if x[1] + expire_ms >= ts]
    for name, ident in e["lists"].items():
        if ident:
            old, rest = None, []
            for x in held.get(name, ()):
                if x[0] == ident:
                    old = x[1] if old is None else old
                else:
                    rest.append(x)
            if old is None or ts > old:
                rest.append([ident, ts, scores[name]] if name in scores else [ident, ts])
                held[name] = rest[-(sizes or {}).get(name, 10) :]
    held = {k: v for k, v in held.items() if v}
    return held, [{k: [x[0] if len(x) == 2 else [x[0], x[2]] for x in v] for k, v in held.items()}] if held else []


def last_distinct(state: dict, e: dict, n: int = 30, least: int = 2) -> tuple[dict, list[dict]]:
    """The last n distinct posts by first time seen; emitted once there are ``least``. Event: post_id, ts."""
    q = list(state.get("posts", []))
    if all(x[0] != e["post_id"] for x in q):
        q = (q + [[e["post_id"], e["ts"]]])[-n:]
    return {"posts": q}, [{"posts": [x[0] for x in q]}] if len(q) >= least else []


def align_20(ms: int) -> int:
    """The next 20:00 in India: of the same day if strictly before it."""
    t = datetime.fromtimestamp(ms / 1000, IST)
    at = t.replace(hour=20, minute=0, second=0, microsecond=0)
    at = at if t < at else at + timedelta(days=1)
    return int(at.timestamp() * 1000)


def _cool(user_type: str, probes: int, now: int, stage: int, counts: bool) -> dict:
    n = probes + 1 if counts else probes
    level = max(stage, n) if counts else stage
    days = DAYS["block" if user_type == "block" else "no_zone"][min(max(level, 1), 3) - 1]
    return {"stage": "cooling", "probe_count": n, "cooldown_stage": level, "cooldown_end_ts": align_20(now + days * 86_400_000)}


def transition(user_type: str, s: dict, feedback: str, now: int) -> dict:
    """The next state of the sensitivity machine. Likes lead probing_mid, probing_high, stable, one step at a time;
    dislikes lead to cooling, which ends at 20:00 India time and starts again from probing_mid; users of the zone
    stay in probing_mid."""
    s = {"stage": s.get("stage") or "probing_mid", "probe_count": s.get("probe_count", 0), "cooldown_stage": s.get("cooldown_stage", 0), "cooldown_end_ts": s.get("cooldown_end_ts", 0)}
    if user_type == "zone":
        return {"stage": "probing_mid", "probe_count": 0, "cooldown_stage": 0, "cooldown_end_ts": 0}
    if s["stage"] == "cooling":
        if now < s["cooldown_end_ts"]:
            return s
        s |= {"stage": "probing_mid", "cooldown_stage": 0, "cooldown_end_ts": 0}
    stage = s["stage"]
    if feedback == "negative":
        if stage == "stable":
            return _cool(user_type, max(s["probe_count"], 2), now, 3, False)
        return _cool(user_type, s["probe_count"], now, 2 if stage == "probing_high" else 1, True)
    if feedback == "positive":
        if stage == "probing_high":
            return {"stage": "stable", "probe_count": 0, "cooldown_stage": 0, "cooldown_end_ts": 0}
        if stage != "stable":
            return s | {"stage": "probing_high"}
    return s


def sensitivity(state: dict, e: dict) -> tuple[dict, list[dict]]:
    """One step of the machine. Event: user_type, feedback, ts, pos_tag, neg_tag. Nothing is emitted without feedback."""
    if e["feedback"] == "none":
        return state, []
    new = transition(e["user_type"], state, e["feedback"], e["ts"])
    tags = {"last_pos_tag": e.get("pos_tag") or "unk", "last_neg_tag": e.get("neg_tag") or "unk"}
    return new, [new | tags | {"user_type": e["user_type"], "last_feedback": e["feedback"], "last_feedback_ts": e["ts"]}]


def early_session(state: dict, e: dict, gap_ms: int = 70_000) -> tuple[dict, list[dict]]:
    """Sessions of a key that emit at their first strong signal and again when the gap closes. Event: ts, standing_time,
    progress_time, playback_time, strong (a flag of its own), closing (no event, time has passed)."""
    out = []
    if state and e["ts"] > state["last"] + gap_ms:
        out.append({k: state[k] for k in ("start", "last", "standing", "progress", "playback", "strong")} | {"is_final": True})
        state = {}
    if e.get("closing"):
        return state, out
    if not state:
        state = {"start": e["ts"], "last": e["ts"], "standing": 0.0, "progress": 0.0, "playback": 0.0, "strong": False, "fired": False}
    state = state | {"last": max(state["last"], e["ts"]), "standing": state["standing"] + e["standing_time"], "progress": max(state["progress"], e["progress_time"]), "playback": state["playback"] + e["playback_time"]}
    if e["strong"] or e["standing_time"] > 10 or e["playback_time"] > 8:
        state["strong"] = True
        if not state["fired"]:
            state["fired"] = True
            out.append({k: state[k] for k in ("start", "last", "standing", "progress", "playback", "strong")} | {"is_final": False})
    return state, out


#: What a session's summary carries: the first of each that is known, sums, the largest, and flags that any event set.
SUMMARY_FLAGS = ("complete", "like", "comment", "share", "collect", "follow", "profile", "report", "uninterested", "paid")


def post_summaries(state: dict, e: dict, gap_ms: int = 70_000) -> tuple[dict, list[dict]]:
    """Sessions of a token and post as whole summaries: one at the first strong event, at the time of the last event so far, and one
    when the gap closes, at its end. Event: uid, post_id, author, length, standing_time, progress_time, playback_time, the
    flags, ts, closing (no event, time has passed). Emitted: all of them summed up, ``at`` and ``final``."""
    out = []

    def summary(at: int, final: bool) -> dict:
        return {k: v for k, v in state.items() if k not in ("last", "fired")} | {"at": at, "final": final}

    if state and e["ts"] > state["last"] + gap_ms:
        out.append(summary(state["last"] + gap_ms, True))
        state = {}
    if e.get("closing"):
        return state, out
    if not state:
        state = {"uid": e.get("uid"), "post_id": e["post_id"], "author": 0, "length": 0.0, "standing": 0.0, "progress": 0.0, "playback": 0.0, "last": e["ts"], "fired": False} | dict.fromkeys(SUMMARY_FLAGS, False)
    standing, playback = e.get("standing_time") or 0.0, e.get("playback_time") or 0.0
    flags = {f: bool(e.get(f)) for f in SUMMARY_FLAGS}
    author, length = max(e.get("author") or 0, 0), max(e.get("length") or 0.0, 0.0)
    state = state | {"author": state["author"] or author, "length": state["length"] or length, "standing": state["standing"] + standing, "playback": state["playback"] + playback}
    state |= {"progress": max(state["progress"], e.get("progress_time") or 0.0), "last": max(state["last"], e["ts"])} | {f: state[f] or on for f, on in flags.items()}
    if not state["fired"] and (standing > 10 or playback > 8 or any(flags.values())):
        state["fired"] = True
        out.append(summary(state["last"], False))
    return state, out


def user_counters(state: dict, e: dict, ttl_ms: int = 3_600_000) -> tuple[dict, list[dict]]:
    """Events of a user, the last time of each type, and the last ten events; entries older than ``ttl_ms`` go.
    Event: event_type, ts."""
    if state and e["ts"] - state["last"] > ttl_ms:
        state = {}
    times = {k: v for k, v in state.get("times", {}).items() if e["ts"] - v <= ttl_ms} | {e["event_type"]: e["ts"]}
    new = {"n": state.get("n", 0) + 1, "times": times, "history": (state.get("history", []) + [e["event_type"]])[-10:], "last": e["ts"]}
    return new, [{"n": new["n"], "types": len(times)}]
