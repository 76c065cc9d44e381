"""Window aggregates over feature events (schemas.FEATURE_EVENT), sessions and live events.

Every aggregate takes a DataFrame and works in batch; those made of plain aggregates (all but the lists) work in
streams as they are.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import topk
from tidemark.operators import windows as T
from tidemark.schemas import CODES

#: Thresholds in seconds (fixed values).
VIEW_STEPS, STAND_STEPS = (3, 8, 12, 20), (5, 10)


def has(*names: str) -> Column:
    return reduce(lambda a, b: a | b, (F.array_contains("interactions", CODES[n]) for n in names))


def acted(*names: str) -> Column:
    """A view with one of the interactions."""
    return (F.col("kind") == "view") & has(*names)


def viewed(least: float = 0) -> Column:
    return (F.col("kind") == "view") & (F.col("progress_time") >= least)


def stood(least: float) -> Column:
    return (F.col("kind") == "view") & (F.col("standing_time") >= least)


def item_conditions() -> dict[str, Column]:
    """The eleven counters of an item."""
    out = {"expose": F.col("kind") == "expose"}
    out |= {f"view_{s}s": viewed(s) for s in VIEW_STEPS} | {f"stand_{s}s": stood(s) for s in STAND_STEPS}
    return out | {"like": acted("like"), "follow": acted("follow"), "profile": acted("profile"), "interact": acted("comment", "collect", "share")}


def item_windows(events: DataFrame, size: str = "1 hour", slide: str = "10 minutes", exact: bool = False) -> DataFrame:
    """Distinct tokens of an item by counter: sketches, or exact counts."""
    if exact:
        return _distinct(events, ["post_id"], size, slide, "rec_token", item_conditions(), many=True)
    return T.windowed(events, ["post_id"], size, slide, {n: sketched(F.when(cond, F.col("rec_token"))) for n, cond in item_conditions().items()})


def sketched(x: Column, log_k: int = 12) -> Column:
    return F.coalesce(F.hll_sketch_estimate(F.hll_sketch_agg(x, log_k)), F.lit(0))


def _distinct(df: DataFrame, keys: list[str], size: str, slide: str, value: str, conds: dict[str, Column], cap: int | None = None, cap_keys: list[str] | None = None, tie: str = "event_id", many: bool = False) -> DataFrame:
    """Exact distinct counts in batches and in streams; ``cap``: of the first ``cap`` events of ``cap_keys`` in a window."""
    if df.isStreaming:
        return T.distinct_stream(T.stream_windows(df, keys, size, slide, cap, cap_keys, tie), keys, slide, value, conds)
    rows = df if cap is None else T.capped(df, cap_keys or keys, cap, T.seconds(size), T.seconds(slide), ["ts", tie])
    return T.distinct_windows(rows, keys, size, slide, value, conds, many=many)


def item_panes(events: DataFrame, size_s: int = 86400, slide_s: int = 1800) -> DataFrame:
    """The same with sketches kept by pane and united over windows."""
    return T.paned(events, ["post_id"], size_s, slide_s, {n: T.distinct_sketch("rec_token", cond) for n, cond in item_conditions().items()})


def item_cohorts(events: DataFrame, starts: DataFrame, hours: int = 48, exact: bool = True) -> DataFrame:
    """post_id, start_ts, emit_ts (when the cohort closes) and the eleven counters of an item over the ``hours`` from its
    start record on. In streams give both sides a watermark; counts are sketches there, and output mode ``update``
    shows each as it grows."""
    from tidemark.operators.joins import within_start

    rows = within_start(events, starts, hours)
    keys, conds = ["post_id", "start_ts"], item_conditions()
    if exact and not events.isStreaming:
        out = T.distinct_counts(rows, keys, "rec_token", conds)
    else:
        out = rows.groupBy(*keys).agg(*[sketched(F.when(cond, F.col("rec_token"))).alias(n) for n, cond in conds.items()])
    return out.select(*keys, (F.col("start_ts") + F.expr(f"INTERVAL {hours} HOURS")).alias("emit_ts"), *conds)


def user_counts(events: DataFrame, size: str = "1 hour", slide: str = "5 minutes", cap: int | None = None) -> DataFrame:
    """Exposed posts and posts viewed for 3 seconds: all, images (1), videos (2). ``cap``: of a user's first events of a window."""
    image, video = F.col("post_type") == 1, F.col("post_type") == 2
    conds = {"exposed": F.col("kind") == "expose", "viewed": viewed(3), "viewed_images": viewed(3) & image, "viewed_videos": viewed(3) & video}
    return _distinct(events, ["uid"], size, slide, "post_id", conds, cap)


#: Lists of a user: what is listed, and which interactions put it there.
USER_LISTS = {
    "like_posts": ("post_id", ("like",)),
    "follow_posts": ("post_id", ("follow",)),
    "profile_posts": ("post_id", ("profile",)),
    "interact_posts": ("post_id", ("comment", "collect", "share")),
    "like_authors": ("author", ("like",)),
    "follow_authors": ("author", ("follow",)),
    "profile_authors": ("author", ("profile",)),
}


def user_lists(events: DataFrame, size: str = "1 hour", slide: str = "5 minutes", k: int = 10, cap: int | None = None, show: Callable[[Column], Column] = lambda ids: ids) -> DataFrame:
    """uid, window_end, list, items (ids): the k ids last acted on, latest first, for each of USER_LISTS. ``cap``: only a
    user's first ``cap`` events of a window count. ``show``: what to make of the ids."""
    marks = [
        F.when(acted(*acts) & (F.col(ident) > 0), F.struct(F.lit(name).alias("list"), F.col(ident).alias("id")))
        for name, (ident, acts) in USER_LISTS.items()
    ]
    return _listed(events, marks, F.unix_micros("ts"), size, slide, k, k, cap, show=lambda items: show(F.transform(items, lambda x: x["id"])))


def user_scored_lists(events: DataFrame, size: str = "1 hour", slide: str = "5 minutes", k: int = 10, cap: int | None = None, show: Callable[[Column], Column] = lambda items: items) -> DataFrame:
    """uid, window_end, list, items (id, score): posts viewed for 3 seconds by progress, posts stood at for 5 by standing
    time, largest first. ``show``: what to make of the items."""
    mark = lambda cond, name, score: F.when(cond, F.struct(F.lit(name).alias("list"), F.col("post_id").alias("id"), F.col(score).alias("score")))
    marks = [mark(viewed(3), "view_3s", "progress_time"), mark(stood(5), "stand_5s", "standing_time")]
    scored = lambda items: F.transform(items, lambda x: F.struct(x["id"].alias("id"), x["value"].alias("score")))
    return _listed(events, marks, F.col("score"), size, slide, k, k, cap, show=lambda items: show(scored(items)))


def _listed(df: DataFrame, marks: list[Column], order: Column, size: str, slide: str, k, most: int, cap: int | None, ts: str = "ts", tie: str = "event_id", show: Callable[[Column], Column] | None = None) -> DataFrame:
    """Lists of a user by window; ``marks`` are structs (list, id, ..) or null, a row for each that isn't."""
    size_s, slide_s = T.seconds(size), T.seconds(slide)
    rows = df if cap is None else T.capped(df, ["uid"], cap, size_s, slide_s, [ts, tie], ts)
    rows = rows.withColumn("_m", F.explode(F.array_compact(F.array(*marks)))).select(*rows.columns, "_m.*")
    return T.list_windows(rows, ["uid", "list"], size_s, slide_s, "id", order, k, most, ts, show)


def _summed(df: DataFrame, keys: list[str], size: str, slide: str, aggs: dict[str, Column], cap: int | None, cap_keys: list[str], ts: str, tie: str) -> DataFrame:
    """Sums and counts by window, of the first ``cap`` rows of ``cap_keys`` in it; the same in batches and streams."""
    if df.isStreaming:
        rows = T.stream_windows(df, keys, size, slide, cap, cap_keys, tie, ts)
        out = rows.groupBy(*keys, "w").agg(*[a.alias(n) for n, a in aggs.items()])
        return out.select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *aggs)
    rows = df if cap is None else T.capped(df, cap_keys, cap, T.seconds(size), T.seconds(slide), [ts, tie], ts)
    return T.paned(rows, keys, T.seconds(size), T.seconds(slide), {n: T.Agg(a) for n, a in aggs.items()}, ts)


def capped_windows(events: DataFrame, size: str, slide: str, cap: int, key: str = "uid", order: tuple[str, ...] = ("ts", "event_id")) -> DataFrame:
    """Only the first ``cap`` events of a key in a window."""
    return T.first_events(T.assign(events, size, slide), [key, "window_end"], cap, list(order))


def author_conditions() -> dict[str, Column]:
    return {f"view_{s}s": viewed(s) for s in VIEW_STEPS} | {f"stand_{s}s": stood(s) for s in STAND_STEPS} | {"like": acted("like")}


def user_author_windows(events: DataFrame, size: str = "1 hour", slide: str = "5 minutes", keep_empty: bool = False, exact: bool = True, cap: int | None = None) -> DataFrame:
    """Distinct tokens of a user for each author; authors without a signal are dropped unless ``keep_empty``. ``cap``: of a
    user's first events of a window, whichever their author."""
    conds, known = author_conditions(), F.col("author") > 0
    if exact and cap is None:
        out = _distinct(events.filter(known), ["uid", "author"], size, slide, "rec_token", conds)
    elif exact:
        out = _distinct(events, ["uid", "author"], size, slide, "rec_token", conds, cap, ["uid"]).filter(known)
    else:
        out = T.windowed(events.filter(known), ["uid", "author"], size, slide, {n: sketched(F.when(cond, F.col("rec_token"))) for n, cond in conds.items()})
    return out if keep_empty else out.filter(reduce(lambda a, b: a | b, (F.col(n) > 0 for n in conds)))


def by_author(rows: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Author rows of a user as one map: the value of a hash. A user's authors in a window bound its size."""
    return rows.groupBy(*keys).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col("author").cast("string").alias("key"), F.struct(*fields).alias("value"))))).alias("authors"))


FLAGS = ("complete", "like", "comment", "share", "collect", "follow", "profile", "report", "uninterested", "paid")


def post_sessions(posts: DataFrame, gap: str = "70 seconds") -> DataFrame:
    """Client events of one token and post as sessions: first author and length above 0, summed times, the largest
    progress, flags, and the rate of progress to length."""
    nz = lambda x: F.min_by(F.when(F.col(x) > 0, F.col(x)), F.when(F.col(x) > 0, F.col("ts")))
    aggs = {"author": F.coalesce(nz("author"), F.lit(0)), "length": F.coalesce(nz("length"), F.lit(0.0)), "standing": F.sum("standing_time"), "playback": F.sum("playback_time"), "progress": F.max("progress_time"), "last_ts": F.max("ts")}
    aggs |= {f: F.bool_or(f) for f in FLAGS}
    out = T.sessions(posts, ["uid", "rec_token", "post_id"], gap, aggs)
    return out.withColumn("rate", F.when(F.col("length") > 0, F.col("progress") / F.col("length")).otherwise(0.0))


GOOD, BAD = "(like or comment or share or follow or collect or profile or paid)", "(report or uninterested)"
#: Recent lists of a user: id, which sessions, how many are kept, and the score that goes with an id (fixed values).
RECENT_LISTS = {
    "complete_play": ("post_id", "complete", 30, None),
    "stand_10s": ("post_id", "standing > 10", 30, "standing"),
    "play_8s": ("post_id", "playback > 8", 30, "playback"),
    "like": ("post_id", "like", 10, None),
    "comment": ("post_id", "comment", 10, None),
    "share": ("post_id", "share", 10, None),
    "follow": ("post_id", "follow", 10, None),
    "collect": ("post_id", "collect", 10, None),
    "profile": ("post_id", "profile", 10, None),
    "pay": ("post_id", "paid", 10, None),
    "report": ("post_id", "report", 10, None),
    "dislike": ("post_id", "uninterested", 10, None),
    "positive": ("post_id", GOOD, 20, None),
    "negative": ("post_id", BAD, 20, None),
    "positive_authors": ("author", f"{GOOD} and author > 0", 20, None),
    "negative_authors": ("author", f"{BAD} and author > 0", 20, None),
}
#: Over a day the skipped posts have a list too.
SESSION_LISTS = RECENT_LISTS | {"skip": ("post_id", "progress <= 2", 30, None)}
#: Sessions of a user that count in a window.
SESSION_CAP = 300


def session_user_counts(s: DataFrame, size: str = "24 hours", slide: str = "60 minutes", ts: str = "session_time", cap: int | None = SESSION_CAP) -> DataFrame:
    """Sessions and skips of a user, of the first ``cap`` sessions of a window, or of all (None)."""
    aggs = {"exposures": F.count("*"), "skips": F.count_if(F.col("progress") <= 2)}
    return _summed(s, ["uid"], size, slide, aggs, cap, ["uid"], ts, "post_id")


def session_user_lists(
    s: DataFrame, size: str = "24 hours", slide: str = "60 minutes", ts: str = "session_time", oldest_first: bool = False, cap: int | None = SESSION_CAP
) -> DataFrame:
    """uid, window_end, list, items (id, score): for each of SESSION_LISTS the ids of the sessions that came last, each at
    its last session of the list with that session's score (null for lists without)."""
    marks = [
        F.when(F.expr(cond), F.struct(F.lit(n).alias("list"), F.col(ident).alias("id"), (F.col(score) if score else F.lit(None)).cast("double").alias("score")))
        for n, (ident, cond, _, score) in SESSION_LISTS.items()
    ]
    most = max(k for _, _, k, _ in SESSION_LISTS.values())
    kept = F.lit(most)
    for n, (_, _, k, _) in SESSION_LISTS.items():
        kept = F.when(F.col("list") == n, k).otherwise(kept)
    order = F.struct(F.unix_micros(ts).alias("t"), F.col("score").alias("s"))
    out = _listed(s, marks, order, size, slide, kept, most, cap, ts, "post_id")
    items = F.transform("items", lambda x: F.struct(x["id"].alias("id"), x["value"]["s"].alias("score")))
    return out.withColumn("items", F.reverse(items) if oldest_first else items)


_SESSION_FLAGS = {"like": "like", "comment": "comment", "share": "share", "collect": "collect", "profile": "profile", "report": "report", "dislike": "uninterested", "pay": "paid"}


def _longer(column: str, name: str, *steps: int) -> dict[str, Column]:
    return {f"{name}_{n}s": F.count_if(F.col(column) > n) for n in steps}


def session_post_counts(s: DataFrame, size: str = "24 hours", slide: str = "60 minutes", ts: str = "session_time") -> DataFrame:
    """Fifteen counts of a post and the mean rate of progress where there is one."""
    aggs = {"exposures": F.count("*"), "skips": F.count_if(F.col("progress") <= 2), "complete": F.count_if("complete")}
    aggs |= _longer("standing", "stand", 10, 20) | _longer("playback", "play", 5, 10) | {n: F.count_if(f) for n, f in _SESSION_FLAGS.items()}
    rate = F.when(F.col("rate") > 0, F.col("rate"))
    if s.isStreaming:
        return T.windowed(s, ["post_id"], size, slide, aggs | {"mean_rate": F.avg(rate)}, ts)
    parts = {n: T.Agg(a) for n, a in aggs.items()} | {"_rates": T.Agg(F.sum(rate)), "_n": T.Agg(F.count(rate))}
    out = T.paned(s, ["post_id"], T.seconds(size), T.seconds(slide), parts, ts)
    return out.withColumn("mean_rate", F.col("_rates") / F.nullif(F.col("_n"), F.lit(0))).drop("_rates", "_n")


def session_author_counts(s: DataFrame, size: str = "24 hours", slide: str = "60 minutes", ts: str = "session_time", cap: int | None = SESSION_CAP) -> DataFrame:
    """Fifteen counts of a user for each author, of the user's first ``cap`` sessions of a window."""
    aggs = {"exposures": F.count("*"), "skips": F.count_if(F.col("progress") <= 2)}
    aggs |= _longer("playback", "play", 8, 12) | _longer("standing", "stand", 10, 20) | {n: F.count_if(f) for n, f in (_SESSION_FLAGS | {"follow": "follow"}).items()}
    return _summed(s, ["uid", "author"], size, slide, aggs, cap, ["uid"], ts, "post_id")


_ROOM_EVENTS = {"enter": "enter_liveroom", "quit": "exit_liveroom", "gift": "liveroom_gift_send", "follow": "liveroom_follow_anchor", "chat": "liveroom_chat_message"}


def anchor_windows(live: DataFrame, size: str = "5 minutes", slide: str = "30 seconds", exact: bool = True) -> DataFrame:
    """Of an anchor: distinct users that enter, quit, give, follow, chat; coins; whole mean seconds stayed."""
    is_ = lambda e: F.col("event") == e
    sums = {"coins": F.col("coins"), "_stay": F.when(is_("exit_liveroom"), F.col("stay")).otherwise(0), "_quits": is_("exit_liveroom").cast("long")}
    users = {f"{n}_users": is_(e) for n, e in _ROOM_EVENTS.items()}
    if exact and not live.isStreaming:
        out = T.distinct_windows(live.filter(F.col("uid").isNotNull()), ["anchor_id"], size, slide, "uid", users, sums=sums, many=True)
    else:
        counts = {n: sketched(F.when(cond, F.col("uid")), 15) for n, cond in users.items()}
        out = T.windowed(live, ["anchor_id"], size, slide, counts | {n: F.sum(x) for n, x in sums.items()})
    mean = F.coalesce(F.floor(F.col("_stay") / F.nullif(F.col("_quits"), F.lit(0))), F.lit(0)).cast("long")
    return out.withColumn("mean_stay", mean).drop("_stay", "_quits")


def live_exposures(live: DataFrame, size: str = "5 minutes", slide: str = "10 seconds") -> DataFrame:
    return T.windowed(live.filter(F.col("event") == "live_exposure"), ["live_id"], size, slide, {"exposures": F.count("*")})


def user_anchor_windows(live: DataFrame, size: str = "15 minutes", slide: str = "30 seconds", cap: int | None = None) -> DataFrame:
    """Exposures, enters, watches of 6 seconds and seconds watched of a user and anchor, of a user's first ``cap`` events of a window."""
    watched = F.col("event").isin("live_view", "exit_liveroom")
    aggs = {
        "exposures": F.count_if(F.col("event") == "live_exposure"),
        "enters": F.count_if(F.col("event") == "enter_liveroom"),
        "watch_6s": F.count_if(watched & (F.col("watch") >= 6)),
        "watched": F.sum(F.when(watched, F.col("watch")).otherwise(0)),
    }
    return _summed(live, ["uid", "anchor_id"], size, slide, aggs, cap, ["uid"], "ts", "event_id")


def regroup_user_anchor(parts: DataFrame, keys: tuple[str, ...] = ("uid",)) -> DataFrame:
    """Partial user-anchor rows summed again, and exposures that no watch of 6 seconds followed."""
    s = parts.groupBy(*keys, "window_end").agg(*[F.sum(n).alias(n) for n in ("exposures", "enters", "watch_6s", "watched")])
    return s.withColumn("negative", F.greatest(F.lit(0).cast("long"), F.col("exposures") - F.col("watch_6s")))


def tag_recent_posts(tag_posts: DataFrame, size: str = "12 hours", slide: str = "10 minutes", k: int = 300, ts: str = "ts") -> DataFrame:
    """tag, window_end, items (id, time): the posts of a tag last updated, by the long column ``time``."""
    out = T.list_windows(tag_posts, ["tag"], T.seconds(size), T.seconds(slide), "post_id", F.col("time"), k, k, ts)
    return out.withColumn("items", F.transform("items", lambda x: F.struct(x["id"].alias("id"), x["value"].alias("time"))))


def user_live_windows(watches: DataFrame, size: str = "1 hour", slide: str = "5 minutes") -> DataFrame:
    """Events, distinct rooms, seconds watched, first and last time of a user."""
    if not watches.isStreaming:
        sums = {"events": F.lit(1), "watched": F.col("watch_time")}
        out = T.distinct_windows(watches, ["uid"], size, slide, "live_id", {"lives": F.lit(True)}, sums=sums, spanned=True)
        return out.select("uid", "window_start", "window_end", "events", "lives", "watched", "first_ts", "last_ts")
    return T.windowed(watches, ["uid"], size, slide, {"events": F.count("*"), "lives": F.count_distinct("live_id"), "watched": F.sum("watch_time"), "first_ts": F.min("ts"), "last_ts": F.max("ts")})


def last_three(watches: DataFrame, size: str = "1 hour", slide: str = "5 minutes") -> DataFrame:
    """A user's last three live events of a window as ``id:watch | id:watch | id:watch``."""
    r = topk.top_rows(T.assign(watches, size, slide), ["uid", "window_end"], [F.desc("ts"), F.asc("live_id"), F.asc("watch_time")], 3)
    items = F.sort_array(F.collect_list(F.struct("rank", F.concat_ws(":", F.col("live_id").cast("string"), F.col("watch_time").cast("string")).alias("t"))))
    return r.groupBy("uid", "window_end").agg(F.array_join(F.transform(items, lambda x: x["t"]), " | ").alias("last_events"))


def counts(df: DataFrame, *keys: str) -> DataFrame:
    """Exact count by key; with output mode ``update``, a running one in streams."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"))
