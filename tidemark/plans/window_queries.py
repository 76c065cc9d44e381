"""Registered queries on windows, lists, sessions and live events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import aggregates as A
from tidemark.operators import records as R
from tidemark.operators import topk
from tidemark.operators import windows as T
from tidemark.sources.sinks import shared_folder
from tidemark.streaming.panes import PaneTable
from tidemark.plans.domain import EV, LIVE, SESSIONS, acted_sql, events, live, post_events, tags, windows_sql

GAP = "6 hours"


def _end(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in ("window_start", "window_end")], F.unix_seconds("window_end").alias("window_end")) if not cols else df.select(*cols, F.unix_seconds("window_end").alias("window_end"))


def fixed(x, digits: int) -> Column:
    """A double in units of its last digit, as a long. The offset isn't a half, so that no rounding rule matters."""
    return F.floor((F.col(x) if isinstance(x, str) else x) * 10**digits + 0.3).cast("long")


def fixed_sql(x: str, digits: int) -> str:
    return f"CAST(floor(({x}) * {10**digits} + 0.3::DOUBLE) AS BIGINT)"


def _ids(items: str) -> Column:
    return F.array_join(F.transform(items, lambda x: x["id"].cast("string")), ",")


def item_window_counts(spark: SparkSession, d: str) -> DataFrame:
    return _end(A.item_windows(events(spark, d), exact=True))


_HAS = {"like": acted_sql(1), "follow": acted_sql(13), "profile": acted_sql(15), "interact": acted_sql(3, 5, 6)}
_ITEM = {"expose": "kind = 'expose'"} | {f"view_{s}s": f"kind = 'view' AND progress_time >= {s}" for s in A.VIEW_STEPS} | {f"stand_{s}s": f"kind = 'view' AND standing_time >= {s}" for s in A.STAND_STEPS} | _HAS
ITEM_WINDOW_SQL = f"WITH {EV}, {windows_sql(3600, 600)} SELECT post_id, window_end, " + ", ".join(f'count(DISTINCT CASE WHEN {c} THEN rec_token END) AS "{n}"' for n, c in _ITEM.items()) + " FROM w GROUP BY post_id, window_end"


def item_window_sketches(spark: SparkSession, d: str) -> DataFrame:
    return _end(A.item_panes(events(spark, d)))


def item_event_panes(spark: SparkSession, d: str) -> DataFrame:
    """Mergeable counters over a day that slides by 30 minutes, by panes."""
    p = T.paned(events(spark, d), ["post_id"], 86400, 1800, {"events": T.count_all(), "views": T.count_if(F.col("kind") == "view"), "longest": T.max_of("progress_time"), "first_id": T.min_of("event_id"), "id_sum": T.sum_of("event_id")})
    return _end(p)


def stored_pane_windows(spark: SparkSession, d: str) -> DataFrame:
    """The same from a table of panes that three batches, each with a third of the events, have filled."""
    aggs = {"events": T.count_all(), "views": T.count_if(F.col("kind") == "view"), "longest": T.max_of("progress_time"), "first_id": T.min_of("event_id"), "id_sum": T.sum_of("event_id")}
    kept = PaneTable(spark, shared_folder(spark, "panes"), ["post_id"], 1800, aggs, fanout=2)
    e = events(spark, d)
    for i in range(3):
        kept.writer()(e.filter(F.pmod(F.xxhash64("event_id"), F.lit(3)) == i), i)
    return _end(kept.windows(86400))


PANES_SQL = f"WITH {EV}, {windows_sql(86400, 1800)} SELECT post_id, window_end, count(*) AS events, count(*) FILTER (WHERE kind = 'view') AS views, max(progress_time) AS longest, min(event_id) AS first_id, CAST(sum(event_id) AS BIGINT) AS id_sum FROM w GROUP BY post_id, window_end"


def user_hour_counts(spark: SparkSession, d: str) -> DataFrame:
    return _end(A.user_counts(events(spark, d)))


USER_COUNTS_SQL = f"""WITH {EV}, {windows_sql(3600, 300)} SELECT uid, window_end, count(DISTINCT CASE WHEN kind = 'expose' THEN post_id END) AS exposed,
  count(DISTINCT CASE WHEN kind = 'view' AND progress_time >= 3 THEN post_id END) AS viewed, count(DISTINCT CASE WHEN kind = 'view' AND progress_time >= 3 AND post_type = 1 THEN post_id END) AS viewed_images,
  count(DISTINCT CASE WHEN kind = 'view' AND progress_time >= 3 AND post_type = 2 THEN post_id END) AS viewed_videos FROM w GROUP BY uid, window_end"""


def user_action_lists(spark: SparkSession, d: str) -> DataFrame:
    u = A.user_lists(events(spark, d), "24 hours", "30 minutes", show=lambda ids: F.array_join(ids, ","))
    return u.select("uid", "list", "items", F.unix_seconds("window_end").alias("window_end"))


_LISTED = {"like": (1,), "follow": (13,), "profile": (15,), "interact": (3, 5, 6)}


def _user_lists_sql(windows: str, source: str = "w") -> str:
    parts = [
        f"SELECT uid, window_end, ts, '{n}_{of}s' AS list, {ident} AS id FROM {source} WHERE {acted_sql(*codes)}"
        for n, codes in _LISTED.items() for of, ident in (("post", "post_id"), ("author", "author")) if (n, of) != ("interact", "author")
    ]
    return f"""WITH {EV}, {windows}, m AS ({" UNION ALL ".join(parts)}),
l AS (SELECT uid, window_end, list, id, max(ts) AS t FROM m GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY uid, window_end, list ORDER BY t DESC, id) AS n FROM l)
SELECT uid, window_end, list, string_agg(CAST(id AS VARCHAR), ',' ORDER BY n) AS items FROM r WHERE n <= 10 GROUP BY uid, window_end, list"""


def capped_user_lists(spark: SparkSession, d: str) -> DataFrame:
    """The same of a user's first six events of each window."""
    u = A.user_lists(events(spark, d), "24 hours", "6 hours", cap=6, show=lambda ids: F.array_join(ids, ","))
    return u.select("uid", "list", "items", F.unix_seconds("window_end").alias("window_end"))


_CAPPED = f"{windows_sql(86400, 21600)}, f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uid, window_end ORDER BY ts, event_id) AS no FROM w) WHERE no <= 6)"


def user_scored_lists(spark: SparkSession, d: str) -> DataFrame:
    score = lambda items: F.array_join(F.transform(items, lambda x: F.concat_ws(":", x["id"].cast("string"), F.floor(x["score"] * 100).cast("long").cast("string"))), ",")
    u = A.user_scored_lists(events(spark, d), "24 hours", "30 minutes", show=score)
    return u.select("uid", "list", "items", F.unix_seconds("window_end").alias("window_end"))


SCORED_SQL = f"""WITH {EV}, {windows_sql(86400, 1800)}, m AS (SELECT uid, window_end, 'view_3s' AS list, post_id, progress_time AS score FROM w WHERE kind = 'view' AND progress_time >= 3
  UNION ALL SELECT uid, window_end, 'stand_5s', post_id, standing_time FROM w WHERE kind = 'view' AND standing_time >= 5),
b AS (SELECT uid, window_end, list, post_id, max(score) AS score FROM m GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY uid, window_end, list ORDER BY score DESC, post_id) AS n FROM b)
SELECT uid, window_end, list, string_agg(concat(post_id, ':', CAST(floor(score * 100) AS BIGINT)), ',' ORDER BY n) AS items FROM r WHERE n <= 10 GROUP BY uid, window_end, list"""


def capped_user_windows(spark: SparkSession, d: str) -> DataFrame:
    c = A.capped_windows(events(spark, d), "24 hours", "6 hours", 5)
    return _end(c.groupBy("uid", "window_end").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids")))


CAPPED_SQL = f"""WITH {EV}, {windows_sql(86400, 21600)}, r AS (SELECT *, row_number() OVER (PARTITION BY uid, window_end ORDER BY ts, event_id) AS n FROM w)
SELECT uid, window_end, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM r WHERE n <= 5 GROUP BY uid, window_end"""


def capped_user_counts(spark: SparkSession, d: str) -> DataFrame:
    """Distinct posts of a user's first six events of each window."""
    return _end(A.user_counts(events(spark, d), "24 hours", "6 hours", cap=6))


_COUNTED = """count(DISTINCT CASE WHEN kind = 'expose' THEN post_id END) AS exposed, count(DISTINCT CASE WHEN kind = 'view' AND progress_time >= 3 THEN post_id END) AS viewed,
  count(DISTINCT CASE WHEN kind = 'view' AND progress_time >= 3 AND post_type = 1 THEN post_id END) AS viewed_images, count(DISTINCT CASE WHEN kind = 'view' AND progress_time >= 3 AND post_type = 2 THEN post_id END) AS viewed_videos"""
CAPPED_COUNTS_SQL = f"WITH {EV}, {_CAPPED} SELECT uid, window_end, {_COUNTED} FROM f GROUP BY uid, window_end"


def capped_user_authors(spark: SparkSession, d: str) -> DataFrame:
    """Distinct tokens by author of a user's first six events of each window."""
    return _end(A.user_author_windows(events(spark, d), "24 hours", "6 hours", keep_empty=True, cap=6))


def capped_user_anchors(spark: SparkSession, d: str) -> DataFrame:
    """Counts by anchor of a user's first four live events of each window."""
    return _end(A.user_anchor_windows(live(spark, d), "24 hours", "6 hours", cap=4))


def _author(spark: SparkSession, d: str, size: str, slide: str, keep: bool) -> DataFrame:
    return _end(A.user_author_windows(events(spark, d), size, slide, keep_empty=keep))


_AUTHOR = {k: v for k, v in _ITEM.items() if k.startswith(("view_", "stand_")) or k == "like"}


def _author_sql(size: int, slide: int, keep: bool) -> str:
    cols = ", ".join(f'count(DISTINCT CASE WHEN {c} THEN rec_token END) AS "{n}"' for n, c in _AUTHOR.items())
    sql = f"WITH {EV}, {windows_sql(size, slide)}, a AS (SELECT uid, author, window_end, {cols} FROM w GROUP BY uid, author, window_end) SELECT * FROM a"
    return sql if keep else sql + " WHERE " + " OR ".join(f'"{n}" > 0' for n in _AUTHOR)


CAPPED_AUTHORS_SQL = f"""WITH {EV}, {_CAPPED} SELECT uid, author, window_end, {", ".join(f'count(DISTINCT CASE WHEN {c} THEN rec_token END) AS "{n}"' for n, c in _AUTHOR.items())} FROM f GROUP BY uid, author, window_end"""


def user_author_hour(spark: SparkSession, d: str) -> DataFrame:
    return _author(spark, d, "1 hour", "5 minutes", False)


def user_author_day(spark: SparkSession, d: str) -> DataFrame:
    return _author(spark, d, "24 hours", "6 hours", True)


def user_author_maps(spark: SparkSession, d: str) -> DataFrame:
    """Author rows as one map by user, shown as text."""
    m = A.by_author(A.user_author_windows(events(spark, d), "24 hours", "12 hours"), ["uid", "window_end"], ["view_3s", "like"])
    text = F.array_join(F.transform(F.array_sort(F.map_entries("authors")), lambda e: F.concat_ws(":", e["key"], e["value"]["view_3s"].cast("string"), e["value"]["like"].cast("string"))), ",")
    return _end(m.withColumn("authors", text))


MAPS_SQL = f"""WITH {EV}, {windows_sql(86400, 43200)}, a AS (SELECT uid, author, window_end, {', '.join(f'count(DISTINCT CASE WHEN {c} THEN rec_token END) AS "{n}"' for n, c in _AUTHOR.items())} FROM w GROUP BY uid, author, window_end)
SELECT uid, window_end, string_agg(concat(author, ':', view_3s, ':', "like"), ',' ORDER BY CAST(author AS VARCHAR)) AS authors FROM a WHERE {' OR '.join(f'"{n}" > 0' for n in _AUTHOR)} GROUP BY uid, window_end"""


def sessions(spark: SparkSession, d: str) -> DataFrame:
    return A.post_sessions(post_events(spark, d), GAP)


_FLAGS = list(A.FLAGS)


def post_session_summaries(spark: SparkSession, d: str) -> DataFrame:
    rounded = [fixed(n, 6).alias(n) for n in ("standing", "playback", "rate")]
    times = [F.unix_micros("session_start").alias("start_us"), F.unix_micros("last_ts").alias("last_us")]
    return sessions(spark, d).select("uid", "rec_token", "post_id", "author", "progress", *times, *rounded, *_FLAGS)


SESSION_SQL = f"""WITH {SESSIONS} SELECT uid, rec_token, post_id, author, progress, epoch_us(start_ts) AS start_us, epoch_us(last_ts) AS last_us, {fixed_sql("standing", 6)} AS standing,
  {fixed_sql("playback", 6)} AS playback, {fixed_sql("rate", 6)} AS rate, {", ".join(f'"{n}"' for n in _FLAGS)} FROM s"""


def short_gap_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sessions of 70 seconds of an author's posts and of 20 seconds of an anchor's rooms."""
    shown = lambda s, gap, key: s.select(F.lit(gap).alias("gap"), F.col(key).alias("ident"), "n", "longest", F.unix_micros("session_start").alias("start_us"), F.unix_micros("session_end").alias("end_us"))
    e = T.sessions(events(spark, d), ["author"], "70 seconds", {"n": F.count("*"), "longest": F.max("progress_time")})
    v = T.sessions(live(spark, d), ["anchor_id"], "20 seconds", {"n": F.count("*"), "longest": F.max("watch").cast("double")})
    return shown(e, 70, "author").unionByName(shown(v, 20, "anchor_id"))


def _short_sql(source: str, key: str, gap: int, value: str) -> str:
    us = gap * 1_000_000
    return f"""SELECT {gap} AS gap, {key} AS ident, count(*) AS n, CAST(max({value}) AS DOUBLE) AS longest, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) + {us} AS end_us FROM (
  SELECT *, sum(fresh) OVER (PARTITION BY {key} ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS no FROM (
    SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY {key} ORDER BY ts, event_id) <= {us} THEN 0 ELSE 1 END AS fresh FROM {source})) GROUP BY {key}, no"""


SHORT_SQL = f"WITH {LIVE} {_short_sql('ev', 'author', 70, 'progress_time')} UNION ALL {_short_sql('live', 'anchor_id', 20, 'watch')}"


#: Sessions of a user that count in the windows of its lists and its authors: few, so that the cap bites.
CAP = 4


def session_user_day(spark: SparkSession, d: str) -> DataFrame:
    """All sessions of a user over a day, none cut off."""
    return _end(A.session_user_counts(sessions(spark, d), cap=None))


def _session_windows(slide: int) -> str:
    """``w``: sessions by window; ``f``: the first CAP of each user's window."""
    return f"""{windows_sql(86400, slide, 's', 'session_time')},
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uid, window_end ORDER BY session_time, post_id) AS no FROM w) WHERE no <= {CAP})"""


SESSION_USER_SQL = f"WITH {SESSIONS}, {windows_sql(86400, 3600, 's', 'session_time')} SELECT uid, window_end, count(*) AS exposures, count(*) FILTER (WHERE progress <= 2) AS skips FROM w GROUP BY uid, window_end"


def _scored_text(items: str) -> Column:
    one = lambda x: F.concat_ws(":", x["id"].cast("string"), fixed(x["score"], 2).cast("string"))
    return F.array_join(F.transform(items, one), ",")


def session_user_lists(spark: SparkSession, d: str) -> DataFrame:
    """The seventeen lists of a user over a day of sessions, latest first, with scores where they have them."""
    u = A.session_user_lists(sessions(spark, d), "24 hours", "6 hours", cap=CAP)
    return u.select("uid", "list", _scored_text("items").alias("items"), F.unix_seconds("window_end").alias("window_end"))


_GOOD = '("like" OR comment OR share OR follow OR "collect" OR profile OR paid)'
_BAD = "(report OR uninterested)"
#: list: id, condition, size, score
_SL = {
    "complete_play": ("post_id", "complete", 30, "NULL"),
    "skip": ("post_id", "progress <= 2", 30, "NULL"),
    "stand_10s": ("post_id", "standing > 10", 30, "standing"),
    "play_8s": ("post_id", "playback > 8", 30, "playback"),
    "like": ("post_id", '"like"', 10, "NULL"),
    "comment": ("post_id", "comment", 10, "NULL"),
    "share": ("post_id", "share", 10, "NULL"),
    "follow": ("post_id", "follow", 10, "NULL"),
    "collect": ("post_id", '"collect"', 10, "NULL"),
    "profile": ("post_id", "profile", 10, "NULL"),
    "pay": ("post_id", "paid", 10, "NULL"),
    "report": ("post_id", "report", 10, "NULL"),
    "dislike": ("post_id", "uninterested", 10, "NULL"),
    "positive": ("post_id", _GOOD, 20, "NULL"),
    "negative": ("post_id", _BAD, 20, "NULL"),
    "positive_authors": ("author", f"{_GOOD} AND author > 0", 20, "NULL"),
    "negative_authors": ("author", f"{_BAD} AND author > 0", 20, "NULL"),
}


def session_marks_sql(source: str, columns: str, skip: tuple[str, ...] = ()) -> str:
    """A row for each list that a session enters: columns, list, id, k, score."""
    parts = [f"SELECT {columns}, '{n}' AS list, {i} AS id, {k} AS k, CAST({x} AS DOUBLE) AS score FROM {source} WHERE {c}" for n, (i, c, k, x) in _SL.items() if n not in skip]
    return " UNION ALL ".join(parts)


_ENTRY = "concat(id, CASE WHEN score IS NULL THEN '' ELSE ':' || CAST(floor(score * 100 + 0.3::DOUBLE) AS BIGINT) END)"
SESSION_LISTS_SQL = f"""WITH {SESSIONS}, {_session_windows(21600)}, m AS ({session_marks_sql("f", "uid, window_end, session_time AS t")}),
l AS (SELECT uid, window_end, list, k, id, max(t) AS t, arg_max(score, t) AS score FROM m GROUP BY uid, window_end, list, k, id),
r AS (SELECT *, row_number() OVER (PARTITION BY uid, window_end, list ORDER BY t DESC, id) AS n FROM l)
SELECT uid, window_end, list, string_agg({_ENTRY}, ',' ORDER BY n) AS items FROM r WHERE n <= k GROUP BY uid, window_end, list"""

_ACTS = {"like": '"like"', "comment": "comment", "share": "share", "collect": '"collect"', "profile": "profile", "report": "report", "dislike": "uninterested", "pay": "paid"}
_POST = {"exposures": "true", "skips": "progress <= 2", "complete": "complete", "stand_10s": "standing > 10", "stand_20s": "standing > 20", "play_5s": "playback > 5", "play_10s": "playback > 10"} | _ACTS
_PAIR = {"exposures": "true", "skips": "progress <= 2", "play_8s": "playback > 8", "play_12s": "playback > 12", "stand_10s": "standing > 10", "stand_20s": "standing > 20", "follow": "follow"} | _ACTS


def _counts_sql(conds: dict[str, str]) -> str:
    return ", ".join(f'count(*) FILTER (WHERE {c}) AS "{n}"' for n, c in conds.items())


def session_post_day(spark: SparkSession, d: str) -> DataFrame:
    return _end(A.session_post_counts(sessions(spark, d))).withColumn("mean_rate", F.coalesce(fixed("mean_rate", 8), F.lit(-1)))


SESSION_POST_SQL = f"""WITH {SESSIONS}, {windows_sql(86400, 3600, 's', 'session_time')}
SELECT post_id, window_end, {_counts_sql(_POST)}, coalesce({fixed_sql("avg(CASE WHEN rate > 0 THEN rate END)", 8)}, -1) AS mean_rate FROM w GROUP BY post_id, window_end"""


def session_author_day(spark: SparkSession, d: str) -> DataFrame:
    return _end(A.session_author_counts(sessions(spark, d), "24 hours", "6 hours", cap=CAP))


SESSION_AUTHOR_SQL = f"WITH {SESSIONS}, {_session_windows(21600)} SELECT uid, author, window_end, {_counts_sql(_PAIR)} FROM f GROUP BY uid, author, window_end"


def anchor_window_counts(spark: SparkSession, d: str) -> DataFrame:
    return _end(A.anchor_windows(live(spark, d), "15 minutes", "90 seconds"))


def _anchor_sql(size: int, slide: int) -> str:
    u = lambda e: f"count(DISTINCT CASE WHEN event = '{e}' THEN uid END)"
    return f"""WITH {LIVE}, {windows_sql(size, slide, 'live')} SELECT anchor_id, window_end, {u('enter_liveroom')} AS enter_users, {u('exit_liveroom')} AS quit_users, {u('liveroom_gift_send')} AS gift_users, {u('liveroom_follow_anchor')} AS follow_users,
    {u('liveroom_chat_message')} AS chat_users, CAST(sum(coins) AS BIGINT) AS coins, CAST(coalesce(floor(avg(CASE WHEN event = 'exit_liveroom' THEN stay END)), 0) AS BIGINT) AS mean_stay FROM w GROUP BY anchor_id, window_end"""


def live_room_exposures(spark: SparkSession, d: str) -> DataFrame:
    return _end(A.live_exposures(live(spark, d)))


LIVE_EXPOSURE_SQL = f"WITH {LIVE}, x AS (SELECT * FROM live WHERE event = 'live_exposure'), {windows_sql(300, 10, 'x')} SELECT live_id, window_end, count(*) AS exposures FROM w GROUP BY live_id, window_end"


def user_anchor_quarter(spark: SparkSession, d: str) -> DataFrame:
    return _end(A.user_anchor_windows(live(spark, d)))


_UA = """count(*) FILTER (WHERE event = 'live_exposure') AS exposures, count(*) FILTER (WHERE event = 'enter_liveroom') AS enters, count(*) FILTER (WHERE event IN ('live_view', 'exit_liveroom') AND watch >= 6) AS watch_6s,
  CAST(sum(CASE WHEN event IN ('live_view', 'exit_liveroom') THEN watch ELSE 0 END) AS BIGINT) AS watched"""
USER_ANCHOR_SQL = f"WITH {LIVE}, {windows_sql(900, 30, 'live')} SELECT uid, anchor_id, window_end, {_UA} FROM w GROUP BY uid, anchor_id, window_end"


CAPPED_ANCHORS_SQL = f"""WITH {LIVE}, {windows_sql(86400, 21600, 'live')}, f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uid, window_end ORDER BY ts, event_id) AS no FROM w) WHERE no <= 4)
SELECT uid, anchor_id, window_end, {_UA} FROM f GROUP BY uid, anchor_id, window_end"""


def user_anchor_regrouped(spark: SparkSession, d: str) -> DataFrame:
    return _end(A.regroup_user_anchor(A.user_anchor_windows(live(spark, d), "24 hours", "6 hours")))


REGROUP_SQL = f"WITH {LIVE}, {windows_sql(86400, 21600, 'live')}, t AS (SELECT uid, window_end, {_UA} FROM w GROUP BY uid, window_end) SELECT *, greatest(0, exposures - watch_6s) AS negative FROM t"


def tag_recent_posts(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d)
    t = tags(spark, d).select("post_id", F.explode(F.split("tags", ",")).alias("tag"))
    rows = e.join(t, "post_id").select("tag", "post_id", "ts", F.unix_micros("ts").alias("time"))
    r = A.tag_recent_posts(rows, "12 hours", "3 hours", 20)
    return r.select("tag", _ids("items").alias("items"), F.unix_seconds("window_end").alias("window_end"))


TAG_RECENT_SQL = f"""WITH {EV}, t AS (SELECT DISTINCT post_id, 'content#c' || (k % 7) AS tag FROM ev UNION ALL SELECT DISTINCT post_id, 'restricted#' || CASE k % 5 WHEN 0 THEN 'clean' WHEN 1 THEN 'mid' WHEN 2 THEN 'high' WHEN 3 THEN 'explicit' ELSE 'other' END FROM ev),
j AS (SELECT t.tag, ev.post_id, ev.ts FROM ev JOIN t ON ev.post_id = t.post_id), {windows_sql(43200, 10800, 'j')}, l AS (SELECT tag, window_end, post_id, max(ts) AS t FROM w GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY tag, window_end ORDER BY t DESC, post_id) AS n FROM l) SELECT tag, window_end, string_agg(CAST(post_id AS VARCHAR), ',' ORDER BY n) AS items FROM r WHERE n <= 20 GROUP BY tag, window_end"""


def _watches(spark: SparkSession, d: str) -> DataFrame:
    return live(spark, d).select("uid", "live_id", F.col("watch").alias("watch_time"), "ts")


def user_live_hour(spark: SparkSession, d: str) -> DataFrame:
    u = A.user_live_windows(_watches(spark, d))
    return _end(u.withColumn("first_us", F.unix_micros("first_ts")).withColumn("last_us", F.unix_micros("last_ts")).drop("first_ts", "last_ts"))


USER_LIVE_SQL = f"WITH {LIVE}, {windows_sql(3600, 300, 'live')} SELECT uid, window_end, count(*) AS events, count(DISTINCT live_id) AS lives, CAST(sum(watch) AS BIGINT) AS watched, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us FROM w GROUP BY uid, window_end"


def user_last_three(spark: SparkSession, d: str) -> DataFrame:
    return _end(A.last_three(_watches(spark, d), "24 hours", "6 hours"))


LAST_THREE_SQL = f"""WITH {LIVE}, {windows_sql(86400, 21600, 'live')}, r AS (SELECT *, row_number() OVER (PARTITION BY uid, window_end ORDER BY ts DESC, live_id, watch) AS n FROM w)
SELECT uid, window_end, string_agg(concat(live_id, ':', watch), ' | ' ORDER BY n) AS last_events FROM r WHERE n <= 3 GROUP BY uid, window_end"""


def whole_stream_windows(spark: SparkSession, d: str) -> DataFrame:
    """Windows without keys."""
    return _end(T.windowed(events(spark, d), [], "1 hour", "30 minutes", {"events": F.count("*"), "users": F.count_distinct("uid")}))


WHOLE_SQL = f"WITH {EV}, {windows_sql(3600, 1800)} SELECT window_end, count(*) AS events, count(DISTINCT uid) AS users FROM w GROUP BY window_end"


def event_type_counts(spark: SparkSession, d: str) -> DataFrame:
    return A.counts(events(spark, d), "event_type", "post_type")


def last_distinct_posts(spark: SparkSession, d: str) -> DataFrame:
    r = topk.last_distinct(events(spark, d), "uid", "post_id", "ts", 30, 2)
    return r.select("uid", "post_id", F.unix_micros("first_ts").alias("first_us"), "rank")


LAST_DISTINCT_SQL = f"""WITH {EV}, f AS (SELECT uid, post_id, min(ts) AS t FROM ev GROUP BY ALL), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY uid ORDER BY t DESC, post_id) AS INTEGER) AS rank FROM f),
n AS (SELECT uid FROM r WHERE rank <= 30 GROUP BY uid HAVING count(*) >= 2) SELECT r.uid, post_id, epoch_us(t) AS first_us, rank FROM r JOIN n ON r.uid = n.uid WHERE rank <= 30"""

def item_feature_records(spark: SparkSession, d: str) -> DataFrame:
    """The last window of each item as a keyed JSON record."""
    w = T.paned(events(spark, d), ["post_id"], 86400, 1800, {"events": T.count_all(), "views": T.count_if(F.col("kind") == "view")})
    last = topk.top_rows(w, ["post_id"], [F.desc("window_end")], 1)
    return R.as_text(R.records(last, "item_24h", ["events", "views"])).select("key", "value", "ttl_s")


RECORDS_SQL = f"""WITH {EV}, {windows_sql(86400, 1800)}, g AS (SELECT post_id, window_end, count(*) AS events, count(*) FILTER (WHERE kind = 'view') AS views FROM w GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY window_end DESC) AS n FROM g)
SELECT 'rec:item_feature:{{' || post_id || '}}:post24h' AS key, concat('{{"events":', events, ',"views":', views, '}}') AS value, 7200 AS ttl_s FROM r WHERE n = 1"""


def user_author_records(spark: SparkSession, d: str) -> DataFrame:
    """Hash entries of a user's authors over the last day of theirs."""
    a = A.user_author_windows(events(spark, d), "24 hours", "24 hours", keep_empty=True)
    last = a.groupBy("uid").agg(F.max("window_end").alias("_last")).withColumnRenamed("uid", "_u")
    a = a.join(last, (F.col("uid") == F.col("_u")) & (F.col("window_end") == F.col("_last")))
    return R.as_text(R.hash_records(a, "user_author_24h", "author", ["view_3s", "like"])).select("key", "field", "value", "ttl_s")


AUTHOR_RECORDS_SQL = f"""WITH {EV}, day AS (SELECT *, epoch_us(ts) // 86400000000 AS d, max(epoch_us(ts) // 86400000000) OVER (PARTITION BY uid) AS top FROM ev),
x AS (SELECT uid, author, count(DISTINCT CASE WHEN kind = 'view' AND progress_time >= 3 THEN rec_token END) AS v, count(DISTINCT CASE WHEN {acted_sql(1)} THEN rec_token END) AS l FROM day WHERE d = top GROUP BY uid, author)
SELECT 'rec:user_author_feature:{{' || uid || '}}:post24h' AS key, CAST(author AS VARCHAR) AS field, concat('{{"view_3s":', v, ',"like":', l, '}}') AS value, 7200 AS ttl_s FROM x"""

QUERIES = {
    "short_gap_sessions": short_gap_sessions,
    "capped_user_counts": capped_user_counts, "capped_user_authors": capped_user_authors, "capped_user_anchors": capped_user_anchors,
    "item_feature_records": item_feature_records, "user_author_records": user_author_records,
    "item_window_counts": item_window_counts, "item_window_sketches": item_window_sketches, "item_event_panes": item_event_panes, "stored_pane_windows": stored_pane_windows, "user_hour_counts": user_hour_counts, "user_action_lists": user_action_lists, "capped_user_lists": capped_user_lists, "user_scored_lists": user_scored_lists, "capped_user_windows": capped_user_windows,
    "user_author_hour": user_author_hour, "user_author_day": user_author_day, "user_author_maps": user_author_maps, "post_session_summaries": post_session_summaries, "session_user_day": session_user_day, "session_user_lists": session_user_lists, "session_post_day": session_post_day,
    "session_author_day": session_author_day, "anchor_window_counts": anchor_window_counts, "live_room_exposures": live_room_exposures, "user_anchor_quarter": user_anchor_quarter, "user_anchor_regrouped": user_anchor_regrouped, "tag_recent_posts": tag_recent_posts, "user_live_hour": user_live_hour,
    "user_last_three": user_last_three, "whole_stream_windows": whole_stream_windows, "event_type_counts": event_type_counts, "last_distinct_posts": last_distinct_posts,
}
SQL = {
    "short_gap_sessions": SHORT_SQL,
    "capped_user_counts": CAPPED_COUNTS_SQL, "capped_user_authors": CAPPED_AUTHORS_SQL, "capped_user_anchors": CAPPED_ANCHORS_SQL,
    "item_feature_records": RECORDS_SQL, "user_author_records": AUTHOR_RECORDS_SQL,
    "item_window_counts": ITEM_WINDOW_SQL, "item_event_panes": PANES_SQL, "stored_pane_windows": PANES_SQL, "user_hour_counts": USER_COUNTS_SQL, "user_action_lists": _user_lists_sql(windows_sql(86400, 1800)), "capped_user_lists": _user_lists_sql(_CAPPED, "f"), "user_scored_lists": SCORED_SQL, "capped_user_windows": CAPPED_SQL, "user_author_hour": _author_sql(3600, 300, False), "user_author_day": _author_sql(86400, 21600, True),
    "user_author_maps": MAPS_SQL, "post_session_summaries": SESSION_SQL, "session_user_day": SESSION_USER_SQL, "session_user_lists": SESSION_LISTS_SQL, "session_post_day": SESSION_POST_SQL, "session_author_day": SESSION_AUTHOR_SQL, "anchor_window_counts": _anchor_sql(900, 90), "live_room_exposures": LIVE_EXPOSURE_SQL,
    "user_anchor_quarter": USER_ANCHOR_SQL, "user_anchor_regrouped": REGROUP_SQL, "tag_recent_posts": TAG_RECENT_SQL, "user_live_hour": USER_LIVE_SQL, "user_last_three": LAST_THREE_SQL, "whole_stream_windows": WHOLE_SQL, "event_type_counts": f"WITH {EV} SELECT event_type, post_type, count(*) AS n FROM ev GROUP BY ALL",
    "last_distinct_posts": LAST_DISTINCT_SQL,
}
