"""JSON events to typed rows. Input: a string column; bad JSON and rows without valid ids are dropped."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions.scalars import c
from tidemark.operators import filters as P

NO_INTS = "cast(array() as array<int>)"
#: Names of client events (fixed values of the event format).
EXPOSURE, VIDEO, IMAGE, COLLECT, PROMPT_NO = "postExposure", "videoPlayDuration", "imagePlay", "collect_page_click", "prompt_recommendation_click_no"
SINGLE_EVENTS = {
    "videoPlayComplete": "complete",
    "postLikeButtonClicked": "like",
    "postCommentSucceed": "comment",
    "postShare": "share",
    "postFollow": "follow",
    "postClickNickname": "profile",
    "postSwipeRight": "profile",
    "postClickAvatar": "profile",
    "postReportClick": "report",
    "postUninterestedClick": "uninterested",
    "post_paid_unlock_entry_show": "paid",
}
LIVE_EVENTS = ("live_exposure", "live_view", "enter_liveroom", "exit_liveroom", "liveroom_chat_message", "liveroom_gift_send", "liveroom_follow_anchor")
FLAGS = ("complete", "like", "comment", "share", "collect", "follow", "profile", "report", "uninterested", "paid")


def _read(df: DataFrame, kind: str, ddl: str, value: str) -> DataFrame:
    n = S.EVENT_TYPES[kind]
    return df.filter(P.maybe_event_type(value, n)).withColumn("j", F.from_json(c(value), ddl)).filter(F.col("j.event_type") == n)


def exposures(df: DataFrame, value: str = "value") -> DataFrame:
    """A feature event for each exposed post."""
    d = _read(df, "post_expose", S.POST_EXPOSE, value).select("j.post_expose.*").filter(P.valid_ids("uid", "created_at"))
    d = d.select("uid", "created_at", F.explode("list").alias("x")).withColumn("post_id", F.col("x.post_id").try_cast("long")).filter(P.valid_ids("post_id"))
    return d.select(
        "uid", "post_id", F.lit(None).cast("long").alias("author"), F.coalesce("x.rec_token", F.lit("")).alias("rec_token"), F.lit("expose").alias("kind"), F.lit(None).cast("int").alias("post_type"),
        F.lit(0.0).alias("standing_time"), F.lit(0.0).alias("progress_time"), F.expr(NO_INTS).alias("interactions"), F.timestamp_seconds("created_at").alias("ts"),
    )


def views(df: DataFrame, value: str = "value") -> DataFrame:
    """A feature event for each viewed post, with its interactions."""
    d = _read(df, "post_view", S.POST_VIEW, value).select("j.post_view.*").filter(P.valid_ids("uid", "created_at"))
    d = d.select("uid", "created_at", F.explode("list").alias("x")).withColumn("post_id", F.col("x.post_id").try_cast("long")).filter(P.valid_ids("post_id"))
    return d.select(
        "uid", "post_id", F.col("x.author").alias("author"), F.coalesce("x.rec_token", F.lit("")).alias("rec_token"), F.lit("view").alias("kind"), F.col("x.post_type").alias("post_type"),
        F.coalesce(F.col("x.standing_time").cast("double"), F.lit(0.0)).alias("standing_time"), F.coalesce(F.col("x.progress_time").cast("double"), F.lit(0.0)).alias("progress_time"),
        F.coalesce("x.interaction", F.expr(NO_INTS)).alias("interactions"), F.timestamp_seconds("created_at").alias("ts"),
    )


def feature_events(df: DataFrame, value: str = "value") -> DataFrame:
    return exposures(df, value).unionByName(views(df, value))


def exposure_rows(df: DataFrame, value: str = "value") -> DataFrame:
    """Exposed items with their device columns; missing indexes are empty texts."""
    d = _read(df, "post_expose", S.POST_EXPOSE, value).select("j.post_expose.*").select("uid", "created_at", *S.DEVICE_FIELDS, F.explode("list").alias("x"))
    return d.select("uid", "created_at", F.col("x.post_id").alias("post_id"), F.col("x.exposed_pos").alias("exposed_pos"), F.col("x.expo_time").alias("expo_time"), F.col("x.rec_token").alias("rec_token"), F.coalesce("x.from_index", F.lit("")).alias("from_index"), F.coalesce("x.dest_index", F.lit("")).alias("dest_index"), *S.DEVICE_FIELDS)


def tag_list(content) -> Column:
    """Distinct tags of a content value as JSON text: an object's keys, an array's texts or its objects' keys, or a plain text."""
    t = F.trim(c(content))
    keys = F.map_keys(F.from_json(t, "map<string,string>"))
    items = F.from_json(t, "array<string>")
    inner = F.flatten(F.transform(items, lambda x: F.when(x.startswith("{"), F.map_keys(F.from_json(x, "map<string,string>"))).otherwise(F.array(x))))
    found = F.when(t.startswith("{"), keys).when(t.startswith("["), inner).otherwise(F.array(t))
    return F.array_distinct(F.filter(found, lambda x: x.isNotNull() & (F.trim(x) != "")))


def content_tags(df: DataFrame, as_of, value: str = "value") -> DataFrame:
    """post_id, access_level, access_level_time, tags of fresh tag events."""
    d = _read(df, "content_tag", S.CONTENT_TAG, value).select("j.ai_post_tag_event.*").filter(P.valid_ids("post_id") & P.tag_is_fresh("access_level", "access_level_time", as_of))
    return d.select("post_id", "access_level", "access_level_time", tag_list("results.tags.content").alias("tags")).filter(P.not_empty("tags"))


def tag_posts(tags: DataFrame) -> DataFrame:
    """A row for each tag of a post."""
    return tags.select(F.explode("tags").alias("tag"), "post_id", F.col("access_level_time").alias("time"))


def valid_posts(df: DataFrame, as_of, value: str = "value") -> DataFrame:
    d = _read(df, "valid_post", S.VALID_POST, value).select("j.rec_valid_post_event.*").withColumn("post_id", F.col("id").try_cast("long"))
    return d.filter(P.valid_ids("post_id", "uid") & P.post_is_fresh("created_at", "deleted_at", as_of)).select("post_id", "uid", "tagging_at", "created_at", "updated_at")


def client_log(df: DataFrame, value: str = "value", ingest_ts: str | None = None) -> DataFrame:
    """event, data (JSON text), uid, ts; without a timestamp, the time of ingestion."""
    d = _read(df, "client_log", S.CLIENT_LOG, value)
    spare = F.col(ingest_ts) if ingest_ts else F.lit(None).cast("timestamp")
    d = d.select(F.col("j.user_event_log.event").alias("event"), F.trim(F.col("j.user_event_log.event_data")).alias("data"), F.col("j.user_event_log.uid").alias("uid"), F.coalesce(F.timestamp_millis(F.col("j.user_event_log.timestamp")), spare).alias("ts"))
    return d.filter(F.col("event").isNotNull() & (F.coalesce("data", F.lit("")) != "") & (F.col("data") != "null"))


def client_lists(log: DataFrame) -> DataFrame:
    """Client events that list posts. An exposure lists ``posts`` and has their length alone, plays list ``list``;
    only videos have a playback time. The user is the data's."""
    d = log.filter(F.col("event").isin(EXPOSURE, VIDEO, IMAGE)).withColumn("j", F.from_json("data", S.CLIENT_LIST))
    shown = F.col("event") == EXPOSURE
    d = d.withColumn("items", F.when(shown, F.col("j.posts")).otherwise(F.col("j.list")))
    d = d.select("event", F.col("j.userId").alias("uid"), "ts", F.explode("items").alias("x")).filter(P.is_client_post(F.col("x")))
    d = d.withColumn("post_id", F.col("x.post_id").try_cast("long")).filter(P.valid_ids("uid", "post_id"))

    def number(name: str, known: Column) -> Column:
        return F.when(known, F.coalesce(F.col(f"x.{name}"), F.lit(0.0))).otherwise(F.lit(0.0)).alias(name)

    return d.select(
        "event", "uid", "post_id", F.when(shown, F.lit(0)).otherwise(F.coalesce("x.author", F.lit(0))).cast("long").alias("author"),
        F.col("x.rec_token").alias("rec_token"), F.col("x.post_type").alias("post_type"),
        number("length", F.lit(True)), number("standing_time", ~shown), number("progress_time", ~shown), number("playback_time", F.col("event") == VIDEO),
        *[F.lit(False).alias(f) for f in FLAGS], "ts",
    )


def _no_times() -> list[Column]:
    return [F.lit(0.0).alias(n) for n in ("length", "standing_time", "progress_time", "playback_time")]


def client_singles(log: DataFrame) -> DataFrame:
    """Client events about one post, as flags. ``unlike`` isn't a like. The user is the data's."""
    d = log.filter(F.col("event").isin(*SINGLE_EVENTS)).withColumn("j", F.from_json("data", S.CLIENT_SINGLE)).filter(P.is_client_post(F.col("j")))
    d = d.withColumn("uid", F.col("j.userId")).withColumn("post_id", F.col("j.post_id").try_cast("long")).filter(P.valid_ids("uid", "post_id"))
    flags = {f: F.col("event").isin(*[e for e, g in SINGLE_EVENTS.items() if g == f]) if f in SINGLE_EVENTS.values() else F.lit(False) for f in FLAGS}
    flags["like"] = flags["like"] & (F.coalesce("j.action", F.lit("")) != "unlike")
    return d.select(
        "event", "uid", "post_id", F.coalesce("j.author_id", F.lit(0)).alias("author"), F.col("j.rec_token").alias("rec_token"),
        F.col("j.post_type").alias("post_type"), *_no_times(), *[v.alias(k) for k, v in flags.items()], "ts",
    )


def client_collects(log: DataFrame) -> DataFrame:
    """Collections: the source is the post, there is no token."""
    d = log.filter(F.col("event") == COLLECT).withColumn("j", F.from_json("data", S.CLIENT_COLLECT)).filter(F.col("j.action_type") == 1)
    d = d.withColumn("uid", F.col("j.userId")).filter(P.valid_ids("uid", "j.source"))
    return d.select(
        "event", "uid", F.col("j.source").alias("post_id"), F.lit(0).cast("long").alias("author"), F.lit("").alias("rec_token"),
        F.lit(None).cast("int").alias("post_type"), *_no_times(), *[F.lit(f == "collect").alias(f) for f in FLAGS], "ts",
    )


def client_posts(log: DataFrame, refusals: bool = False) -> DataFrame:
    """What :func:`client_lists`, :func:`client_singles` and :func:`client_collects` give, and with ``refusals`` :func:`prompt_no` as
    :func:`refusals_as_posts`, in one pass: the log is read once, and a row's data is parsed by its own family's schema alone."""
    event, data = F.col("event"), F.col("data")
    of = {"_l": (event.isin(EXPOSURE, VIDEO, IMAGE), S.CLIENT_LIST), "_s": (event.isin(*SINGLE_EVENTS), S.CLIENT_SINGLE), "_c": (event == COLLECT, S.CLIENT_COLLECT), "_r": (event == PROMPT_NO, S.CLIENT_PROMPT_NO)}
    if not refusals:
        del of["_r"]
    d = log.filter(reduce(lambda a, b: a | b, (cond for cond, _ in of.values()))).select("event", "uid", "ts", *[F.when(cond, F.from_json(data, ddl)).alias(n) for n, (cond, ddl) in of.items()])
    shown, numbers = event == EXPOSURE, ("length", "standing_time", "progress_time", "playback_time")

    def post(uid: Column, post_id: Column, author: Column, token: Column, post_type: Column, times: dict[str, Column], flags: dict[str, Column]) -> Column:
        fields = {"uid": uid.cast("long"), "post_id": post_id, "author": author.cast("long"), "rec_token": token, "post_type": post_type.cast("int")}
        fields |= {n: times.get(n, F.lit(0.0)) for n in numbers} | {f: flags.get(f, F.lit(False)) for f in FLAGS}
        return F.struct(*[x.alias(n) for n, x in fields.items()])

    def listed(x: Column) -> Column:
        known = {"length": F.lit(True), "standing_time": ~shown, "progress_time": ~shown, "playback_time": event == VIDEO}
        times = {n: F.when(cond, F.coalesce(x[n], F.lit(0.0))).otherwise(F.lit(0.0)) for n, cond in known.items()}
        return post(F.col("_l.userId"), x["post_id"].try_cast("long"), F.when(shown, F.lit(0)).otherwise(F.coalesce(x["author"], F.lit(0))), x["rec_token"], x["post_type"], times, {})

    flags = {f: event.isin(*[e for e, g in SINGLE_EVENTS.items() if g == f]) for f in FLAGS if f in SINGLE_EVENTS.values()}
    flags["like"] = flags["like"] & (F.coalesce("_s.action", F.lit("")) != "unlike")
    none = F.lit(None)
    single = post(F.col("_s.userId"), F.col("_s.post_id").try_cast("long"), F.coalesce("_s.author_id", F.lit(0)), F.col("_s.rec_token"), F.col("_s.post_type"), {}, flags)
    collect = post(F.col("_c.userId"), F.col("_c.source"), F.lit(0), F.lit(""), none, {}, {"collect": F.lit(True)})
    found = F.when(of["_l"][0], F.transform(F.filter(F.when(shown, F.col("_l.posts")).otherwise(F.col("_l.list")), P.is_client_post), listed))
    found = found.when(of["_s"][0] & P.is_client_post(F.col("_s")), F.array(single)).when(of["_c"][0] & (F.col("_c.action_type") == 1), F.array(collect))
    if refusals:
        uid = F.coalesce(F.when(F.col("uid") > 0, F.col("uid")), F.col("_r.userId").try_cast("long"))
        refused = post(uid, F.col("_r.post_id").try_cast("long"), F.lit(0), F.coalesce("_r.rec_token", F.lit("")), none, {}, {"uninterested": F.lit(True)})
        found = found.when(of["_r"][0], F.array(refused))
    d = d.select("event", "ts", F.explode(found).alias("_p")).select("event", "_p.*", "ts")
    return d.filter(P.valid_ids("uid", "post_id"))


def prompt_no(log: DataFrame) -> DataFrame:
    """Refusals of a prompt; the user is the envelope's, else the data's."""
    d = log.filter(F.col("event") == PROMPT_NO).withColumn("j", F.from_json("data", S.CLIENT_PROMPT_NO))
    uid = F.coalesce(F.when(F.col("uid") > 0, F.col("uid")), F.col("j.userId").try_cast("long"))
    d = d.withColumn("uid", uid).withColumn("post_id", F.col("j.post_id").try_cast("long")).filter(P.valid_ids("uid", "post_id"))
    return d.select("event", "uid", "post_id", F.coalesce("j.rec_token", F.lit("")).alias("rec_token"), "ts")


def refusals_as_posts(refusals: DataFrame) -> DataFrame:
    """Refusals in the columns of client posts, as not interested."""
    flags = [F.lit(f == "uninterested").alias(f) for f in FLAGS]
    return refusals.select("event", "uid", "post_id", F.lit(0).cast("long").alias("author"), "rec_token", F.lit(None).cast("int").alias("post_type"), *_no_times(), *flags, "ts")


def client_to_views(posts: DataFrame, codes: dict[str, int] | None = None) -> DataFrame:
    """Client events as feature events, their flags as interaction codes; a refused prompt has its own code besides
    that of not interested."""
    k = S.CLIENT_CODES | (codes or {})
    marks = [F.when(F.col(f), k[f]) for f in k if f in FLAGS] + [F.when(F.col("uninterested") & (F.col("event") == PROMPT_NO), k["prompt_no"])]
    kind = F.when(F.col("event") == EXPOSURE, "expose").otherwise("view")
    inter = F.array_compact(F.array(*marks)).cast("array<int>")
    return posts.select("uid", "post_id", "author", "rec_token", kind.alias("kind"), "post_type", "standing_time", "progress_time", inter.alias("interactions"), "ts")


def live_events(log: DataFrame, names: tuple[str, ...] = LIVE_EVENTS) -> DataFrame:
    """Events of live rooms by name; ``watch`` is a view's watch time or an exit's stay, ``stay`` an exit's alone, and
    coins are a gift's price times its count. User and anchor are the data's."""
    d = log.filter(F.col("event").isin(*names)).withColumn("j", F.from_json("data", S.CLIENT_LIVE)).withColumn("uid", F.col("j.uid")).filter(P.valid_ids("uid", "j.anchor_id"))
    of = lambda event, value: F.when(F.col("event") == event, F.coalesce(value, F.lit(0)))
    stay = of("exit_liveroom", F.col("j.stay_duration"))
    coins = of("liveroom_gift_send", F.col("j.gift_price") * F.col("j.gift_count")).cast("long")
    return d.select(
        "event", "uid", *[F.col(f"j.{n}").alias(n) for n in ("live_id", "anchor_id", "scene", "from_scene")],
        F.coalesce(stay, of("live_view", F.col("j.watch_duration")), F.lit(0)).alias("watch"), F.coalesce(stay, F.lit(0)).alias("stay"),
        F.coalesce(coins, F.lit(0)).alias("coins"), F.coalesce("j.rec_token", F.lit("")).alias("rec_token"), "ts",
    )


def live_watches(df: DataFrame, value: str = "value") -> DataFrame:
    """Plain watch events with an ISO time in UTC."""
    d = df.select(F.from_json(c(value), S.LIVE_WATCH).alias("j")).select("j.*")
    return d.filter(F.coalesce("uid", F.lit("")) != "").select("uid", "live_id", F.coalesce("watch_time", F.lit(0)).alias("watch_time"), F.coalesce(F.expr("try_to_timestamp(event_time)"), F.expr("try_to_timestamp(raw_event_time)")).alias("ts")).filter(F.col("ts").isNotNull())


def feedback(events: DataFrame, short: float = 3.0, long: float = 10.0) -> DataFrame:
    """Views as feedback: report and not-interested each count; one played for less than ``short`` (but above 0)
    without either is short; one played for ``long`` seconds or more is positive. A view can yield several."""
    has = lambda n: F.array_contains("interactions", S.CODES[n])
    played = F.col("progress_time")
    kinds = F.array_compact(F.array(
        F.when(has("report"), F.lit("report")),
        F.when(has("uninterested"), F.lit("uninterested")),
        F.when(~has("report") & ~has("uninterested") & (played > 0) & (played < short), F.lit("short")),
        F.when(played >= long, F.lit("positive")),
    ))
    return events.filter(F.col("kind") == "view").select("uid", "post_id", "author", "progress_time", "ts", F.explode(kinds).alias("feedback"))


def short_views(events: DataFrame, short: float = 3.0) -> DataFrame:
    """Short views whatever their interactions, as feedback."""
    played = F.col("progress_time")
    return events.filter((F.col("kind") == "view") & (played > 0) & (played < short)).select("uid", "post_id", "author", "progress_time", "ts", F.lit("short").alias("feedback"))


def interaction_flags(events: DataFrame, long_play: float = 3.0, long_stand: float = 5.0) -> DataFrame:
    """Feature events with a flag for each scored action. A long view is one played or stood at for long; downloads and
    forwards have no code here."""
    has = lambda n: F.array_contains("interactions", S.CODES[n])
    return events.withColumns({
        "click": F.col("kind") == "view",
        "long_view": (F.col("progress_time") >= long_play) | (F.col("standing_time") >= long_stand),
        "like": has("like"), "follow": has("follow"), "profile": has("profile"), "favorite": has("collect"), "comment": has("comment"), "share": has("share"),
        "download": F.lit(False), "forward": F.lit(False),
    })
