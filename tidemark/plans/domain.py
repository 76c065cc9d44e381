"""A view of the ``events`` table as feature events, the same in Spark and in SQL.

``k`` is the number in ``props``; posts are k + 1, authors k % 20 + 1, rooms k + 1. Clicks are exposures, all else are
views. Purchases, signups and errors carry interaction codes dealt by k, every fifth event a second one, so that every
code occurs; times are dealt by event id over all thresholds, zero among them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Codes by event type, dealt by k; a second code where event_id % 5 = 0.
DEALT = {"purchase": (1, 3, 5, 6, 10, 9), "signup": (13, 15, 16), "error": (7, 11, 18)}
SECOND = {"purchase": 1, "signup": 1, "error": 11}


def _by_type(values: dict[str, Column]) -> Column:
    out = F.lit(None)
    for name, x in values.items():
        out = F.when(F.col("event_type") == name, x).otherwise(out)
    return out


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, i, v = F.col("k"), F.col("event_id"), F.col("value")
    e = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("k", F.regexp_extract("props", "([0-9]+)", 1).cast("long"))
    first = _by_type({t: F.element_at(F.array(*map(F.lit, codes)), (k % len(codes) + 1).cast("int")) for t, codes in DEALT.items()})
    second = F.when(i % 5 == 0, _by_type({t: F.lit(code) for t, code in SECOND.items()}))
    shown = F.col("event_type") == "click"
    return e.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("user_id").alias("uid"),
        (k + 1).alias("post_id"),
        (k % 20 + 1).alias("author"),
        F.concat_ws("-", F.col("user_id").cast("string"), k.cast("string")).alias("rec_token"),
        F.when(shown, "expose").otherwise("view").alias("kind"),
        (k % 2 + 1).cast("int").alias("post_type"),
        F.when(shown, 0.0).when(i % 4 == 0, v / 64).otherwise(v / 2).alias("standing_time"),
        F.when(shown | (i % 11 == 1), 0.0).when(i % 3 == 0, v / 32).otherwise(v).alias("progress_time"),
        F.array_compact(F.array(first, second)).cast("array<int>").alias("interactions"),
        "event_type", "k", "value",
    )


def _case(values: dict[str, str]) -> str:
    return "CASE event_type " + " ".join(f"WHEN '{t}' THEN {x}" for t, x in values.items()) + " END"


_FIRST = _case({t: f"[{', '.join(map(str, codes))}][CAST(k % {len(codes)} + 1 AS INTEGER)]" for t, codes in DEALT.items()})
EV = f"""ev AS (SELECT event_id, ts, user_id AS uid, k + 1 AS post_id, k % 20 + 1 AS author, concat(user_id, '-', k) AS rec_token,
  CASE WHEN event_type = 'click' THEN 'expose' ELSE 'view' END AS kind, CAST(k % 2 + 1 AS INTEGER) AS post_type,
  CASE WHEN event_type = 'click' THEN 0.0::DOUBLE WHEN event_id % 4 = 0 THEN value / 64 ELSE value / 2 END AS standing_time,
  CASE WHEN event_type = 'click' OR event_id % 11 = 1 THEN 0.0::DOUBLE WHEN event_id % 3 = 0 THEN value / 32 ELSE value END AS progress_time,
  list_filter([{_FIRST}, CASE WHEN event_id % 5 = 0 THEN {_case({t: str(x) for t, x in SECOND.items()})} END], lambda x: x IS NOT NULL) AS codes, event_type, k, value
  FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events))"""


def has_sql(*codes: int) -> str:
    """The event has one of the codes."""
    return f"list_has_any(codes, [{', '.join(map(str, codes))}])"


def acted_sql(*codes: int) -> str:
    return f"(kind = 'view' AND {has_sql(*codes)})"


def windows_sql(size_s: int, slide_s: int, source: str = "ev", ts: str = "ts") -> str:
    """A row for each window that holds the event: ``w AS (...)`` with window_end in epoch seconds."""
    first = f"CAST(epoch_us({ts}) // {slide_s * 1_000_000} AS BIGINT) * {slide_s}"
    return f"w AS (SELECT *, {first} + {slide_s} * unnest(range(1, {size_s // slide_s} + 1)) AS window_end FROM {source})"


ROOM_EVENTS = {"click": "live_exposure", "view": "live_view", "signup": "enter_liveroom", "error": "exit_liveroom"}
PAID_EVENTS = ("liveroom_gift_send", "liveroom_follow_anchor", "liveroom_chat_message")


def live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as those of live rooms: clicks expose, views watch, signups enter, errors exit; purchases give,
    follow or chat by k."""
    e = events(spark, sf_dir)
    rest = F.element_at(F.array(*map(F.lit, PAID_EVENTS)), (F.col("k") % len(PAID_EVENTS) + 1).cast("int"))
    name = F.coalesce(_by_type({t: F.lit(n) for t, n in ROOM_EVENTS.items()}), rest)
    sec = F.floor(F.col("value") / 8).cast("long")
    e = e.withColumn("event", name)
    of = lambda names, x: F.when(F.col("event").isin(*names), x).otherwise(F.lit(0)).cast("long")
    return e.select(
        "event_id", "ts", "uid", F.col("post_id").alias("live_id"), F.col("author").alias("anchor_id"), (F.col("k") % 6).cast("int").alias("scene"),
        (F.col("k") % 4).cast("int").alias("from_scene"), "event", of(("live_view", "exit_liveroom"), sec).alias("watch"),
        of(("exit_liveroom",), sec).alias("stay"), of(("liveroom_gift_send",), sec * 2).alias("coins"),
    )


_PAID = f"[{', '.join(repr(x) for x in PAID_EVENTS)}][CAST(k % {len(PAID_EVENTS)} + 1 AS INTEGER)]"
LIVE = f"""{EV}, named AS (SELECT *, coalesce({_case({t: repr(n) for t, n in ROOM_EVENTS.items()})}, {_PAID}) AS event, CAST(floor(value / 8) AS BIGINT) AS sec FROM ev),
live AS (SELECT event_id, ts, uid, post_id AS live_id, author AS anchor_id, CAST(k % 6 AS INTEGER) AS scene, CAST(k % 4 AS INTEGER) AS from_scene, event,
  CASE WHEN event IN ('live_view', 'exit_liveroom') THEN sec ELSE 0 END AS watch, CASE WHEN event = 'exit_liveroom' THEN sec ELSE 0 END AS stay,
  CASE WHEN event = 'liveroom_gift_send' THEN 2 * sec ELSE 0 END AS coins FROM named)"""

LEVELS = ("clean", "mid", "high", "explicit", "other")


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """post_id, tags: tag texts made of the posts that occur."""
    p = events(spark, sf_dir).select("post_id", "k").distinct()
    level = F.element_at(F.array(*map(F.lit, LEVELS)), (F.col("k") % 5 + 1).cast("int"))
    return p.select("post_id", F.concat(F.lit("content#c"), (F.col("k") % 7).cast("string"), F.lit(",restricted#"), level).alias("tags"))


TAGS = """tags AS (SELECT DISTINCT post_id, CASE k % 5 WHEN 0 THEN 'clean' WHEN 1 THEN 'mid' WHEN 2 THEN 'high' WHEN 3 THEN 'explicit' ELSE 'unk' END AS tag,
  'content#c' || (k % 7) AS content_tag, CASE k % 5 WHEN 3 THEN 'restricted#explicit' ELSE 'content#c' || (k % 7) END AS prior FROM ev)"""

#: Flags of client events by interaction code.
FLAG_CODES = {"like": 1, "comment": 3, "share": 6, "collect": 5, "follow": 13, "profile": 15, "report": 7, "uninterested": 11, "paid": 10}


def post_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as client events of posts, with flags."""
    e = events(spark, sf_dir)
    flags = {n: F.array_contains("interactions", code) for n, code in FLAG_CODES.items()}
    length = F.when(F.col("k") % 10 == 0, 0.0).otherwise(100.0)
    return e.select(
        "event_id", "uid", "rec_token", "post_id", "author", length.alias("length"), "standing_time", F.col("progress_time").alias("playback_time"), "progress_time",
        (F.col("progress_time") >= 100).alias("complete"), *[x.alias(n) for n, x in flags.items()], "ts",
    )


#: Sessions of a token and post that are 6 hours apart.
SESSIONS = f"""{EV}, gaps AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY uid, rec_token, post_id ORDER BY ts)) <= 21600000000 THEN 0 ELSE 1 END AS fresh FROM ev),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY uid, rec_token, post_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS no FROM gaps),
s AS (SELECT uid, rec_token, post_id, min(author) AS author, min(ts) AS start_ts, max(ts) AS last_ts, sum(standing_time) AS standing, sum(progress_time) AS playback,
  max(progress_time) AS progress, bool_or(progress_time >= 100) AS complete, {', '.join(f'bool_or({has_sql(code)}) AS "{n}"' for n, code in FLAG_CODES.items())},
  CASE WHEN (post_id - 1) % 10 = 0 THEN 0.0 ELSE max(progress_time) / 100.0 END AS rate,
  max(ts) + INTERVAL 6 HOURS - INTERVAL 1 MICROSECOND AS session_time FROM numbered GROUP BY uid, rec_token, post_id, no)"""
