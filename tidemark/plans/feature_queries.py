"""Registered queries on parsers, predicates, scalars, lookups, labels, collaborative filtering, key-value tables
and skew. Parser queries build the JSON text from ``events``, parse it, and must give back what went in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import scalars as X
from tidemark.operators import aggregates as A
from tidemark.operators import cf, filters, joins, labels, parse, skew, topk
from tidemark.operators import windows as T
from tidemark.plans.domain import EV, LIVE, TAGS, acted_sql, events, has_sql, live, tags, windows_sql
from tidemark.plans.window_queries import fixed, fixed_sql
from tidemark.sources import kv

def _sec():
    return F.unix_seconds("ts")



def _texts(*parts: DataFrame) -> DataFrame:
    return joins.unite(*parts)


def _expose_json(e: DataFrame) -> DataFrame:
    item = F.struct(F.col("post_id").cast("string").alias("post_id"), F.lit(2).alias("exposed_pos"), _sec().alias("expo_time"), "rec_token", F.lit(None).cast("string").alias("from_index"), F.lit("d").alias("dest_index"))
    body = F.struct("uid", _sec().alias("created_at"), F.array(item, F.struct(F.lit("none").alias("post_id"), F.lit(1).alias("exposed_pos"), _sec().alias("expo_time"), F.lit("").alias("rec_token"), F.lit("f").alias("from_index"), F.lit("d").alias("dest_index"))).alias("list"), F.concat(F.lit("device"), (F.col("uid") % 9).cast("string")).alias("DID"), F.lit("en").alias("Lang"))
    return e.filter(F.col("kind") == "expose").select(F.to_json(F.struct(F.lit(16).alias("event_type"), body.alias("post_expose"))).alias("value"))


def _view_json(e: DataFrame) -> DataFrame:
    item = F.struct("post_id", "post_type", F.col("standing_time").cast("float").alias("standing_time"), F.col("progress_time").cast("float").alias("progress_time"), "author", F.col("uid").alias("viewer"), "rec_token", F.col("interactions").alias("interaction"))
    return e.filter(F.col("kind") == "view").select(F.to_json(F.struct(F.lit(8).alias("event_type"), F.struct("uid", _sec().alias("created_at"), F.array(item).alias("list")).alias("post_view"))).alias("value"))


def parsed_feature_events(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d)
    broken = e.limit(50).select(F.lit('{"event_type":8,').alias("value"))
    f = parse.feature_events(_texts(_expose_json(e), _view_json(e), broken))
    return f.select("uid", "post_id", F.coalesce("author", F.lit(0)).alias("author"), "rec_token", "kind", F.coalesce("post_type", F.lit(0)).alias("post_type"), F.floor(F.col("progress_time") * 10 + 0.5).cast("long").alias("progress"), F.array_join(F.transform("interactions", lambda x: x.cast("string")), ",").alias("interactions"), F.unix_seconds("ts").alias("sec"))


PARSED_SQL = f"""WITH {EV} SELECT uid, post_id, CASE kind WHEN 'view' THEN author ELSE 0 END AS author, rec_token, kind, CASE kind WHEN 'view' THEN post_type ELSE 0 END AS post_type,
  CASE kind WHEN 'view' THEN CAST(floor(CAST(CAST(progress_time AS FLOAT) AS DOUBLE) * 10 + 0.5) AS BIGINT) ELSE 0 END AS progress, coalesce(array_to_string(codes, ','), '') AS interactions, epoch_us(ts) // 1000000 AS sec FROM ev WHERE uid > 0"""


def exposure_device_rows(spark: SparkSession, d: str) -> DataFrame:
    return parse.exposure_rows(_expose_json(events(spark, d))).select("uid", "created_at", "post_id", "exposed_pos", "rec_token", "from_index", "dest_index", "DID", "Lang")


DEVICE_SQL = f"""WITH {EV}, x AS (SELECT * FROM ev WHERE kind = 'expose')
SELECT uid, epoch_us(ts) // 1000000 AS created_at, CAST(post_id AS VARCHAR) AS post_id, 2 AS exposed_pos, rec_token, '' AS from_index, 'd' AS dest_index, 'device' || (uid % 9) AS "DID", 'en' AS "Lang" FROM x
UNION ALL SELECT uid, epoch_us(ts) // 1000000, 'none', 1, '', 'f', 'd', 'device' || (uid % 9), 'en' FROM x"""


def event_type_filter(spark: SparkSession, d: str) -> DataFrame:
    """Raw texts by the cheap and the exact test of their event type."""
    e = events(spark, d)
    t = F.format_string('{"event_type": %d, "x": %d}', F.element_at(F.array(*[F.lit(x) for x in (1, 8, 16, 161)]), (F.col("k") % 4 + 1).cast("int")), F.col("event_id"))
    raw = e.select("event_id", F.when(F.col("k") % 10 == 9, F.lit("not json")).otherwise(t).alias("value"))
    return raw.select("event_id", filters.maybe_event_type("value", 8, 16).alias("maybe"), filters.event_type("value").alias("type")).filter(F.col("maybe") | (F.col("type") == -1))


TYPE_SQL = f"""WITH {EV}, t AS (SELECT event_id, CASE WHEN k % 10 = 9 THEN -1 ELSE [1, 8, 16, 161][CAST(k % 4 + 1 AS INTEGER)] END AS type FROM ev)
SELECT event_id, type IN (8, 16) AS maybe, CAST(type AS INTEGER) AS type FROM t WHERE type IN (8, 16, -1)"""


def _last_second(spark: SparkSession, d: str) -> int:
    """The time of the last event: freshness is judged as of it."""
    return events(spark, d).agg(F.max(_sec())).first()[0] or 0


def parsed_tags(spark: SparkSession, d: str) -> DataFrame:
    """Tag events of all shapes, fresh ones only, as (tag, post)."""
    e = events(spark, d).filter(F.col("event_type") == "click")
    shape = F.col("k") % 4
    content = F.when(shape == 0, F.format_string('{"a%d":1,"b":2}', F.col("k"))).when(shape == 1, F.format_string('[{"c%d":1},{"b":2}]', F.col("k"))).when(shape == 2, F.format_string('["d%d","b","b"]', F.col("k"))).otherwise(F.format_string('"e%d"', F.col("k")))
    text = F.concat(F.format_string('{"event_type":11,"ai_post_tag_event":{"post_id":%d,"access_level":%d,"access_level_time":%d,"results":{"tags":{"content":', F.col("event_id") + 1, F.col("k"), _sec()), content, F.lit("}}}}"))
    p = parse.content_tags(e.select(text.alias("value")), F.lit(_last_second(spark, d)))
    return parse.tag_posts(p).select("tag", "post_id", "time")


TAGS_SQL = f"""WITH {EV}, x AS (SELECT event_id + 1 AS post_id, epoch_us(ts) // 1000000 AS time, k FROM ev WHERE event_type = 'click' AND k BETWEEN 10 AND 30), f AS (SELECT * FROM x WHERE (SELECT max(epoch_us(ts) // 1000000) FROM ev) - time <= 86400)
SELECT unnest(CASE k % 4 WHEN 0 THEN ['a' || k, 'b'] WHEN 1 THEN ['c' || k, 'b'] WHEN 2 THEN ['d' || k, 'b'] ELSE ['e' || k] END) AS tag, post_id, time FROM f"""


def parsed_valid_posts(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d)
    text = F.to_json(F.struct(F.lit(17).alias("event_type"), F.struct(F.col("event_id").cast("string").alias("id"), "uid", _sec().alias("tagging_at"), _sec().alias("created_at"), (_sec() + 5).alias("updated_at"), F.when(F.col("k") % 3 == 0, _sec()).otherwise(0).alias("deleted_at")).alias("rec_valid_post_event")))
    return parse.valid_posts(e.select(text.alias("value")), F.lit(_last_second(spark, d)))


VALID_SQL = f"""WITH {EV}, x AS (SELECT event_id AS post_id, uid, epoch_us(ts) // 1000000 AS sec, k FROM ev) SELECT post_id, uid, sec AS tagging_at, sec AS created_at, sec + 5 AS updated_at FROM x
WHERE k % 3 <> 0 AND post_id > 0 AND uid > 0 AND (SELECT max(epoch_us(ts) // 1000000) FROM ev) - sec <= 6 * 86400"""


def _log_text(name, data):
    body = F.struct(name.alias("event"), data.alias("event_data"), F.unix_millis("ts").alias("timestamp"), "uid")
    return F.to_json(F.struct(F.lit(1).alias("event_type"), body.alias("user_event_log")))


def _log(e: DataFrame, name, data) -> DataFrame:
    return e.select(_log_text(name, data).alias("value"))


#: Client events by the first interaction code of an event; all other events are plays.
_SINGLES = {1: "postLikeButtonClicked", 3: "postCommentSucceed", 6: "postShare", 13: "postFollow", 15: "postClickNickname", 7: "postReportClick", 11: "postUninterestedClick", 10: "post_paid_unlock_entry_show"}
_CLIENT_FLAGS = {"like": "postLikeButtonClicked", "comment": "postCommentSucceed", "share": "postShare", "follow": "postFollow", "profile": "postClickNickname", "report": "postReportClick", "uninterested": "postUninterestedClick", "paid": "post_paid_unlock_entry_show"}


def _client_log(spark: SparkSession, d: str) -> DataFrame:
    """Client logs of all families, with likes taken back, items that don't count and empty data."""
    e = events(spark, d).withColumn("first", F.get("interactions", F.lit(0)))
    k = F.col("k")
    one = F.struct(
        F.col("uid").alias("userId"), F.col("post_id").cast("string").alias("post_id"), F.lit(1).alias("item_type"), F.lit(1).alias("post_type"), (k % 7 % 2 + 1).cast("int").alias("exposed_pos"),
        "rec_token", F.col("author").alias("author_id"), F.when(k % 4 == 0, "unlike").otherwise("like").alias("action"),
    )
    item = F.struct(
        F.col("post_id").cast("string").alias("post_id"), F.lit(1).alias("item_type"), F.lit(2).alias("post_type"), F.lit(2).alias("exposed_pos"), "rec_token", F.lit(100.0).alias("length"),
        "standing_time", "progress_time", F.col("progress_time").alias("playback_time"), "author",
    )
    name = F.lit(None)
    for code, n in _SINGLES.items():
        name = F.when(F.col("first") == code, n).otherwise(name)
    listed = lambda field: F.to_json(F.struct(F.col("uid").alias("userId"), F.array(item).alias(field)))
    collect = F.to_json(F.struct(F.col("uid").alias("userId"), F.col("post_id").alias("source"), (k % 4 == 2).cast("int").alias("action_type")))
    plays = F.col("first").isNull() & (F.col("kind") == "view")
    texts = F.array(
        _log_text(name, F.to_json(one)), F.when(F.col("first") == 5, _log_text(F.lit(parse.COLLECT), collect)), F.when(F.col("first") == 9, _log_text(F.lit("postShare"), F.lit("null"))),
        F.when(F.col("kind") == "expose", _log_text(F.lit(parse.EXPOSURE), listed("posts"))), F.when(plays, _log_text(F.when(k % 2 == 0, parse.VIDEO).otherwise(parse.IMAGE), listed("list"))),
    )
    return parse.client_log(e.select(F.explode(F.array_compact(texts)).alias("value")))


def parsed_client_posts(spark: SparkSession, d: str) -> DataFrame:
    p = parse.client_posts(_client_log(spark, d))
    rounded = [fixed(n, 2).alias(n) for n in ("length", "standing_time", "progress_time", "playback_time")]
    return p.select("event", "uid", "post_id", "author", "rec_token", *rounded, *[f for f in parse.FLAGS if f != "complete"], F.unix_millis("ts").alias("ms"))


def _client_row(event: str, where: str, author: str = "author", token: str = "rec_token", times: tuple[str, ...] = ("0.0", "0.0", "0.0", "0.0"), **flags: str) -> str:
    names = ("length", "standing_time", "progress_time", "playback_time")
    shown = ", ".join(f"{fixed_sql(x, 2)} AS {n}" for n, x in zip(names, times))
    marks = ", ".join(f'{flags.get(f, "false")} AS "{f}"' for f in parse.FLAGS if f != "complete")
    return f"SELECT {event} AS event, uid, post_id, {author} AS author, {token} AS rec_token, {shown}, {marks}, ms, k FROM x WHERE uid > 0 AND {where}"


_FIRST = "coalesce(codes[1], 0)"
CLIENT_ROWS = f"{EV}, x AS (SELECT *, epoch_us(ts) // 1000 AS ms FROM ev), cp AS (" + " UNION ALL ".join([
    *[_client_row(f"'{n}'", f"{_FIRST} = {code} AND k % 7 % 2 = 1", **{f: "k % 4 <> 0" if f == "like" else "true" for f, m in _CLIENT_FLAGS.items() if m == n}) for code, n in _SINGLES.items()],
    _client_row(f"'{parse.COLLECT}'", f"{_FIRST} = 5 AND k % 4 = 2", "0", "''", collect="true"),
    _client_row(f"'{parse.EXPOSURE}'", "kind = 'expose'", "0", times=("100.0", "0.0", "0.0", "0.0")),
    _client_row(f"CASE WHEN k % 2 = 0 THEN '{parse.VIDEO}' ELSE '{parse.IMAGE}' END", f"kind = 'view' AND {_FIRST} = 0",
                times=("100.0", "standing_time", "progress_time", "CASE WHEN k % 2 = 0 THEN progress_time ELSE 0.0 END")),
]) + ")"
CLIENT_SQL = f"WITH {CLIENT_ROWS} SELECT * EXCLUDE (k) FROM cp"


def client_views(spark: SparkSession, d: str) -> DataFrame:
    """Client events and refused prompts as views with interaction codes."""
    log = _client_log(spark, d).unionByName(parse.client_log(_refusal_log(spark, d)))
    v = parse.client_to_views(parse.client_posts(log, refusals=True))
    return v.select("uid", "post_id", "author", "kind", F.array_join(F.transform("interactions", lambda x: x.cast("string")), ",").alias("codes"), F.unix_millis("ts").alias("ms"))


_VIEW_CODES = {"like": 1, "comment": 3, "share": 5, "collect": 6, "paid": 10, "follow": 13, "profile": 15, "report": 11, "uninterested": 7}
CLIENT_VIEWS_SQL = f"""WITH {CLIENT_ROWS}
SELECT uid, post_id, author, CASE WHEN event = '{parse.EXPOSURE}' THEN 'expose' ELSE 'view' END AS kind,
  array_to_string(list_filter([{", ".join(f'CASE WHEN "{f}" THEN {code} END' for f, code in _VIEW_CODES.items())}], lambda c: c IS NOT NULL), ',') AS codes, ms FROM cp
UNION ALL SELECT CASE WHEN k % 2 = 0 OR uid = 0 THEN author + 1000 ELSE uid END, post_id, 0, 'view', '7,18', epoch_us(ts) // 1000 FROM ev WHERE event_type = 'error'"""


def _refusal_log(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d).filter(F.col("event_type") == "error")
    data = F.to_json(F.struct((F.col("author") + 1000).cast("string").alias("userId"), F.col("post_id").cast("string").alias("post_id")))
    return _log(e.withColumn("uid", F.when(F.col("k") % 2 == 0, F.lit(0)).otherwise(F.col("uid"))), F.lit(parse.PROMPT_NO), data)


def prompt_refusals(spark: SparkSession, d: str) -> DataFrame:
    p = parse.prompt_no(parse.client_log(_refusal_log(spark, d)))
    return p.select("uid", "post_id", "rec_token", F.unix_millis("ts").alias("ms"))


PROMPT_SQL = f"WITH {EV} SELECT CASE WHEN k % 2 = 0 OR uid = 0 THEN author + 1000 ELSE uid END AS uid, post_id, '' AS rec_token, epoch_us(ts) // 1000 AS ms FROM ev WHERE event_type = 'error'"


def parsed_live_events(spark: SparkSession, d: str) -> DataFrame:
    """Live rooms' events with the scene that counts; every event carries all fields, of which each kind reads its own."""
    e = live(spark, d)
    data = F.to_json(F.struct("uid", "live_id", F.when(F.col("live_id") % 50 > 0, F.col("anchor_id")).otherwise(0).alias("anchor_id"), "scene", "from_scene", (F.col("event_id") % 40).alias("watch_duration"), (F.col("event_id") % 60).alias("stay_duration"), F.lit(2).alias("gift_price"), (F.col("event_id") % 9).cast("int").alias("gift_count")))
    p = parse.live_events(parse.client_log(_log(e, F.col("event"), data)))
    return p.filter(filters.in_scene("event")).select("event", "uid", "live_id", "anchor_id", filters.scene_of("event").alias("scene"), "watch", "stay", "coins", F.unix_millis("ts").alias("ms"))


LIVE_SQL = f"""WITH {LIVE}, x AS (SELECT *, CASE WHEN event IN ('enter_liveroom', 'exit_liveroom') THEN from_scene ELSE scene END AS sc FROM live)
SELECT event, uid, live_id, anchor_id, sc AS scene, CASE event WHEN 'live_view' THEN event_id % 40 WHEN 'exit_liveroom' THEN event_id % 60 ELSE 0 END AS watch,
  CASE event WHEN 'exit_liveroom' THEN event_id % 60 ELSE 0 END AS stay, CASE event WHEN 'liveroom_gift_send' THEN 2 * (event_id % 9) ELSE 0 END AS coins, epoch_us(ts) // 1000 AS ms
FROM x WHERE uid > 0 AND live_id % 50 > 0 AND sc IN (1, 3, 4, 5)"""


def parsed_live_watches(spark: SparkSession, d: str) -> DataFrame:
    e = live(spark, d)
    text = F.to_json(F.struct(F.col("uid").cast("string").alias("uid"), F.col("live_id").cast("string").alias("live_id"), F.col("watch").alias("watch_time"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("raw_event_time"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("event_time")))
    return parse.live_watches(e.select(text.alias("value"))).select("uid", "live_id", "watch_time", F.unix_seconds("ts").alias("sec"))


LIVE_WATCH_SQL = f"WITH {LIVE} SELECT CAST(uid AS VARCHAR) AS uid, CAST(live_id AS VARCHAR) AS live_id, watch AS watch_time, epoch_us(ts) // 1000000 AS sec FROM live"


def view_feedback(spark: SparkSession, d: str) -> DataFrame:
    return parse.feedback(events(spark, d)).select("uid", "post_id", "feedback", F.unix_micros("ts").alias("us"))


#: ``fb``: uid, post_id, author, feedback, us of views.
FB = f"""v AS (SELECT uid, post_id, author, epoch_us(ts) AS us, codes, progress_time AS p FROM ev WHERE kind = 'view'),
fb AS (SELECT uid, post_id, author, 'report' AS feedback, us FROM v WHERE {has_sql(7)} UNION ALL SELECT uid, post_id, author, 'uninterested', us FROM v WHERE {has_sql(11)}
  UNION ALL SELECT uid, post_id, author, 'short', us FROM v WHERE NOT {has_sql(7, 11)} AND p > 0 AND p < 3 UNION ALL SELECT uid, post_id, author, 'positive', us FROM v WHERE p >= 10)"""
FEEDBACK_SQL = f"WITH {EV}, {FB} SELECT uid, post_id, feedback, us FROM fb"


def scalar_values(spark: SparkSession, d: str) -> DataFrame:
    """Scalar functions over all events."""
    e = events(spark, d).join(tags(spark, d), "post_id")
    rec = X.label_record(F.lit("u_ylevel_mid"), F.array("post_id", "author"), F.unix_millis("ts"))
    return e.select(
        "event_id", X.sensitivity_tag("tags").alias("tag"), X.prioritized_tag("tags").alias("prior"), X.tag_level(X.sensitivity_tag("tags")).alias("level"), F.round(X.half_life("progress_time", F.col("k") / 4, 6), 6).alias("decayed"),
        F.round(X.net_weight(F.col("k") / 10 - 5), 6).alias("weight"), F.round(X.net_from_weight(F.col("k") / 49), 6).alias("net"), X.step_decay(F.col("k") * 10, F.col("author")).alias("step"), F.unix_seconds(X.next_local_hour("ts")).alias("next20"), X.cooldown_days(F.when(F.col("k") % 2 == 0, "block").otherwise("no_zone"), (F.col("k") % 5).cast("int")).alias("days"),
        X.flow_value(X.flow_text("v5", stage=F.lit("stable"), n="k"), "n").alias("flow"), rec.alias("record"), F.size(X.parse_label_record(rec)["ids"]).alias("n_ids"), X.feature_key("rec:user_feature:{", "uid", "}:post1h").alias("key"),
        F.array_join(F.transform(X.history_ids(F.when(F.col("k") % 2 == 0, F.format_string('[{"itemId":%d,"ts":%d,"weight":1.5},{"item_id":"7"},{"ts":1}]', F.col("k"), F.col("k") % 3)).otherwise(F.format_string("%d|9,7|3,x", F.col("k")))), lambda x: x.cast("string")), ",").alias("history"),
        X.timed_posts_text(F.array(F.struct("post_id", _sec().alias("time")), F.struct(F.col("author").alias("post_id"), F.col("k").alias("time")))).alias("timed"),
        F.array_join(X.int32_only(F.array(F.col("post_id") * 50_000_000, -F.col("k") * 50_000_000, F.col("uid"))), ",").alias("narrow"),
        F.coalesce(X.step_decay(*X.stored_pair(F.concat_ws(":", F.col("k") * 7, F.when(F.col("k") % 9 == 0, "x").otherwise((F.col("k") % 30).cast("string"))))), F.lit(-1)).alias("stored"),
    )


SCALAR_SQL = f"""WITH {EV}, {TAGS}, j AS (SELECT ev.*, t.tag, t.content_tag, (k / 10.0 - 5)::DOUBLE AS net, (k / 49.0)::DOUBLE AS wt, (epoch_us(ts) // 1000000) + 19800 AS ist FROM ev JOIN tags t ON ev.post_id = t.post_id)
SELECT event_id, tag, CASE tag WHEN 'explicit' THEN 'restricted#explicit' ELSE content_tag END AS prior, CASE tag WHEN 'explicit' THEN 3 WHEN 'high' THEN 2 WHEN 'mid' THEN 1 ELSE 0 END AS level, round(progress_time * pow(0.5, k / 4.0 / 6), 6) AS decayed,
  round(CASE WHEN net > 0 THEN 1 + 1 / (1 + exp(-net)) WHEN net < 0 THEN 1 / (1 + exp(net)) ELSE 1.0 END, 6) AS weight,
  round(CASE WHEN wt > 1 AND wt <= 2 THEN CASE WHEN wt - 1 > 0.01 AND wt - 1 < 0.99 THEN -ln(1 / (wt - 1) - 1) ELSE 3.0 END WHEN wt >= 0 AND wt < 1 THEN CASE WHEN wt > 0.01 AND wt < 0.99 THEN ln(1 / wt - 1) ELSE -3.0 END ELSE 0.0 END, 6) AS net, CAST(floor(k * 10 * pow(0.96, author / 2.0) + 0.5) AS BIGINT) AS step,
  CASE WHEN ist % 86400 < 72000 THEN ist - ist % 86400 + 72000 ELSE ist - ist % 86400 + 72000 + 86400 END - 19800 AS next20,
  CASE WHEN k % 2 = 0 THEN [1, 1, 3, 7, 7][CAST(k % 5 + 1 AS INTEGER)] ELSE [3, 3, 7, 14, 14][CAST(k % 5 + 1 AS INTEGER)] END AS days, CAST(k AS VARCHAR) AS flow,
  concat('u_ylevel_mid|', least(post_id, author), ',', greatest(post_id, author), '|', epoch_us(ts) // 1000) AS record, 2 AS n_ids, 'rec:user_feature:{{' || uid || '}}:post1h' AS key, CASE WHEN k = 0 OR k = 7 THEN '7' ELSE concat(k, ',7') END AS history,
  concat(post_id, '|', epoch_us(ts) // 1000000, ',', author, '|', k) AS timed, concat(CASE WHEN post_id <= 42 THEN concat(post_id * 50000000, ',') ELSE '' END, CASE WHEN k <= 42 THEN concat(-k * 50000000, ',') ELSE '' END, uid) AS narrow,
  CASE WHEN k % 9 = 0 THEN -1 ELSE CAST(floor(k * 7 * pow(0.96, (k % 30) / 2.0) + 0.5) AS BIGINT) END AS stored FROM j"""


def tagged_views(spark: SparkSession, d: str) -> DataFrame:
    t = joins.with_tags(events(spark, d), tags(spark, d), X.sensitivity_tag)
    return t.filter(F.col("kind") == "view")


def tag_lookup(spark: SparkSession, d: str) -> DataFrame:
    return joins.with_tags(events(spark, d), tags(spark, d), X.sensitivity_tag).groupBy("uid", "tag").agg(F.count("*").alias("n"))


LOOKUP_SQL = f"WITH {EV}, {TAGS} SELECT uid, tag, count(*) AS n FROM ev JOIN tags USING (post_id) GROUP BY ALL"


def user_type_lookup(spark: SparkSession, d: str) -> DataFrame:
    c = spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("uid"), F.col("c_nationkey").alias("zone_mode_type"))
    return joins.user_types(events(spark, d), c).groupBy("uid", "user_type").agg(F.count("*").alias("n"))


USER_TYPE_SQL = f"WITH {EV} SELECT uid, CASE c_nationkey WHEN 1 THEN 'zone' WHEN 2 THEN 'block' ELSE 'no_zone' END AS user_type, count(*) AS n FROM ev LEFT JOIN customer ON c_custkey = uid GROUP BY ALL"


def listed_anchors(spark: SparkSession, d: str) -> DataFrame:
    """Sessions of 6 hours that watched an anchor of the list for long."""
    wanted = spark.read.parquet(f"{d}/nation.parquet").select(F.col("n_nationkey").cast("long").alias("anchor_id")).filter(F.col("anchor_id") % 2 == 1)
    s = T.sessions(live(spark, d), ["uid", "anchor_id"], "6 hours", {"watched": F.sum(F.when(F.col("event").isin("live_view", "exit_liveroom"), F.col("watch")).otherwise(0))})
    return labels.watch_flags(s, wanted, 15).select("uid", "anchor_id", F.unix_micros("session_end").alias("end_us"), "flag")


ANCHOR_SQL = f"""WITH {LIVE}, g AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY uid, anchor_id ORDER BY ts)) <= 21600000000 THEN 0 ELSE 1 END AS fresh FROM live),
n AS (SELECT *, sum(fresh) OVER (PARTITION BY uid, anchor_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS no FROM g), s AS (SELECT uid, anchor_id, no, epoch_us(max(ts)) + 21600000000 AS end_us, sum(CASE WHEN event IN ('live_view', 'exit_liveroom') THEN watch ELSE 0 END) AS watched FROM n GROUP BY ALL)
SELECT uid, anchor_id, end_us, 1 AS flag FROM s WHERE watched > 15 AND anchor_id IN (SELECT n_nationkey FROM nation WHERE n_nationkey % 2 = 1)"""


def cohort_interactions(spark: SparkSession, d: str) -> DataFrame:
    """The eleven counters of a post over the 48 hours from its first exposure on."""
    e = events(spark, d)
    starts = e.filter(F.col("kind") == "expose").groupBy("post_id").agg(F.min("ts").alias("start_ts"))
    c = A.item_cohorts(e, starts)
    return c.select(*[n for n in c.columns if not n.endswith("_ts")], F.unix_micros("emit_ts").alias("emit_us"))


_ITEM = {"expose": "kind = 'expose'"} | {f"view_{n}s": f"kind = 'view' AND progress_time >= {n}" for n in A.VIEW_STEPS} | {f"stand_{n}s": f"kind = 'view' AND standing_time >= {n}" for n in A.STAND_STEPS}
_ITEM |= {"like": acted_sql(1), "follow": acted_sql(13), "profile": acted_sql(15), "interact": acted_sql(3, 5, 6)}
COHORT_SQL = f"""WITH {EV}, s AS (SELECT post_id, min(ts) AS t0 FROM ev WHERE kind = 'expose' GROUP BY post_id)
SELECT ev.post_id, epoch_us(t0) + 172800000000 AS emit_us, {", ".join(f'count(DISTINCT CASE WHEN {c} THEN rec_token END) AS "{n}"' for n, c in _ITEM.items())}
FROM ev JOIN s ON ev.post_id = s.post_id WHERE ts >= t0 AND ts <= t0 + INTERVAL 48 HOURS GROUP BY ev.post_id, t0"""


def _history(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d)
    rows = e.filter(F.size("interactions") > 0).select("uid", F.col("post_id").alias("right"), F.col("event_id").alias("pos"), F.lit(1.2).alias("weight"))
    return topk.history(rows, "uid", "right", "pos", 20)


def user_history(spark: SparkSession, d: str) -> DataFrame:
    return _history(spark, d).select("uid", "right", "pos", "rank")


_H = "h AS (SELECT uid, post_id AS \"right\", min(event_id) AS pos FROM ev WHERE len(codes) > 0 GROUP BY ALL), hist AS (SELECT *, CAST(row_number() OVER (PARTITION BY uid ORDER BY pos) AS INTEGER) AS rank FROM h)"
HISTORY_SQL = f'WITH {EV}, {_H} SELECT uid, "right", pos, rank FROM hist WHERE rank <= 20'


def cf_session_scores(spark: SparkSession, d: str) -> DataFrame:
    s = cf.session_scores(events(spark, d))
    return s.select("uid", "rec_token", "item_id", "score", F.unix_micros("last_ts").alias("last_us"), F.unix_seconds("window_end").alias("window_end"))


_ACTIONS = " + ".join(f"CASE WHEN {has_sql(code)} THEN {n} ELSE 0 END" for code, n in {1: 4, 13: 8, 15: 4, 5: 4, 3: 4, 6: 8}.items())
_S = f"{windows_sql(300, 300)}, sc AS (SELECT uid, rec_token, post_id AS item_id, window_end, CAST(sum(CASE kind WHEN 'view' THEN 1 ELSE 0 END + CASE WHEN progress_time >= 3 OR standing_time >= 5 THEN 6 ELSE 0 END + {_ACTIONS}) AS BIGINT) AS score, max(ts) AS last_ts FROM w GROUP BY ALL)"
CF_SESSION_SQL = f"WITH {EV}, {_S} SELECT uid, rec_token, item_id, score, epoch_us(last_ts) AS last_us, window_end FROM sc WHERE score > 0"


def _stored_pairs(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d)
    return e.groupBy(F.col("author").alias("left"), F.col("post_id").alias("right")).agg(F.count("*").alias("score")).withColumn("score", F.col("score") * 3).withColumn("minute", F.col("right") % 30)


def cf_index(spark: SparkSession, d: str) -> DataFrame:
    """The index of neighbours after one batch: scores, pairs, decay, and the best of new and stored."""
    pairs = _stored_pairs(spark, d)
    _, index = cf.update(events(spark, d), _history(spark, d), pairs, pairs.select("left", "right", "score"), F.lit(60), k=16, least=40)
    return index.select("left", "right", "score", F.col("rank"))


CF_INDEX_SQL = f"""WITH {EV}, {_H}, {_S}, x AS (SELECT item_id AS "left", hist."right", epoch_us(last_ts) // 120000000 AS win, round(score * 1.2) AS p FROM sc JOIN hist ON sc.uid = hist.uid WHERE score > 0 AND hist.rank <= 20),
n AS (SELECT "left", "right", CAST(sum(p) AS BIGINT) AS score FROM x GROUP BY ALL HAVING sum(p) > 0), st AS (SELECT author AS "left", post_id AS "right", count(*) * 3 AS score, post_id % 30 AS minute FROM ev GROUP BY ALL),
g AS (SELECT n."left", n."right", n.score + coalesce(CAST(floor(st.score * pow(0.96, (60 - st.minute) / 2.0) + 0.5) AS BIGINT), 0) AS score FROM n LEFT JOIN st ON n."left" = st."left" AND n."right" = st."right"),
u AS (SELECT * FROM g UNION ALL SELECT st."left", st."right", st.score FROM st WHERE NOT EXISTS (SELECT 1 FROM g WHERE g."left" = st."left" AND g."right" = st."right")),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY "left" ORDER BY score DESC, "right") AS INTEGER) AS rank FROM u WHERE score >= 40) SELECT "left", "right", score, rank FROM r WHERE rank <= 16"""


_LISTS = [f"list_{i}" for i in range(8)]


def _profiles(spark: SparkSession, d: str) -> DataFrame:
    """Eight lists of a user, of five posts at most; every post is in two of them."""
    group = F.col("k") % 8
    one = lambda i: F.slice(F.sort_array(F.collect_set(F.when(group.isin(i, (i + 1) % 8), F.col("post_id")))), 1, 5)
    return events(spark, d).groupBy("uid").agg(*[one(i).alias(n) for i, n in enumerate(_LISTS)])


def weighted_history(spark: SparkSession, d: str) -> DataFrame:
    """The eight lists as one history with the lists' weights, each post at its first place."""
    h = topk.history(joins.explode_history(_profiles(spark, d), _LISTS), "uid", "right", "pos", 12)
    return h.select("uid", "right", F.round(F.col("weight") * 10).cast("long").alias("tenths"), "pos")


_WEIGHTED = f"""g AS (SELECT DISTINCT uid, post_id, unnest([k % 8, (k + 7) % 8]) AS list FROM ev), q AS (SELECT *, row_number() OVER (PARTITION BY uid, list ORDER BY post_id) AS r FROM g),
p AS (SELECT uid, post_id AS "right", [{', '.join(f'{w}::DOUBLE' for w in joins.HISTORY_WEIGHTS)}][CAST(list + 1 AS INTEGER)] AS weight, CAST(row_number() OVER (PARTITION BY uid ORDER BY list, r) - 1 AS INTEGER) AS pos FROM q WHERE r <= 5),
f AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY uid, "right" ORDER BY pos) = 1), wh AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY uid ORDER BY pos) <= 12)"""
WEIGHTED_HISTORY_SQL = f'WITH {EV}, {_WEIGHTED} SELECT uid, "right", CAST(round(weight * 10) AS BIGINT) AS tenths, pos FROM wh'


def _whole_history(spark: SparkSession, d: str) -> DataFrame:
    """Every post of a user with the weight of the first of its two lists."""
    group = F.col("k") % 8
    rows = events(spark, d).select("uid", F.col("post_id").alias("right"), F.least(group, (group + 7) % 8).alias("list"))
    return joins.weigh_history(rows)


def weighted_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Session scores times the weights of the eight lists, summed by pair; the lists are whole, and so is the history."""
    return cf.pair_totals(cf.session_scores(events(spark, d)), _whole_history(spark, d), self_pairs=False)


#: The lists and the history as in ``_WEIGHTED``, without their lengths.
_WHOLE = f"""g AS (SELECT DISTINCT uid, post_id, unnest([k % 8, (k + 7) % 8]) AS list FROM ev), q AS (SELECT *, row_number() OVER (PARTITION BY uid, list ORDER BY post_id) AS r FROM g),
p AS (SELECT uid, post_id AS "right", [{', '.join(f'{w}::DOUBLE' for w in joins.HISTORY_WEIGHTS)}][CAST(list + 1 AS INTEGER)] AS weight, CAST(row_number() OVER (PARTITION BY uid ORDER BY list, r) - 1 AS INTEGER) AS pos FROM q),
wh AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY uid, "right" ORDER BY pos) = 1)"""
WEIGHTED_PAIRS_SQL = f"""WITH {EV}, {_S}, {_WHOLE} SELECT item_id AS "left", "right", CAST(sum(round(score * weight)) AS BIGINT) AS score FROM sc JOIN wh ON sc.uid = wh.uid
WHERE score > 0 AND item_id <> "right" GROUP BY ALL HAVING sum(round(score * weight)) > 0"""


def share_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels by share of standing time and by seconds; of tags with equal times the one seen last."""
    v = topk.top_rows(tagged_views(spark, d), ["uid"], [F.desc("ts"), F.desc("event_id")], 6)
    one, two = labels.share_label(v, 0.3, rank="rank"), labels.share_label(v, seconds=30.0, skip=("unk", "clean"), rank="rank")
    return one.withColumnRenamed("label", "label_share").join(two.withColumnRenamed("label", "label_seconds"), "uid")


def _in(codes: tuple[int, ...]) -> str:
    return f"len(list_filter(codes, lambda c: c IN ({', '.join(map(str, codes))})))"


_V6 = f"""v6 AS (SELECT uid, tag, standing_time, {_in(labels.POSITIVE_CODES)} AS good, {_in((11,))} AS bad, row_number() OVER (PARTITION BY uid ORDER BY ts DESC, event_id DESC) AS n FROM ev JOIN tags USING (post_id) WHERE kind = 'view'),
t6 AS (SELECT uid, tag, sum(standing_time) AS stood, sum(good) AS good, sum(bad) AS bad FROM v6 WHERE n <= 6 GROUP BY ALL), s6 AS (SELECT *, sum(stood) OVER (PARTITION BY uid) AS total FROM t6)"""
SHARE_SQL = f"""WITH {EV}, {TAGS}, {_V6}, a AS (SELECT uid, arg_max(tag, stood) FILTER (WHERE (coalesce(stood / nullif(total, 0) > 0.3, false) OR good > 0) AND bad <= 0) AS x, arg_max(tag, stood) FILTER (WHERE (stood >= 30 OR good > 0) AND bad <= 0 AND tag NOT IN ('unk', 'clean')) AS y FROM s6 GROUP BY uid)
SELECT uid, 'u_ylevel_' || coalesce(x, 'unk') AS label_share, 'u_ylevel_' || coalesce(y, 'unk') AS label_seconds FROM a"""

def _picked(spark: SparkSession, d: str) -> DataFrame:
    """Tags picked from each user's last twelve views, as of the last of them; actions count on posts first seen in the
    three days before."""
    v = tagged_views(spark, d).withColumn("first_ts", F.min("ts").over(W.partitionBy("uid", "post_id"))).withColumn("as_of", F.max("ts").over(W.partitionBy("uid")))
    v = topk.top_rows(v, ["uid"], [F.desc("ts"), F.desc("event_id")], 12)
    return labels.pick_tags(labels.tag_statistics(v, F.col("as_of"), dislikes=(7, 11), fresh_minutes=60 * 24 * 3))


def tag_label_picks(spark: SparkSession, d: str) -> DataFrame:
    p = labels.feedback_of(_picked(spark, d))
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return p.select("uid", F.coalesce("positive_tag", F.lit("-")).alias("positive_tag"), text("positive_posts").alias("positive_posts"), F.coalesce("negative_tag", F.lit("-")).alias("negative_tag"), text("negative_posts").alias("negative_posts"), "feedback")


_P = f"""v0 AS (SELECT ev.*, tag, row_number() OVER (PARTITION BY uid ORDER BY ts DESC, event_id DESC) AS n, min(ts) OVER (PARTITION BY uid, post_id) > max(ts) OVER (PARTITION BY uid) - INTERVAL 3 DAYS AS fresh FROM ev JOIN tags USING (post_id) WHERE kind = 'view'),
p AS (SELECT uid, tag, post_id, sum(standing_time) AS stood, sum(progress_time) AS prog, bool_or(fresh AND {has_sql(*labels.POSITIVE_CODES)}) AS good, bool_or(fresh AND {has_sql(*labels.NEGATIVE_CODES)}) AS bad, bool_or(fresh AND {has_sql(7, 11)}) AS dis FROM v0 WHERE n <= 12 GROUP BY ALL), q AS (SELECT *, stood < 3 AND prog < 3 AS short FROM p),
st AS (SELECT uid, tag, CASE tag WHEN 'explicit' THEN 3 WHEN 'high' THEN 2 WHEN 'mid' THEN 1 ELSE 0 END AS level, max(stood) AS longest, count(*) FILTER (WHERE good) AS pos, count(*) FILTER (WHERE bad OR short) AS neg, count(*) FILTER (WHERE dis) AS dislikes, count(*) FILTER (WHERE short) AS shorts,
  coalesce(string_agg(CAST(post_id AS VARCHAR), ',' ORDER BY post_id) FILTER (WHERE good OR stood >= 10), '') AS pp, coalesce(string_agg(CAST(post_id AS VARCHAR), ',' ORDER BY post_id) FILTER (WHERE bad OR short), '') AS np FROM q GROUP BY uid, tag),
k AS (SELECT uid, arg_max(tag, level) FILTER (WHERE (longest >= 10 OR pos > 0) AND neg <= 0) AS pt, arg_max(pp, level) FILTER (WHERE (longest >= 10 OR pos > 0) AND neg <= 0) AS pp, arg_min(tag, level) FILTER (WHERE shorts >= 5 OR dislikes >= 1) AS nt, arg_min(np, level) FILTER (WHERE shorts >= 5 OR dislikes >= 1) AS np
  FROM st WHERE tag NOT IN ('unk', 'clean') GROUP BY uid)"""
PICK_SQL = f"WITH {EV}, {TAGS}, {_P} SELECT uid, coalesce(pt, '-') AS positive_tag, coalesce(pp, '') AS positive_posts, coalesce(nt, '-') AS negative_tag, coalesce(np, '') AS negative_posts, CASE WHEN nt IS NOT NULL THEN 'negative' WHEN pt IS NOT NULL THEN 'positive' ELSE 'none' END AS feedback FROM k"


def label_writes(spark: SparkSession, d: str) -> DataFrame:
    """What to write given labels stored before."""
    p = _picked(spark, d)
    lab = F.element_at(F.array(*[F.lit(x) for x in ("u_ylevel_mid", "u_ylevel_high", "u_ylevel_explicit")]), (F.col("uid") % 3 + 1).cast("int"))
    low = F.element_at(F.array(*[F.lit(x) for x in ("u_ylevel_explicit", "u_ylevel_mid")]), (F.col("uid") % 2 + 1).cast("int"))
    stored = p.filter(F.col("uid") % 4 > 0).select("uid", lab.alias("pos_label"), F.when(F.col("uid") % 5 == 0, F.col("positive_posts")).otherwise(F.array().cast("array<bigint>")).alias("pos_posts"), F.when(F.col("uid") % 4 > 1, low).alias("neg_label"), F.when(F.col("uid") % 5 == 0, F.col("negative_posts")).otherwise(F.array().cast("array<bigint>")).alias("neg_posts"))
    return labels.write_decision(p, stored).select("uid", "new_pos", "write_pos", F.coalesce("new_neg", F.lit("-")).alias("new_neg"), "write_neg")


WRITES_SQL = f"""WITH {EV}, {TAGS}, {_P}, o AS (SELECT *, CASE WHEN uid % 4 > 0 THEN ['u_ylevel_mid', 'u_ylevel_high', 'u_ylevel_explicit'][CAST(uid % 3 + 1 AS INTEGER)] END AS po, CASE WHEN uid % 4 > 1 THEN ['u_ylevel_explicit', 'u_ylevel_mid'][CAST(uid % 2 + 1 AS INTEGER)] END AS no_, uid % 4 > 0 AND uid % 5 = 0 AS kept,
  'u_ylevel_' || coalesce(pt, 'unk') AS p0, 'u_ylevel_' || nt AS nn FROM k),
l AS (SELECT *, CASE WHEN po LIKE '%explicit' THEN 3 WHEN po LIKE '%high' THEN 2 WHEN po LIKE '%mid' THEN 1 ELSE 0 END AS lpo, CASE WHEN no_ LIKE '%explicit' THEN 3 WHEN no_ LIKE '%mid' THEN 1 ELSE 0 END AS lno, CASE WHEN nn LIKE '%explicit' THEN 3 WHEN nn LIKE '%high' THEN 2 WHEN nn LIKE '%mid' THEN 1 ELSE 0 END AS lnn FROM o),
f AS (SELECT *, lnn >= 2 AND po IS NOT NULL AS forced, lnn >= 2 OR lno >= 2 AS guard FROM l), n AS (SELECT *, CASE WHEN forced THEN 'u_ylevel_mid' ELSE p0 END AS np_ FROM f),
m AS (SELECT *, CASE WHEN np_ LIKE '%explicit' THEN 3 WHEN np_ LIKE '%high' THEN 2 WHEN np_ LIKE '%mid' THEN 1 ELSE 0 END AS lnp, coalesce(po = np_ AND (CASE WHEN kept THEN coalesce(pp, '') ELSE '' END) = coalesce(pp, ''), false) AS samep, coalesce(no_ = nn AND (CASE WHEN kept THEN coalesce(np, '') ELSE '' END) = coalesce(np, ''), false) AS samen FROM n)
SELECT uid, np_ AS new_pos, np_ <> 'u_ylevel_unk' AND NOT samep AND (((no_ IS NULL OR lnp < lno) AND (CASE WHEN guard THEN lnp <= 1 ELSE po IS NULL OR lnp >= lpo END)) OR (forced AND lnp <= 1)) AS write_pos, coalesce(nn, '-') AS new_neg, coalesce(nn IS NOT NULL AND (no_ IS NULL OR (lnn <= lno AND NOT samen)), false) AS write_neg FROM m"""


def kv_writes(spark: SparkSession, d: str) -> DataFrame:
    """A key-value table after strings, hash fields, hashes replaced whole (of users who bought from an author of the first
    five), a list and a set were written, expired entries gone."""
    e = events(spark, d).select("event_id", "uid", "post_id", "author", "event_type")
    t0, t1 = F.expr("timestamp'2024-02-01 00:00:00'"), F.expr("timestamp'2024-02-01 01:00:00'")
    none = spark.createDataFrame([], "key string, field string, value string, seq long, updated_at timestamp, expires_at timestamp")
    key = lambda p: F.concat(F.lit(p), F.col("uid").cast("string"))
    a = kv.set_strings(none, e.filter("event_type = 'click'").select(key("s").alias("key"), F.col("post_id").cast("string").alias("value"), "event_id"), t0, 600, "event_id")
    b = kv.set_strings(a, e.filter("event_type = 'view'").select(key("s").alias("key"), F.col("post_id").cast("string").alias("value"), "event_id"), t1, 600, "event_id")
    c = kv.set_fields(b, e.filter("event_type = 'purchase'").select(key("h").alias("key"), F.col("author").cast("string").alias("field"), F.col("post_id").cast("string").alias("value"), "event_id"), t1, None, "event_id")
    h = kv.set_fields(c, e.filter("event_type = 'purchase' and author <= 5").select(key("h").alias("key"), F.concat(F.lit("new"), F.col("author").cast("string")).alias("field"), F.col("post_id").cast("string").alias("value"), "event_id"), t1, None, "event_id", replace=True)
    s = kv.add_members(h, e.filter("event_type = 'error'").select(key("m").alias("key"), F.col("author").cast("string").alias("value")), t1, None)
    p = kv.push(s, e.filter("event_type = 'signup'").select(key("l").alias("key"), F.col("post_id").cast("string").alias("value"), "event_id"), t1, None, "event_id")
    return kv.alive(p, t1).select("key", "field", "value", "seq")


KV_SQL = f"""WITH {EV}, r AS (SELECT *, row_number() OVER (PARTITION BY uid, event_type ORDER BY event_id DESC) AS n, row_number() OVER (PARTITION BY uid, event_type ORDER BY event_id) AS m, row_number() OVER (PARTITION BY uid, author, event_type ORDER BY event_id DESC) AS na FROM ev)
SELECT concat('s', uid) AS key, '' AS field, CAST(post_id AS VARCHAR) AS value, 0::BIGINT AS seq FROM r WHERE event_type = 'view' AND n = 1
UNION ALL SELECT concat('h', uid), CASE WHEN low THEN concat('new', author) ELSE CAST(author AS VARCHAR) END, CAST(post_id AS VARCHAR), 0 FROM (SELECT *, bool_or(event_type = 'purchase' AND author <= 5) OVER (PARTITION BY uid) AS low FROM r) WHERE event_type = 'purchase' AND na = 1 AND (author <= 5 OR NOT low)
UNION ALL SELECT DISTINCT concat('m', uid), CAST(author AS VARCHAR), CAST(author AS VARCHAR), 0 FROM r WHERE event_type = 'error'
UNION ALL SELECT concat('l', uid), '[]', CAST(post_id AS VARCHAR), m - 1 FROM r WHERE event_type = 'signup'"""


def kv_scan(spark: SparkSession, d: str) -> DataFrame:
    """Values by key pattern and kind: strings, heads of lists, least members of sets, first fields' values of hashes."""
    e = events(spark, d)
    now = F.expr("timestamp'2024-02-01 00:00:00'")
    none = spark.createDataFrame([], "key string, field string, value string, seq long, updated_at timestamp, expires_at timestamp")
    rows = lambda kind: e.select(F.concat(F.lit(f"{kind}:"), F.col("author").cast("string")).alias("key"), F.col("post_id").cast("string").alias("value"), F.col("uid").cast("string").alias("field"), "event_id")
    t = kv.push(none, rows("list").drop("field"), now, 60, "event_id", left=True)
    t = kv.set_strings(t, rows("string").drop("field"), now, 60, "event_id")
    t = kv.add_members(t, rows("set"), now, 60)
    t = kv.set_fields(t, rows("hash"), now, None, "event_id")
    parts = [kv.scan(t, f"{kind}:1%", now, kind).withColumn("kind", F.lit(kind)) for kind in ("string", "list", "set", "hash")]
    return joins.unite(*parts)


_SCAN = {
    "list": "CAST(arg_max(post_id, event_id) AS VARCHAR)",
    "string": "CAST(arg_max(post_id, event_id) AS VARCHAR)",
    "set": "min(CAST(post_id AS VARCHAR))",
    "hash": "CAST(arg_max(post_id, event_id) FILTER (WHERE CAST(uid AS VARCHAR) = low) AS VARCHAR)",
}
KV_SCAN_SQL = f"WITH {EV}, x AS (SELECT *, min(CAST(uid AS VARCHAR)) OVER (PARTITION BY author) AS low FROM ev) " + " UNION ALL ".join(
    f"SELECT concat('{kind}:', author) AS key, {v} AS value, '{kind}' AS kind FROM x WHERE CAST(author AS VARCHAR) LIKE '1%' GROUP BY author" for kind, v in _SCAN.items()
)


def hot_keys(spark: SparkSession, d: str) -> DataFrame:
    return skew.hot_keys(events(spark, d).withColumn("key", F.when(F.col("k") < 60, F.lit(0)).otherwise(F.col("k"))), "key", 3.0, 1000, 10)


HOT_SQL = f"WITH {EV}, n AS (SELECT CASE WHEN k < 60 THEN 0 ELSE k END AS key, count(*) AS n FROM ev GROUP BY ALL), m AS (SELECT avg(n) AS mean FROM n) SELECT key, n, round(mean, 6) AS mean FROM n, m WHERE n >= 3 * mean AND n >= 1000 ORDER BY n DESC, key LIMIT 10"


def window_key_shares(spark: SparkSession, d: str) -> DataFrame:
    s = skew.window_shares(events(spark, d), "kind", "1 hour", 0.7, 5)
    return s.select("kind", "n", "total", F.unix_seconds("window_end").alias("window_end"))


SHARES_SQL = f"WITH {EV}, {windows_sql(3600, 3600)}, n AS (SELECT window_end, kind, count(*) AS n FROM w GROUP BY ALL), t AS (SELECT window_end, CAST(sum(n) AS BIGINT) AS total FROM n GROUP BY ALL) SELECT kind, n, total, n.window_end FROM n JOIN t ON n.window_end = t.window_end WHERE total >= 5 AND n >= 0.7 * total"


def salted_counts(spark: SparkSession, d: str) -> DataFrame:
    return skew.salted(events(spark, d), ["kind"], {"n": F.count("*"), "s": F.sum("event_id")}, {"n": F.sum("n"), "id_sum": F.sum("s")}, 10, "event_id")


def window_hot_users(spark: SparkSession, d: str) -> DataFrame:
    """Users with a fiftieth of a day's events, found by sketches and counted exactly."""
    h = skew.window_hot_keys(events(spark, d), "uid", 0.02, "1 day")
    return h.select("uid", "n", "total", F.unix_seconds("window_end").alias("window_end"))


HOT_USERS_SQL = f"WITH {EV}, {windows_sql(86400, 86400)}, n AS (SELECT window_end, uid, count(*) AS n FROM w GROUP BY ALL), t AS (SELECT window_end, CAST(sum(n) AS BIGINT) AS total FROM n GROUP BY ALL) SELECT uid, n, total, n.window_end FROM n JOIN t ON n.window_end = t.window_end WHERE n >= 0.02 * total"


def salted_hot_counts(spark: SparkSession, d: str) -> DataFrame:
    """Events, users and sums by a key that holds more than half of the rows in one value; only that value's rows are spread."""
    e = events(spark, d).withColumn("key", F.when(F.col("k") < 60, F.lit(0)).otherwise(F.col("k")))
    parts = {"n": F.count("*"), "users": F.count_distinct("uid"), "s": F.sum("event_id")}
    return skew.salted_hot(e, ["key", "kind"], parts, {"n": F.sum("n"), "users": F.sum("users"), "id_sum": F.sum("s")}, 0.05, salt_by="uid")


HOT_COUNTS_SQL = f"WITH {EV} SELECT CASE WHEN k < 60 THEN 0 ELSE k END AS key, kind, count(*) AS n, count(DISTINCT uid) AS users, CAST(sum(event_id) AS BIGINT) AS id_sum FROM ev GROUP BY ALL"


_SALTED_SQL = f"WITH {EV} SELECT kind, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum FROM ev GROUP BY kind"
SQL = {
    "parsed_feature_events": PARSED_SQL,
    "exposure_device_rows": DEVICE_SQL,
    "event_type_filter": TYPE_SQL,
    "parsed_tags": TAGS_SQL,
    "parsed_valid_posts": VALID_SQL,
    "parsed_client_posts": CLIENT_SQL,
    "client_views": CLIENT_VIEWS_SQL,
    "prompt_refusals": PROMPT_SQL,
    "parsed_live_events": LIVE_SQL,
    "parsed_live_watches": LIVE_WATCH_SQL,
    "view_feedback": FEEDBACK_SQL,
    "scalar_values": SCALAR_SQL,
    "tag_lookup": LOOKUP_SQL,
    "user_type_lookup": USER_TYPE_SQL,
    "listed_anchors": ANCHOR_SQL,
    "cohort_interactions": COHORT_SQL,
    "user_history": HISTORY_SQL,
    "cf_session_scores": CF_SESSION_SQL,
    "cf_index": CF_INDEX_SQL,
    "share_labels": SHARE_SQL,
    "tag_label_picks": PICK_SQL,
    "label_writes": WRITES_SQL,
    "kv_writes": KV_SQL,
    "kv_scan": KV_SCAN_SQL,
    "hot_keys": HOT_SQL,
    "window_key_shares": SHARES_SQL,
    "salted_counts": _SALTED_SQL,
    "window_hot_users": HOT_USERS_SQL,
    "salted_hot_counts": HOT_COUNTS_SQL,
    "weighted_history": WEIGHTED_HISTORY_SQL,
    "weighted_pairs": WEIGHTED_PAIRS_SQL,
}
QUERIES = {n: globals()[n] for n in SQL}
