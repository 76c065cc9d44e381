"""Registered replays of the stateful operators, and the SQL of their results: recursive queries where a state depends on
the one before, closed forms where it doesn't. Bounds are small where the events are few, so that they bite."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import scalars as X
from tidemark.operators import joins, labels, parse
from tidemark.operators.aggregates import BAD, GOOD, RECENT_LISTS
from tidemark.plans.domain import EV, FLAG_CODES, LIVE, SESSIONS, TAGS, events, has_sql, live, post_events, tags
from tidemark.plans.feature_queries import FB
from tidemark.plans.window_queries import fixed, fixed_sql, session_marks_sql, sessions
from tidemark.streaming import chains, stateful, steps

HOUR = 3_600_000
_NUMBERED = "row_number() OVER (PARTITION BY uid ORDER BY ms, fb, tag) AS n"


def _uid() -> Column:
    return F.col("key").cast("long").alias("uid")


def _rated(spark: SparkSession, d: str) -> DataFrame:
    """Events with interactions as likes or dislikes with the tag they speak for or against."""
    e = joins.with_tags(events(spark, d).filter(F.size("interactions") > 0), tags(spark, d), X.sensitivity_tag)
    bad = labels.any_code(labels.NEGATIVE_CODES)
    kind = F.element_at(F.array(*[F.lit(x) for x in ("no_zone", "block", "zone")]), (F.col("uid") % 3 + 1).cast("int"))
    return e.select("uid", "ts", F.when(bad, "negative").otherwise("positive").alias("feedback"), kind.alias("user_type"), F.when(~bad, F.col("tag")).alias("pos_tag"), F.when(bad, F.col("tag")).alias("neg_tag"))


_STATE = "stage string, probe_count int, cooldown_stage int, cooldown_end_ts long, user_type string, last_feedback string, last_feedback_ts long, last_pos_tag string, last_neg_tag string"


def state_machine_replay(spark: SparkSession, d: str) -> DataFrame:
    """Each user's last state after all likes and dislikes."""
    r = stateful.replay(_rated(spark, d), "uid", ["user_type", "feedback", "pos_tag", "neg_tag"], steps.sensitivity, final_only=True)
    return r.select(_uid(), F.from_json("value", _STATE).alias("s")).select("uid", "s.*")


_MACHINE = f"""e AS (SELECT *, {_NUMBERED} FROM (SELECT uid, epoch_us(ts) // 1000 AS ms, CASE WHEN {has_sql(*labels.NEGATIVE_CODES)} THEN 'negative' ELSE 'positive' END AS fb, tag, ['no_zone', 'block', 'zone'][CAST(uid % 3 + 1 AS INTEGER)] AS ut
  FROM ev JOIN tags USING (post_id) WHERE len(codes) > 0)),
r(uid, n, stage, probe, cs, ce) AS (SELECT DISTINCT uid, 0::BIGINT, 'probing_mid', 0::BIGINT, 0::BIGINT, 0::BIGINT FROM e
  UNION ALL SELECT uid, n, CASE WHEN to_cool THEN 'cooling' ELSE next END, CASE WHEN to_cool THEN probes WHEN next IN ('stable') AND was <> 'stable' THEN 0 ELSE probe END,
    CASE WHEN to_cool THEN level WHEN next = 'stable' AND was <> 'stable' THEN 0 ELSE cs END,
    CASE WHEN to_cool THEN ist - ist % 86400000 + 72000000 + CASE WHEN ist % 86400000 < 72000000 THEN 0 ELSE 86400000 END - 19800000 WHEN next = 'stable' AND was <> 'stable' THEN 0 ELSE ce END
  FROM (SELECT *, ms + 19800000 + 86400000 * (CASE WHEN ut = 'block' THEN [1, 3, 7] ELSE [3, 7, 14] END)[CAST(least(greatest(level, 1), 3) AS INTEGER)] AS ist FROM (
    SELECT *, fb = 'negative' AND ut <> 'zone' AND was <> 'cooling' AS to_cool,
      CASE WHEN ut = 'zone' THEN 'probing_mid' WHEN was = 'cooling' THEN 'cooling' WHEN fb = 'positive' AND was = 'probing_high' THEN 'stable' WHEN fb = 'positive' AND was <> 'stable' THEN 'probing_high' ELSE was END AS next,
      CASE WHEN was = 'stable' THEN greatest(probe, 2) ELSE probe + 1 END AS probes,
      CASE WHEN was = 'stable' THEN 3 ELSE greatest(CASE WHEN was = 'probing_high' THEN 2 ELSE 1 END, probe + 1) END AS level
    FROM (SELECT r.uid, e.n, e.ms, e.fb, e.ut, r.probe, CASE WHEN r.stage = 'cooling' AND e.ms >= r.ce THEN 'probing_mid' ELSE r.stage END AS was,
        CASE WHEN r.stage = 'cooling' AND e.ms >= r.ce THEN 0 ELSE r.cs END AS cs, CASE WHEN r.stage = 'cooling' AND e.ms >= r.ce THEN 0 ELSE r.ce END AS ce
      FROM r JOIN e ON e.uid = r.uid AND e.n = r.n + 1)))),
last AS (SELECT r.uid, stage, CAST(probe AS INTEGER) AS probe_count, CAST(cs AS INTEGER) AS cooldown_stage, ce AS cooldown_end_ts, ut AS user_type, fb AS last_feedback, ms AS last_feedback_ts,
  CASE WHEN fb = 'positive' THEN tag ELSE 'unk' END AS last_pos_tag, CASE WHEN fb = 'negative' THEN tag ELSE 'unk' END AS last_neg_tag
  FROM r JOIN e ON r.uid = e.uid AND r.n = e.n WHERE e.n = (SELECT max(n) FROM e x WHERE x.uid = r.uid))"""
MACHINE_SQL = f"WITH RECURSIVE {EV}, {TAGS}, {_MACHINE} SELECT * FROM last"


def state_key_rows(spark: SparkSession, d: str) -> DataFrame:
    """The twelve keys of each user's state."""
    s = state_machine_replay(spark, d).withColumns({"dist": X.stage_distribution("stage"), "last_update_ts": F.col("last_feedback_ts")})
    parts = {n: n for n in ("user_type", "stage", "dist")} | {"probe_round": "probe_count", "cooling_stage": "cooldown_stage", "cooling_end_ts": "cooldown_end_ts"}
    parts |= {n: n for n in ("last_feedback", "last_feedback_ts", "last_pos_tag", "last_neg_tag", "last_update_ts")}
    return labels.state_rows(s.withColumn("state_flow", X.flow_text("v5", **parts)))


_DIST = "CASE stage WHEN 'probing_mid' THEN 'mid2_high0' WHEN 'probing_high' THEN 'mid1_high1' WHEN 'stable' THEN 'mid0_high2' ELSE 'mid1_high0' END"
_KEYS = {n: n for n in ("user_type", "stage", "dist", "probe_count", "cooldown_end_ts", "cooldown_stage", "last_feedback", "last_feedback_ts", "last_pos_tag", "last_neg_tag")} | {"last_update_ts": "last_feedback_ts"}
_KEYS |= {"state_flow": """concat('v5;user_type=', user_type, ';stage=', stage, ';dist=', dist, ';probe_round=', probe_count, ';cooling_stage=', cooldown_stage, ';cooling_end_ts=', cooldown_end_ts, ';last_feedback=', last_feedback,
  ';last_feedback_ts=', last_feedback_ts, ';last_pos_tag=', last_pos_tag, ';last_neg_tag=', last_neg_tag, ';last_update_ts=', last_feedback_ts)"""}
KEYS_SQL = f"WITH RECURSIVE {EV}, {TAGS}, {_MACHINE}, z AS (SELECT *, {_DIST} AS dist FROM last) " + " UNION ALL ".join(f"SELECT 'rec_post:{{' || uid || '}}:porn_{n}_v5' AS key, CAST({v} AS VARCHAR) AS value FROM z" for n, v in _KEYS.items())


def _replayed(spark: SparkSession, d: str, step, feedback: DataFrame) -> DataFrame:
    e = joins.with_tags(feedback, tags(spark, d), X.prioritized_tag, None)
    return stateful.replay(e, "uid", ["feedback", "tag", "author"], step, final_only=True)


def _pairs(queue: str, value=None) -> Column:
    """``key:value,..`` of a list of pairs read as texts."""
    return F.array_join(F.transform(queue, lambda x: F.concat_ws(":", x[0], value(x[1]) if value else x[1])), ",")


_QUEUES = ("positive_tags", "negative_tags", "positive_authors", "negative_authors")


def feedback_queue_replay(spark: SparkSession, d: str) -> DataFrame:
    r = _replayed(spark, d, steps.feedback_queues, parse.feedback(events(spark, d)))
    r = r.select(_uid(), F.from_json("value", ", ".join(f"{n} array<array<string>>" for n in _QUEUES)).alias("q"))
    return r.select("uid", *[_pairs(f"q.{n}").alias(n) for n in _QUEUES])


#: ``e``: a user's feedback in order; ``k``: the same for tags and for authors, by key.
_KEYED = f"""e AS (SELECT *, {_NUMBERED} FROM (SELECT uid, us // 1000 AS ms, feedback AS fb, prior AS tag, author FROM fb JOIN tags USING (post_id))),
k AS (SELECT uid, ms, fb, n, 'tags' AS kind, tag AS key FROM e UNION ALL SELECT uid, ms, fb, n, 'authors', CAST(author AS VARCHAR) FROM e)"""
QUEUE_SQL = f"""WITH RECURSIVE {EV}, {TAGS}, {FB}, {_KEYED}, w AS (SELECT *, CASE fb WHEN 'positive' THEN CASE kind WHEN 'tags' THEN '1.2' ELSE '1.0' END WHEN 'short' THEN CASE kind WHEN 'tags' THEN '0.5' ELSE '0.1' END ELSE '0.1' END AS weight FROM k),
r(uid, kind, n, up, down) AS (SELECT DISTINCT uid, kind, 0::BIGINT, []::STRUCT(k VARCHAR, w VARCHAR)[], []::STRUCT(k VARCHAR, w VARCHAR)[] FROM w
  UNION ALL SELECT r.uid, r.kind, w.n,
    CASE WHEN fb <> 'positive' THEN list_filter(up, lambda x: x.k <> key) WHEN list_contains(list_transform(down, lambda x: x.k), key) THEN up ELSE list_append(list_filter(up, lambda x: x.k <> key), {{'k': key, 'w': weight}})[-5:] END,
    CASE WHEN fb = 'positive' THEN down ELSE list_append(list_filter(down, lambda x: x.k <> key), {{'k': key, 'w': weight}})[-5:] END
  FROM r JOIN w ON w.uid = r.uid AND w.kind = r.kind AND w.n = r.n + 1),
t AS (SELECT uid, kind, array_to_string(list_transform(up, lambda x: x.k || ':' || x.w), ',') AS up, array_to_string(list_transform(down, lambda x: x.k || ':' || x.w), ',') AS down FROM r WHERE n = (SELECT max(n) FROM e WHERE e.uid = r.uid))
SELECT a.uid, coalesce(a.up, '') AS positive_tags, coalesce(a.down, '') AS negative_tags, coalesce(b.up, '') AS positive_authors, coalesce(b.down, '') AS negative_authors FROM t a JOIN t b ON a.uid = b.uid AND a.kind = 'tags' AND b.kind = 'authors'"""


def short_view_tag_replay(spark: SparkSession, d: str) -> DataFrame:
    r = _replayed(spark, d, steps.negative_tags, parse.short_views(events(spark, d)))
    return r.select(_uid(), F.array_join(F.from_json(F.get_json_object("value", "$.tags"), "array<string>"), ",").alias("tags"))


SHORT_SQL = f"""WITH {EV}, {TAGS}, t AS (SELECT uid, prior AS tag, max(epoch_us(ts)) AS us FROM ev JOIN tags USING (post_id) WHERE kind = 'view' AND progress_time > 0 AND progress_time < 3 GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY us DESC) AS n FROM t) SELECT uid, string_agg(tag, ',' ORDER BY us) AS tags FROM r WHERE n <= 5 GROUP BY uid"""


def weighted_interest_replay(spark: SparkSession, d: str) -> DataFrame:
    """Weights in millionths."""
    r = _replayed(spark, d, steps.weighted_interests, parse.feedback(events(spark, d)))
    r = r.select(_uid(), F.from_json("value", "tags array<array<string>>, authors array<array<string>>").alias("q"))
    millionths = lambda w: F.floor(w.cast("double") * 1_000_000 + 0.5).cast("string")
    return r.select("uid", *[_pairs(f"q.{n}", millionths).alias(n) for n in ("tags", "authors")])


_ENTRY = "STRUCT(t BIGINT, k VARCHAR, up DOUBLE, down DOUBLE)"
_FADED = lambda now: f"{{'up': x.up * pow(0.5, ({now} - x.t) / 3600000.0 / 6), 'down': x.down * pow(0.5, ({now} - x.t) / 3600000.0 / 24)}}"
INTEREST_SQL = f"""WITH RECURSIVE {EV}, {TAGS}, {FB}, {_KEYED}, w AS (SELECT *, CASE fb WHEN 'positive' THEN 0.3 WHEN 'short' THEN 0.2 ELSE 0.5 END::DOUBLE AS weight FROM k),
r(uid, kind, n, held) AS (SELECT DISTINCT uid, kind, 0::BIGINT, []::{_ENTRY}[] FROM w
  UNION ALL SELECT uid, kind, n, list_sort(list_append(CASE WHEN known IS NULL AND len(rest) >= 10 THEN rest[2:] ELSE rest END,
      {{'t': ms, 'k': key, 'up': coalesce(known.up, 0) + CASE WHEN fb = 'positive' THEN weight ELSE 0 END, 'down': coalesce(known.down, 0) + CASE WHEN fb = 'positive' THEN 0 ELSE weight END}}::{_ENTRY}))
  FROM (SELECT r.uid, r.kind, w.n, w.ms, w.key, w.fb, w.weight, list_filter(r.held, lambda x: x.k <> w.key) AS rest, list_transform(list_filter(r.held, lambda x: x.k = w.key), lambda x: {_FADED("w.ms")})[1] AS known
    FROM r JOIN w ON w.uid = r.uid AND w.kind = r.kind AND w.n = r.n + 1)),
f AS (SELECT r.uid, r.kind, unnest(held) AS x, e.ms FROM r JOIN e ON e.uid = r.uid AND e.n = r.n WHERE r.n = (SELECT max(n) FROM e z WHERE z.uid = r.uid)),
g AS (SELECT uid, kind, x.k AS key, x.up * pow(0.5, (ms - x.t) / 3600000.0 / 6) - x.down * pow(0.5, (ms - x.t) / 3600000.0 / 24) AS net FROM f),
h AS (SELECT *, CASE WHEN net > 0 THEN 1 + 1 / (1 + exp(-net)) WHEN net < 0 THEN 1 / (1 + exp(net)) ELSE 1.0 END AS w FROM g),
o AS (SELECT *, row_number() OVER (PARTITION BY uid, kind ORDER BY round(w, 6) DESC, key) AS no FROM h WHERE abs(w - 1) > 0.01),
t AS (SELECT uid, string_agg(concat(key, ':', CAST(floor(round(w, 6) * 1000000 + 0.5) AS BIGINT)), ',' ORDER BY no) FILTER (WHERE kind = 'tags') AS tags, string_agg(concat(key, ':', CAST(floor(round(w, 6) * 1000000 + 0.5) AS BIGINT)), ',' ORDER BY no) FILTER (WHERE kind = 'authors') AS authors FROM o WHERE no <= 10 GROUP BY uid)
SELECT u.uid, coalesce(tags, '') AS tags, coalesce(authors, '') AS authors FROM (SELECT DISTINCT uid FROM e) u LEFT JOIN t ON t.uid = u.uid"""


def recent_anchor_replay(spark: SparkSession, d: str) -> DataFrame:
    """After each contact, the last three anchors of the last twelve hours."""
    r = stateful.replay(live(spark, d), "uid", ["event", "anchor_id"], lambda s, e: steps.recent_anchors(s, e, 3, 12 * HOUR))
    return r.select(_uid(), "ts", F.translate(F.get_json_object("value", "$.anchors"), "[] ", "").alias("anchors"))


RECENT_SQL = f"""WITH {LIVE}, c AS (SELECT uid, anchor_id, epoch_us(ts) // 1000 AS ms, row_number() OVER (PARTITION BY uid ORDER BY epoch_us(ts) // 1000, event, anchor_id) AS n FROM live WHERE event IN ('live_exposure', 'enter_liveroom')),
p AS (SELECT i.uid, i.n, i.ms, j.anchor_id, max(j.n) AS last FROM c i JOIN c j ON i.uid = j.uid AND j.n <= i.n AND j.ms + {12 * HOUR} >= i.ms GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY uid, n ORDER BY last DESC) AS no FROM p) SELECT uid, ms AS ts, string_agg(CAST(anchor_id AS VARCHAR), ',' ORDER BY last) AS anchors FROM r WHERE no <= 3 GROUP BY uid, n, ms"""


def last_posts_replay(spark: SparkSession, d: str) -> DataFrame:
    """The last ten distinct posts of a user by first time seen, by a state: a post that fell out comes in again."""
    r = stateful.replay(events(spark, d), "uid", ["post_id"], lambda s, x: steps.last_distinct(s, x, 10), final_only=True)
    return r.select(_uid(), F.translate(F.get_json_object("value", "$.posts"), "[] ", "").alias("posts"))


LAST_POSTS_SQL = f"""WITH RECURSIVE {EV}, e AS (SELECT uid, post_id, row_number() OVER (PARTITION BY uid ORDER BY epoch_us(ts) // 1000, CAST(post_id AS VARCHAR)) AS n FROM ev),
r(uid, n, posts) AS (SELECT DISTINCT uid, 0::BIGINT, []::BIGINT[] FROM e UNION ALL SELECT r.uid, e.n, CASE WHEN list_contains(posts, post_id) THEN posts ELSE list_append(posts, post_id)[-10:] END FROM r JOIN e ON e.uid = r.uid AND e.n = r.n + 1)
SELECT uid, array_to_string(posts, ',') AS posts FROM r WHERE n = (SELECT max(n) FROM e WHERE e.uid = r.uid) AND len(posts) >= 2"""

_STRONG = f"complete or {GOOD} or {BAD}"


def early_session_replay(spark: SparkSession, d: str) -> DataFrame:
    """First strong signals and ends of sessions of 6 hours."""
    e = post_events(spark, d).withColumn("key", F.concat_ws("|", "rec_token", "post_id")).withColumn("strong", F.expr(_STRONG))
    r = stateful.replay(e, "key", ["standing_time", "progress_time", "playback_time", "strong"], lambda s, x: steps.early_session(s, x, 6 * HOUR), close=True)
    j = F.from_json("value", "start long, last long, standing double, progress double, playback double, strong boolean, is_final boolean").alias("s")
    return r.select("key", j).select("key", "s.start", "s.last", fixed("s.standing", 4).alias("standing"), "s.progress", fixed("s.playback", 4).alias("playback"), "s.strong", "s.is_final")


_ANY = f"(progress_time >= 100 OR {has_sql(1, 3, 6, 5, 13, 15, 7, 11, 10)} OR standing_time > 10 OR progress_time > 8)"
EARLY_SQL = f"""WITH {EV}, g AS (SELECT concat(rec_token, '|', post_id) AS key, epoch_us(ts) // 1000 AS ms, standing_time AS st, progress_time AS pr, {_ANY} AS hit, event_id FROM ev),
f AS (SELECT *, CASE WHEN ms - lag(ms) OVER (PARTITION BY key ORDER BY ms, event_id) <= {6 * HOUR} THEN 0 ELSE 1 END AS fresh FROM g),
n AS (SELECT *, sum(fresh) OVER (PARTITION BY key ORDER BY ms, event_id ROWS UNBOUNDED PRECEDING) AS no FROM f),
c AS (SELECT *, min(ms) OVER w AS start, max(ms) OVER w AS last, sum(st) OVER w AS standing, max(pr) OVER w AS progress, sum(pr) OVER w AS playback, sum(hit::INTEGER) OVER w AS hits FROM n WINDOW w AS (PARTITION BY key, no ORDER BY ms, event_id ROWS UNBOUNDED PRECEDING))
SELECT key, start, last, {fixed_sql("standing", 4)} AS standing, progress, {fixed_sql("playback", 4)} AS playback, true AS strong, false AS is_final FROM c WHERE hit AND hits = 1
UNION ALL SELECT key, min(ms), max(ms), {fixed_sql("sum(st)", 4)}, max(pr), {fixed_sql("sum(pr)", 4)}, bool_or(hit), true FROM n GROUP BY key, no"""


def _entries(items) -> Column:
    """Ids, or ids with scores in hundredths, of a list as JSON texts."""
    pairs = F.transform(items, lambda i: F.split(F.translate(i, "[] ", ""), ","))
    return F.array_join(F.transform(pairs, lambda p: F.concat_ws(":", p[0], F.when(F.size(p) > 1, fixed(F.get(p, F.lit(1)).cast("double"), 2).cast("string")))), ",")


def latest_lists_of(posts: DataFrame) -> DataFrame:
    """The last state of each user's sixteen lists; sessions that enter no list change nothing."""
    posts = posts.withColumnsRenamed({"standing_time": "standing", "playback_time": "playback"})
    lists = F.struct(*[F.when(F.expr(cond), F.col(ident)).alias(n) for n, (ident, cond, _, _) in RECENT_LISTS.items()])
    scores = F.struct(*[F.col(score).alias(n) for n, (_, _, _, score) in RECENT_LISTS.items() if score])
    e = posts.filter(" or ".join(cond for _, cond, _, _ in RECENT_LISTS.values())).withColumns({"lists": lists, "scores": scores})
    sizes = {n: size for n, (_, _, size, _) in RECENT_LISTS.items()}
    return stateful.replay(e, "uid", ["lists", "scores"], lambda s, x: steps.latest_lists(s, x, sizes), final_only=True)


def latest_list_replay(spark: SparkSession, d: str) -> DataFrame:
    """Each user's lists after the last session, oldest first; scores in hundredths."""
    r = latest_lists_of(sessions(spark, d).withColumn("ts", F.col("last_ts")))
    x = r.select(_uid(), F.explode(F.from_json("value", "map<string,array<string>>")).alias("list", "items"))

    return x.select("uid", "list", _entries("items").alias("items"))


LATEST_SQL = f"""WITH {SESSIONS}, q AS (SELECT *, epoch_us(last_ts) // 1000 AS ms FROM s), m AS ({session_marks_sql("q", "uid, ms", ("skip",))}), top AS (SELECT uid, max(ms) AS now FROM m GROUP BY uid),
l AS (SELECT uid, list, k, id, max(ms) AS t, arg_max(score, ms) AS score FROM m GROUP BY uid, list, k, id),
r AS (SELECT l.*, row_number() OVER (PARTITION BY l.uid, list ORDER BY t DESC, id) AS n FROM l JOIN top ON l.uid = top.uid WHERE t + {12 * HOUR} >= now)
SELECT uid, list, string_agg(concat(id, CASE WHEN score IS NULL THEN '' ELSE ':' || CAST(floor(score * 100 + 0.3::DOUBLE) AS BIGINT) END), ',' ORDER BY n DESC) AS items FROM r WHERE n <= k GROUP BY uid, list"""


def session_list_replay(spark: SparkSession, d: str) -> DataFrame:
    """Early and final summaries of sessions of 6 hours drive their user's sixteen lists: the lists after each summary that enters
    one, oldest first, scores in hundredths. Of each list the last three stay, so that sizes bite."""
    r = chains.latest_user_lists(post_events(spark, d), 6 * HOUR, sizes=dict.fromkeys(RECENT_LISTS, 3))
    x = r.select(_uid(), "ts", F.from_json("value", "post_id long, final boolean, lists map<string,array<string>>").alias("v"))

    one = lambda e: F.concat(e["key"], F.lit("="), _entries(e["value"]))
    text = F.array_join(F.transform(F.array_sort(F.map_entries("v.lists")), one), ";")
    return x.select("uid", F.col("ts").alias("moment"), "v.post_id", "v.final", text.alias("lists"))


_FLAG_COLS = ", ".join(f'{has_sql(code)} AS "{n}"' for n, code in FLAG_CODES.items())
_RUN_FLAGS = ", ".join(f'bool_or("{n}") OVER w AS "{n}"' for n in ("complete", *FLAG_CODES))
_ALL_FLAGS = ", ".join(f'bool_or("{n}") AS "{n}"' for n in ("complete", *FLAG_CODES))
_TRIGGER = " OR ".join(f'"{n}"' for n in ("complete", *FLAG_CODES)) + " OR standing > 10 OR playback > 8"
SESSION_LIST_SQL = f"""WITH {EV}, g AS (SELECT concat(rec_token, '|', post_id) AS key, uid, post_id, author, epoch_us(ts) // 1000 AS ms, standing_time AS st, progress_time AS pr, {_ANY} AS hit, event_id, progress_time >= 100 AS complete, {_FLAG_COLS} FROM ev),
f AS (SELECT *, CASE WHEN ms - lag(ms) OVER (PARTITION BY key ORDER BY ms, event_id) <= {6 * HOUR} THEN 0 ELSE 1 END AS fresh FROM g),
n AS (SELECT *, sum(fresh) OVER (PARTITION BY key ORDER BY ms, event_id ROWS UNBOUNDED PRECEDING) AS no FROM f),
c AS (SELECT uid, post_id, author, ms AS moment, hit, sum(st) OVER w AS standing, sum(pr) OVER w AS playback, sum(hit::INTEGER) OVER w AS hits, {_RUN_FLAGS} FROM n WINDOW w AS (PARTITION BY key, no ORDER BY ms, event_id ROWS UNBOUNDED PRECEDING)),
z AS (SELECT * EXCLUDE (hit, hits), false AS final FROM c WHERE hit AND hits = 1
  UNION ALL BY NAME SELECT uid, post_id, min(author) AS author, max(ms) + {6 * HOUR} AS moment, sum(st) AS standing, sum(pr) AS playback, {_ALL_FLAGS}, true AS final FROM n GROUP BY key, uid, post_id, no),
q AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY moment, CAST(post_id AS VARCHAR), final) AS n FROM z WHERE {_TRIGGER}),
m AS ({session_marks_sql("q", "uid, n, moment", ("skip",))}),
l AS (SELECT q.uid, q.n, q.moment, list, id, max(m.moment) AS t, max(m.n) AS last, arg_max(score, m.moment) AS score FROM q JOIN m ON m.uid = q.uid AND m.n <= q.n AND m.moment + {12 * HOUR} >= q.moment GROUP BY q.uid, q.n, q.moment, list, id),
r AS (SELECT *, row_number() OVER (PARTITION BY uid, n, list ORDER BY t DESC, last DESC) AS no FROM l),
o AS (SELECT uid, n, list, string_agg(concat(id, CASE WHEN score IS NULL THEN '' ELSE ':' || CAST(floor(score * 100 + 0.3::DOUBLE) AS BIGINT) END), ',' ORDER BY no DESC) AS items FROM r WHERE no <= 3 GROUP BY uid, n, list)
SELECT q.uid, q.moment, q.post_id, q.final, string_agg(list || '=' || items, ';' ORDER BY list) AS lists FROM q JOIN o ON o.uid = q.uid AND o.n = q.n GROUP BY q.uid, q.n, q.moment, q.post_id, q.final"""


def user_counter_replay(spark: SparkSession, d: str) -> DataFrame:
    """Events and kinds of each user's last stretch without a gap of over six hours."""
    r = stateful.replay(events(spark, d), "uid", ["event_type"], lambda s, x: steps.user_counters(s, x, 6 * HOUR), final_only=True)
    return r.select(_uid(), F.from_json("value", "n long, types long").alias("s")).select("uid", "s.*")


COUNTER_SQL = f"""WITH {EV}, e AS (SELECT uid, event_type, event_id, epoch_us(ts) // 1000 AS ms FROM ev), f AS (SELECT *, CASE WHEN ms - lag(ms) OVER (PARTITION BY uid ORDER BY ms) <= {6 * HOUR} THEN 0 ELSE 1 END AS fresh FROM e),
n AS (SELECT *, sum(fresh) OVER (PARTITION BY uid ORDER BY ms, event_id ROWS UNBOUNDED PRECEDING) AS no, max(ms) OVER (PARTITION BY uid) AS now FROM f), z AS (SELECT *, max(no) OVER (PARTITION BY uid) AS top FROM n)
SELECT uid, count(*) AS n, count(DISTINCT CASE WHEN now - ms <= {6 * HOUR} THEN event_type END) AS types FROM z WHERE no = top GROUP BY uid"""

SQL = {
    "state_machine_replay": MACHINE_SQL,
    "state_key_rows": KEYS_SQL,
    "feedback_queue_replay": QUEUE_SQL,
    "short_view_tag_replay": SHORT_SQL,
    "weighted_interest_replay": INTEREST_SQL,
    "recent_anchor_replay": RECENT_SQL,
    "last_posts_replay": LAST_POSTS_SQL,
    "early_session_replay": EARLY_SQL,
    "latest_list_replay": LATEST_SQL,
    "session_list_replay": SESSION_LIST_SQL,
    "user_counter_replay": COUNTER_SQL,
}
QUERIES = {n: globals()[n] for n in SQL}
