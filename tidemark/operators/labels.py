"""Content-sensitivity labels of users from what they saw last."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.scalars import label_text, tag_level

#: Interaction codes that count for or against a tag (fixed values).
POSITIVE_CODES = (1, 3, 5, 6, 9, 10, 13, 15, 16)
NEGATIVE_CODES = (7, 11, 18)
UNKNOWN = "u_ylevel_unk"


def any_code(codes: tuple[int, ...], column: str = "interactions") -> Column:
    return reduce(lambda a, b: a | b, (F.array_contains(column, c) for c in codes))


def times(codes: tuple[int, ...], column: str = "interactions") -> Column:
    return F.size(F.filter(column, lambda x: x.isin(*codes)))


def share_label(views: DataFrame, share: float = 0.6, seconds: float | None = None, skip: tuple[str, ...] = (), rank: str | None = None) -> DataFrame:
    """uid, label. Views: uid, tag, standing_time, interactions. Tags by total standing time; the first that has the
    share of it (or ``seconds``), or a positive action, and no dislike, is the label. Of tags with equal times the one with the view of
    smallest ``rank`` is first, without ranks the one of smallest hash."""
    first = F.min(rank).cast("long") if rank else F.max(F.xxhash64("tag"))
    t = views.groupBy("uid", "tag").agg(first.alias("first"), F.sum("standing_time").alias("stood"), F.sum(times(POSITIVE_CODES)).alias("good"), F.sum(times((11,))).alias("bad"))
    total = F.sum("stood").over(W.partitionBy("uid"))
    t = t.withColumn("total", total)
    enough = F.col("stood") >= seconds if seconds is not None else F.coalesce(F.col("stood") / F.nullif(F.col("total"), F.lit(0.0)) > share, F.lit(False))
    ok = (enough | (F.col("good") > 0)) & (F.col("bad") <= 0) & ~F.col("tag").isin(*skip) if skip else (enough | (F.col("good") > 0)) & (F.col("bad") <= 0)
    best = F.max(F.when(ok, F.struct("stood", (-F.col("first")).alias("h"), "tag")))
    return t.groupBy("uid").agg(F.coalesce(label_text(best["tag"]), F.lit(UNKNOWN)).alias("label"))


def tag_statistics(views: DataFrame, as_of: Column, long_play: float = 10.0, zero_is_short: bool = True, dislikes: tuple[int, ...] = (11,), fresh_minutes: int = 5) -> DataFrame:
    """uid, tag and what its posts got. Views: uid, post_id, tag, first_ts, standing_time, progress_time,
    interactions; actions count for posts first seen within ``fresh_minutes``. ``zero_is_short``: short plays have
    standing and progress below 3 seconds (0 too); else standing above 0 and below 3."""
    fresh = F.col("first_ts") > as_of - F.expr(f"INTERVAL {fresh_minutes} MINUTES")
    p = views.groupBy("uid", "tag", "post_id").agg(
        F.sum("standing_time").alias("stood"), F.sum("progress_time").alias("progress"), F.bool_or(fresh & any_code(POSITIVE_CODES)).alias("good"), F.bool_or(fresh & any_code(NEGATIVE_CODES)).alias("bad"), F.bool_or(fresh & any_code(dislikes)).alias("dislike"), F.min("first_ts").alias("first_ts")
    )
    short = (F.col("stood") < 3) & (F.col("progress") < 3) if zero_is_short else (F.col("stood") > 0) & (F.col("stood") < 3)
    p = p.withColumn("short", short)
    bad = F.col("bad") | F.col("short")
    n = lambda cond: F.count_if(cond)
    ids = lambda cond: F.sort_array(F.collect_set(F.when(cond, F.col("post_id"))))
    return p.groupBy("uid", "tag").agg(
        F.sum("stood").alias("stood"), F.max("stood").alias("longest"), n(F.col("good")).alias("positives"), n(bad).alias("negatives"), n(F.col("dislike")).alias("dislikes"), n(F.col("short")).alias("shorts"),
        ids(F.col("good") | (F.col("stood") >= long_play)).alias("positive_posts"), ids(bad).alias("negative_posts"), F.min_by("post_id", F.struct("first_ts", "post_id")).alias("trigger_post"),
    )


def pick_tags(stats: DataFrame, long_play: float = 10.0, skip: tuple[str, ...] = ("unk", "clean")) -> DataFrame:
    """uid, the highest positive tag and the lowest negative tag with their posts (null if none)."""
    s = stats.filter(~F.col("tag").isin(*skip)).withColumn("level", tag_level("tag"))
    good = ((F.col("longest") >= long_play) | (F.col("positives") > 0)) & (F.col("negatives") <= 0)
    bad = (F.col("shorts") >= 5) | (F.col("dislikes") >= 1)
    up = F.max(F.when(good, F.struct("level", "tag", "positive_posts")))
    low = F.min(F.when(bad, F.struct("level", "tag", "negative_posts")))
    out = s.groupBy("uid").agg(up.alias("p"), low.alias("n"))
    return out.select("uid", F.col("p.tag").alias("positive_tag"), F.coalesce("p.positive_posts", F.array().cast("array<bigint>")).alias("positive_posts"), F.col("n.tag").alias("negative_tag"), F.coalesce("n.negative_posts", F.array().cast("array<bigint>")).alias("negative_posts"))


def level_of(label: Column) -> Column:
    return F.when(label.contains("explicit"), 3).when(label.contains("high"), 2).when(label.contains("mid"), 1).otherwise(0)


def write_decision(picked: DataFrame, stored: DataFrame) -> DataFrame:
    """Which labels to write. ``picked``: of :func:`pick_tags`; ``stored``: uid, pos_label, pos_posts, neg_label,
    neg_posts (sorted ids), null where nothing is stored.

    A strong (high or explicit) negative label forces a stored positive one of mid or more down to mid, and keeps a
    positive label from rising above mid. Otherwise a positive label must stay below the stored negative level and
    not fall below its own. A negative label may only fall or stay. Same label and same posts: nothing to write."""
    d = picked.join(stored, "uid", "left")
    pos_new, neg_new = F.coalesce(label_text("positive_tag"), F.lit(UNKNOWN)), label_text("negative_tag")
    pos_old, neg_old = F.col("pos_label"), F.col("neg_label")
    strong = lambda x: F.coalesce(level_of(x) >= 2, F.lit(False))
    forced = strong(neg_new) & pos_old.isNotNull() & (level_of(F.coalesce(pos_old, F.lit(UNKNOWN))) >= 1)
    d = d.withColumn("new_pos", F.when(forced, F.lit("u_ylevel_mid")).otherwise(pos_new)).withColumn("new_neg", neg_new).withColumn("forced", forced)
    new = F.col("new_pos")
    guard = strong(neg_new) | strong(neg_old)
    below_neg = neg_old.isNull() | (level_of(new) < level_of(neg_old))
    not_lower = F.when(guard, level_of(new) <= 1).otherwise(pos_old.isNull() | (level_of(new) >= level_of(pos_old)))
    same_pos = F.coalesce((pos_old == new) & (F.col("pos_posts") == F.array_sort("positive_posts")), F.lit(False))
    known = new != UNKNOWN
    write_pos = known & ~same_pos & ((below_neg & not_lower) | (F.col("forced") & (level_of(new) <= 1)))
    same_neg = F.coalesce((neg_old == F.col("new_neg")) & (F.col("neg_posts") == F.array_sort("negative_posts")), F.lit(False))
    write_neg = F.col("new_neg").isNotNull() & (F.col("new_neg") != UNKNOWN) & (neg_old.isNull() | ((level_of(F.col("new_neg")) <= level_of(neg_old)) & ~same_neg))
    return d.select("uid", "new_pos", "positive_posts", F.coalesce(write_pos, F.lit(False)).alias("write_pos"), "new_neg", "negative_posts", F.coalesce(write_neg, F.lit(False)).alias("write_neg"), "forced")


def feedback_of(picked: DataFrame) -> DataFrame:
    """uid, feedback: negative before positive, else none."""
    return picked.withColumn("feedback", F.when(F.col("negative_tag").isNotNull(), "negative").when(F.col("positive_tag").isNotNull(), "positive").otherwise("none"))


def watch_flags(sessions: DataFrame, anchors: DataFrame, seconds: float = 15) -> DataFrame:
    """Users who watched a listed anchor for longer than ``seconds`` in a session. Sessions: uid, anchor_id, watched."""
    from tidemark.operators.joins import members

    return members(sessions.filter(F.col("watched") > seconds), anchors, "anchor_id").select("uid", "anchor_id", "session_end", F.lit(1).alias("flag"))


STATE_KEYS = ("user_type", "stage", "dist", "probe_count", "cooldown_end_ts", "cooldown_stage", "last_feedback", "last_feedback_ts", "last_pos_tag", "last_neg_tag", "last_update_ts", "state_flow")


def state_rows(states: DataFrame, prefix: str = "rec_post:{", suffix: str = "}:porn_", end: str = "_v5") -> DataFrame:
    """key, value for each of the twelve keys of a user's state (key formats are fixed values)."""
    pairs = F.array(*[F.struct(F.lit(k).alias("name"), F.coalesce(F.col(k).cast("string"), F.lit("")).alias("value")) for k in STATE_KEYS])
    key = F.concat(F.lit(prefix), F.col("uid").cast("string"), F.lit(suffix), F.col("x.name"), F.lit(end))
    return states.select("uid", F.explode(pairs).alias("x")).select(key.alias("key"), F.col("x.value").alias("value"))
