"""Item-to-item collaborative filtering: session scores, pairs with a user's history, decayed pair scores and the
index of best neighbours. One batch (or micro-batch) runs end to end as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import ACTION_SCORES, action_score
from tidemark.operators import joins, topk
from tidemark.operators import windows as T
from tidemark.operators.parse import interaction_flags


def session_scores(events: DataFrame, size: str = "5 minutes") -> DataFrame:
    """uid, rec_token, item_id, window_end, score, last_ts: summed action scores above 0."""
    f = interaction_flags(events.withColumnRenamed("post_id", "item_id"))
    f = f.withColumn("_score", action_score({n: F.col(n) for n in ACTION_SCORES}))
    out = T.windowed(f, ["uid", "rec_token", "item_id"], size, None, {"score": F.sum("_score"), "last_ts": F.max("ts")})
    return out.filter(F.col("score") > 0)


def _pairs(sessions: DataFrame, history: DataFrame, self_pairs: bool) -> DataFrame:
    """left, right, _pair, last_ts: session scores times history weights."""
    p = joins.with_history(sessions, history).withColumn("_pair", F.round(F.col("score") * F.col("weight")).cast("long"))
    if not self_pairs:
        p = p.filter(F.col("item_id") != F.col("right"))
    return p.select(F.col("item_id").alias("left"), "right", "_pair", "last_ts")


def pair_scores(sessions: DataFrame, history: DataFrame, size: str = "2 minutes", self_pairs: bool = True) -> DataFrame:
    """left, right, window_end, score: session scores times history weights, summed by pair."""
    return T.windowed(_pairs(sessions, history, self_pairs), ["left", "right"], size, None, {"score": F.sum("_pair")}, ts="last_ts").filter(F.col("score") > 0)


def pair_totals(sessions: DataFrame, history: DataFrame, self_pairs: bool = True) -> DataFrame:
    """left, right, score: :func:`pair_scores` summed over all windows, without a group for each pair and window. Scores are above
    0 and weights are not negative, so no window's sum is below 0 and leaving out those of 0 changes no total."""
    return _pairs(sessions, history, self_pairs).filter(F.col("last_ts").isNotNull()).groupBy("left", "right").agg(F.sum("_pair").alias("score")).filter(F.col("score") > 0)


def update(events: DataFrame, history: DataFrame, pairs: DataFrame, index: DataFrame, now_minute: Column, k: int = 128, least: float = 40, self_pairs: bool = True) -> tuple[DataFrame, DataFrame]:
    """The stored pairs (left, right, score, minute) and the index (left, right, score, rank) after a batch of events."""
    new = pair_totals(session_scores(events), history, self_pairs=self_pairs)
    grown = joins.add_decayed(new.withColumn("minute", F.lit(0)), pairs, ["left", "right"], "score", "minute", now_minute)
    return grown, topk.merge_top(grown, index, "left", "right", "score", k, least)
