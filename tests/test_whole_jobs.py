"""Queries that once left out what lay beyond a cap."""

from pyspark.sql import functions as F

from tidemark.operators import joins, topk
from tidemark.plans.registry import QUERIES


def _write(spark, folder, rows):
    e = spark.createDataFrame(rows, "event_id long, s long, user_id long, event_type string, value double, props string")
    e.select("event_id", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value", "props").write.parquet(f"{folder}/events.parquet")
    return str(folder)


def test_all_sessions_of_a_day_count(spark, tmp_path):
    """Thirty posts within half an hour, each a session of its own; clicks show no progress, so every third is a skip."""
    d = _write(spark, tmp_path, [(11 * i, 60 * (i + 1), 7, "click" if i % 3 == 0 else "view", 320.0, f'{{"k": {i}}}') for i in range(30)])
    rows = QUERIES["session_user_day"](spark, d).collect()
    assert len(rows) == 24 and max(r.exposures for r in rows) == 30
    assert {(r.exposures, r.skips) for r in rows if r.exposures == 30} == {(30, 10)}


def test_all_posts_of_a_history_make_pairs(spark, tmp_path):
    """A user viewed 40 posts, more than lists of five and a history of twelve would keep: each pairs with all others."""
    d = _write(spark, tmp_path, [(11 * i, 600 * i, 7, "view", 320.0, f'{{"k": {i}}}') for i in range(40)])
    rows = QUERIES["weighted_pairs"](spark, d).collect()
    assert {(r.left, r.right) for r in rows} == {(a, b) for a in range(1, 41) for b in range(1, 41) if a != b} and len(rows) == 1560
    first = lambda post: min((post - 1) % 8, (post + 6) % 8)
    assert all(r.score == round(7 * joins.HISTORY_WEIGHTS[first(r.right)]) for r in rows)


def test_whole_lists_weigh_as_their_first_places(spark):
    lists = [[3, 1], [1, 2], [2, 3, 4], [], [9], [4], [], [9]]
    profile = spark.createDataFrame([(5, *lists)], "uid long, " + ", ".join(f"l{i} array<long>" for i in range(8)))
    want = topk.history(joins.explode_history(profile, [f"l{i}" for i in range(8)]), "uid", "right", "pos", 100).select("uid", "right", "weight")
    rows = spark.createDataFrame([(5, x, i) for i, xs in enumerate(lists) for x in xs], "uid long, right long, list long")
    assert sorted(joins.weigh_history(rows).collect()) == sorted(want.collect())
