"""Step functions of the stateful operators."""

import random

from tidemark.streaming import steps as S

NOW = 1_705_543_200_000  # 2024-01-18 02:00 UTC


def test_transitions():
    t = lambda u, stage, n, f: S.transition(u, {"stage": stage, "probe_count": n}, f, NOW)
    assert t("no_zone", "probing_mid", 0, "positive")["stage"] == "probing_high"
    assert t("no_zone", "probing_high", 0, "positive")["stage"] == "stable"
    for user, stage, n, want in (("no_zone", "probing_mid", 0, (1, 1, 3)), ("block", "probing_mid", 0, (1, 1, 1)), ("no_zone", "probing_mid", 2, (3, 3, 14)), ("no_zone", "probing_high", 0, (1, 2, 7)), ("no_zone", "stable", 0, (2, 3, 14))):
        s = t(user, stage, n, "negative")
        assert (s["stage"], s["probe_count"], s["cooldown_stage"], s["cooldown_end_ts"]) == ("cooling", want[0], want[1], S.align_20(NOW + want[2] * 86_400_000))
    assert t("zone", "stable", 2, "positive") == {"stage": "probing_mid", "probe_count": 0, "cooldown_stage": 0, "cooldown_end_ts": 0}


def test_cooling_ends():
    s = {"stage": "cooling", "probe_count": 1, "cooldown_stage": 1, "cooldown_end_ts": NOW}
    assert S.transition("no_zone", s, "positive", NOW - 1) == s
    assert S.transition("no_zone", s, "positive", NOW)["stage"] == "probing_high"


def test_alignment():
    assert S.align_20(NOW) == 1_705_588_200_000
    assert S.align_20(1_705_588_200_000) == 1_705_588_200_000 + 86_400_000


def test_feedback_queues_dislike_wins():
    s: dict = {}
    for f, tag in (("positive", "a"), ("short", "a"), ("positive", "a"), ("positive", "b")):
        s, out = S.feedback_queues(s, {"feedback": f, "tag": tag, "author": 3, "ts": 1})
    assert [x[0] for x in s["negative_tags"]] == ["a"] and [x[0] for x in s["positive_tags"]] == ["b"]
    assert s["positive_authors"] == [] and s["negative_authors"][0][0] == 3
    for i in range(9):
        s, _ = S.feedback_queues(s, {"feedback": "report", "tag": f"t{i}", "author": 0, "ts": 1})
    assert [x[0] for x in s["negative_tags"]] == ["t4", "t5", "t6", "t7", "t8"]


def test_weighted_interests_match_the_closed_form():
    rng, s, seen, t = random.Random(1), {}, [], 0
    for _ in range(40):
        t += rng.randrange(3_600_000)
        f = rng.choice(["positive", "short", "report"])
        seen.append((t, f))
        s, out = S.weighted_interests(s, {"feedback": f, "tag": "x", "author": 0, "ts": t})
    up = sum(0.3 * 0.5 ** ((t - a) / 3.6e6 / 6) for a, f in seen if f == "positive")
    down = sum(S.INTEREST_WEIGHTS[f] * 0.5 ** ((t - a) / 3.6e6 / 24) for a, f in seen if f != "positive")
    # decay of both sides at every step is the same as decay from each event
    assert abs(s["tags"]["x"][0] - up) < 1e-9 and abs(s["tags"]["x"][1] - down) < 1e-9


def test_recent_lists():
    m: dict = {}
    for i in range(12):
        m = S.put_recent(m, f"k{i}", i, i, 10)
    assert sorted(m) == sorted(f"k{i}" for i in range(2, 12))
    s: dict = {}
    for t, a in ((0, 1), (1, 2), (2, 1), (15 * 60_000 + 2, 3)):
        s, out = S.recent_anchors(s, {"event": "live_exposure", "anchor_id": a, "ts": t})
    assert out[0]["anchors"] == [1, 3]
    assert S.recent_anchors(s, {"event": "live_view", "anchor_id": 9, "ts": 0}) == (s, [])


def test_early_session_fires_once_and_closes():
    e = {"standing_time": 1.0, "progress_time": 1.0, "playback_time": 0.0, "strong": False}
    s, out = S.early_session({}, e | {"ts": 0})
    assert out == []
    s, out = S.early_session(s, e | {"ts": 1000, "strong": True})
    assert [x["is_final"] for x in out] == [False]
    s, out = S.early_session(s, e | {"ts": 2000, "strong": True})
    assert out == []
    s, out = S.early_session(s, {"ts": 2000 + 70_001, "closing": True})
    assert s == {} and out[0]["is_final"] and out[0]["standing"] == 3.0


def test_last_distinct_and_latest_lists():
    s: dict = {}
    for t, p in enumerate([1, 2, 1, 3]):
        s, out = S.last_distinct(s, {"post_id": p, "ts": t}, n=2)
    assert out[0]["posts"] == [2, 3]
    s, out = S.latest_lists({}, {"lists": {"like": 5}, "ts": 0})
    s, out = S.latest_lists(s, {"lists": {"like": 6}, "ts": 13 * 3_600_000})
    assert out == [{"like": [6]}]


FLAGS = ["complete", "like", "comment", "share", "collect", "follow", "profile", "report", "uninterested", "paid"]
SESSION = "uid long, post_id long, author long, standing double, playback double, progress double, rate double, " + "".join(f"{f} boolean, " for f in FLAGS) + "t long"


def summaries(spark, rows):
    return spark.createDataFrame(rows, SESSION).selectExpr("*", "timestamp_seconds(t) as ts", "timestamp_seconds(t) as session_time")


def test_sixteen_latest_lists(spark, sf):
    import json

    from tidemark.operators.aggregates import RECENT_LISTS
    from tidemark.plans.state_queries import latest_list_replay, latest_lists_of

    rows = [(1, 5, 9, 12.0, 9.0, 0.0, 0.0, *[True] * 10, 0), (1, 6, 0, 2.0, 8.5, 0.0, 0.0, *[False] * 10, 1), (1, 7, 8, 1.0, 1.0, 0.0, 0.0, *[False] * 10, 2), (1, 8, 0, 0.0, 0.0, 0.0, 0.0, *[f == "report" for f in FLAGS], 3)]
    (r,) = latest_lists_of(summaries(spark, rows)).collect()
    got = json.loads(r.value)
    assert len(got) == 16 and set(got) == set(RECENT_LISTS)
    assert got["stand_10s"] == [[5, 12.0]] and got["play_8s"] == [[5, 9.0], [6, 8.5]]
    assert got["report"] == [5, 8] and got["negative"] == [5, 8] and got["negative_authors"] == [9] and got["positive_authors"] == [9] and got["like"] == [5]
    assert {r.list for r in latest_list_replay(spark, sf).collect()} == set(RECENT_LISTS)


def test_session_features_at_their_thresholds(spark):
    """Counters are strict (> 10 and > 20 stood, > 5 and > 10, > 8 and > 12 played, skips up to 2), lists have their sizes."""
    from tidemark.operators import aggregates as A

    at = lambda post, stand, play, progress, flags=(), author=9, t=0: (1, post, author, float(stand), float(play), float(progress), progress / 10, *[f in flags for f in FLAGS], t)
    rows = [at(1, 10, 5, 2), at(1, 10.5, 5.5, 2.5, ("like", "paid"), t=1), at(1, 21, 12.5, 0, ("uninterested",), 0, 2), at(2, 20, 8, 3, ("report", "profile"), t=3), at(3, 0, 8.5, 3, ("follow",), t=4), at(4, 0, 12, 9, (), t=5)]
    s = summaries(spark, rows)
    day = lambda d: d.filter("window_end = '1970-01-02'")
    p = {r.post_id: r for r in day(A.session_post_counts(s)).collect()}
    got = p[1]
    assert (got.exposures, got.skips, got.stand_10s, got.stand_20s, got.play_5s, got.play_10s, got.like, got.pay, got.dislike, got.report) == (3, 2, 2, 1, 2, 1, 1, 1, 1, 0)
    assert abs(got.mean_rate - (0.2 + 0.25) / 2) < 1e-9 and (p[2].stand_10s, p[2].stand_20s, p[4].play_10s) == (1, 0, 1)
    a = {r.author: r for r in day(A.session_author_counts(s)).collect()}
    assert set(a) == {0, 9} and (a[0].play_12s, a[0].dislike, a[9].play_8s, a[9].play_12s, a[9].stand_10s, a[9].stand_20s, a[9].follow) == (1, 1, 2, 0, 2, 0, 1)
    lists = {r.list: [(x.id, x.score) for x in r["items"]] for r in day(A.session_user_lists(s)).collect()}
    assert lists["stand_10s"] == [(2, 20.0), (1, 21.0)] and lists["play_8s"] == [(4, 12.0), (3, 8.5), (1, 12.5)]
    assert lists["positive"] == [(3, None), (2, None), (1, None)] and lists["negative"] == [(2, None), (1, None)] and lists["negative_authors"] == [(9, None)]
    assert lists["skip"] == [(1, None)] and lists["pay"] == [(1, None)] and lists["dislike"] == [(1, None)] and "view" not in lists and "expose" not in lists
    many = summaries(spark, [at(i, 11, 9, 0, FLAGS, author=i, t=i) for i in range(1, 400)])
    sizes = {r.list: len(r["items"]) for r in day(A.session_user_lists(many, cap=None)).collect()}
    assert sizes == {"complete_play": 30, "skip": 30, "stand_10s": 30, "play_8s": 30, **{n: 10 for n in ("like", "comment", "share", "follow", "collect", "profile", "pay", "report", "dislike")}, **{n: 20 for n in ("positive", "negative", "positive_authors", "negative_authors")}}
    capped = {r.list: r["items"][0].id for r in day(A.session_user_lists(many)).collect()}
    assert set(capped.values()) == {300} and day(A.session_user_counts(many)).first().exposures == 300
    turned = {r.list: [x.id for x in r["items"]] for r in day(A.session_user_lists(s, oldest_first=True)).collect()}
    assert turned["positive"] == [1, 2, 3]
