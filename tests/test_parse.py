"""Parsers on hand-made JSON lines."""

import json

from pyspark.sql import functions as F

from tidemark.operators import filters, parse


def lines(spark, *objects):
    return spark.createDataFrame([(x if isinstance(x, str) else json.dumps(x),) for x in objects], "value string")


def expose(items, uid=5, at=1_700_000_000, kind=16):
    return {"event_type": kind, "post_expose": {"uid": uid, "created_at": at, "list": items}}


def test_exposures_keep_valid_posts_only(spark):
    good = expose([{"post_id": "12", "rec_token": "t"}, {"post_id": 13}, {"post_id": "x"}, {"post_id": "0"}, {}])
    df = lines(spark, good, expose([{"post_id": "1"}], uid=0), expose([{"post_id": "1"}], at=0), expose([]), expose([{"post_id": "1"}], kind=161), '{"event_type":16,', '{"event_type" : 16, "post_expose": {"uid": 6, "created_at": 9, "list": [{"post_id": "7"}]}}')
    got = {(r.uid, r.post_id, r.rec_token) for r in parse.exposures(df).collect()}
    assert got == {(5, 12, "t"), (5, 13, ""), (6, 7, "")}


def test_views_carry_interactions(spark):
    v = {"event_type": 8, "post_view": {"uid": 5, "created_at": 1_700_000_000, "list": [{"post_id": 1, "standing_time": 2.5, "interaction": [1, 1, 7]}, {"post_id": 2}]}}
    got = {r.post_id: (r.standing_time, r.interactions) for r in parse.views(lines(spark, v)).collect()}
    assert got == {1: (2.5, [1, 1, 7]), 2: (0.0, [])}


def test_tag_shapes(spark):
    shapes = spark.createDataFrame([('{"a":1,"b":{"c":2}}',), ('[{"x":1},{"y":2}]',), ('["p","p","q"]',), ("plain",), ("",), (None,)], "c string")
    got = [r[0] for r in shapes.select(parse.tag_list("c")).collect()]
    assert [sorted(x or []) for x in got] == [["a", "b"], ["x", "y"], ["p", "q"], ["plain"], [], []]


def test_tag_freshness_edges(spark):
    def tag(level, at, post=3):
        return {"event_type": 11, "ai_post_tag_event": {"post_id": post, "access_level": level, "access_level_time": at, "results": {"tags": {"content": "z"}}}}

    df = lines(spark, tag(9, 100, 1), tag(10, 100, 2), tag(30, 100, 3), tag(31, 100, 4), tag(10, 100 - 86400, 5), tag(10, 99 - 86400, 6))
    assert {r.post_id for r in parse.content_tags(df, F.lit(100)).collect()} == {2, 3, 5}


def test_valid_posts(spark):
    def post(i, uid=1, at=1000, gone=0):
        return {"event_type": 17, "rec_valid_post_event": {"id": i, "uid": uid, "tagging_at": 1, "created_at": at, "updated_at": 2, "deleted_at": gone}}

    df = lines(spark, post("1"), post("2", gone=5), post("3", uid=0), post("x"), post("4", at=1000 - 6 * 86400), post("5", at=999 - 6 * 86400))
    assert {r.post_id for r in parse.valid_posts(df, F.lit(1000)).collect()} == {1, 4}


def log(event, data, uid=3, ts=1_700_000_000_000):
    return {"event_type": 1, "user_event_log": {"event": event, "event_data": data if isinstance(data, str) else json.dumps(data), "timestamp": ts, "uid": uid}}


ITEM = {"post_id": "9", "item_type": 1, "post_type": 2, "exposed_pos": 2, "rec_token": "r"}


def test_client_events(spark):
    one = ITEM | {"userId": 4, "author_id": 8, "action": "like"}
    df = lines(
        spark, log("postLikeButtonClicked", one), log("postLikeButtonClicked", one | {"action": "unlike"}), log("postLikeButtonClicked", one | {"exposed_pos": 1}), log("postSwipeRight", one), log("postClickAvatar", one), log("collect_page_click", {"userId": 4, "source": 77, "action_type": 1}), log("collect_page_click", {"userId": 4, "source": 78, "action_type": 0}),
        log("videoPlayDuration", {"userId": 4, "list": [ITEM | {"standing_time": 3.0}, ITEM | {"item_type": 2}]}), log("postLikeButtonClicked", "null"), log("postLikeButtonClicked", ""), log("other", one),
    )
    got = sorted((r.event, r.post_id, r.like, r.profile, r.collect, r.standing_time) for r in parse.client_posts(parse.client_log(df)).collect())
    assert got == sorted([("postLikeButtonClicked", 9, True, False, False, 0.0), ("postLikeButtonClicked", 9, False, False, False, 0.0), ("postSwipeRight", 9, False, True, False, 0.0), ("postClickAvatar", 9, False, True, False, 0.0), ("collect_page_click", 77, False, False, True, 0.0), ("videoPlayDuration", 9, False, False, False, 3.0)])


def test_missing_timestamp_takes_ingest_time(spark):
    x = log("postLikeButtonClicked", {"a": 1})
    del x["user_event_log"]["timestamp"]
    df = lines(spark, x).withColumn("at", F.expr("timestamp'2024-01-01 00:00:00'"))
    assert parse.client_log(df, ingest_ts="at").first().ts.year == 2024


def test_event_type_prefilter(spark):
    df = lines(spark, '{"event_type":8}', '{"event_type": 81}', '{"x":1}', "broken", '{"a":{"event_type":8},"event_type":9}')
    got = [(r[0], r[1], r[2]) for r in df.select(filters.maybe_event_type("value", 8), filters.is_event_type("value", 8), filters.event_type("value")).collect()]
    assert got == [(True, True, 8), (False, False, 81), (False, False, -1), (False, False, -1), (True, False, 9)]


def views(spark, rows):
    """Feature events of views: post_id, interactions, progress_time, standing_time."""
    df = spark.createDataFrame(rows, "post_id long, interactions array<int>, progress_time double, standing_time double")
    return df.selectExpr("1L as uid", "post_id", "2L as author", "'t' as rec_token", "'view' as kind", "standing_time", "progress_time", "interactions", "timestamp'2024-01-01' as ts")


def test_feedback_kinds(spark):
    """Played time decides: nothing at 0, short below 3 seconds, positive from 10 on; how long one stood doesn't count."""
    rows = [(1, [7, 11], 1.0, 99.0), (2, [], 2.99, 99.0), (3, [], 3.0, 1.0), (4, [], 10.0, 0.0), (5, [7], 12.0, 0.0), (6, [], 0.0, 1.0), (7, [], 9.99, 50.0), (8, [11], 2.0, 0.0), (9, None, 1.0, 0.0)]
    got = sorted((r.post_id, r.feedback) for r in parse.feedback(views(spark, rows)).collect())
    assert got == [(1, "report"), (1, "uninterested"), (2, "short"), (4, "positive"), (5, "positive"), (5, "report"), (8, "uninterested")]
    assert sorted(r.post_id for r in parse.short_views(views(spark, rows)).collect()) == [1, 2, 8, 9]


def test_interaction_flags(spark):
    """A long view is one played for 3 seconds or stood at for 5."""
    rows = [(1, [], 2.99, 4.99), (2, [], 3.0, 0.0), (3, [], 0.0, 5.0), (4, [1, 13, 15, 3, 5, 6, 9], 0.0, 0.0)]
    got = {r.post_id: r for r in parse.interaction_flags(views(spark, rows)).collect()}
    assert {i: r.long_view for i, r in got.items()} == {1: False, 2: True, 3: True, 4: False}
    f = got[4]
    assert f.click and f.like and f.follow and f.profile and f.comment and f.favorite and f.share and not f.download and not f.forward


def test_client_flags_as_codes(spark):
    flags = ["like", "comment", "share", "collect", "paid", "follow", "profile", "report", "uninterested"]
    rows = [(f, *[f == g for g in parse.FLAGS]) for f in flags] + [(parse.PROMPT_NO, *[g == "uninterested" for g in parse.FLAGS]), (parse.EXPOSURE, *[False for _ in parse.FLAGS])]
    df = spark.createDataFrame(rows, "event string, " + ", ".join(f"{f} boolean" for f in parse.FLAGS))
    df = df.selectExpr("*", "1L as uid", "2L as post_id", "3L as author", "'t' as rec_token", "1 as post_type", "0D as standing_time", "0D as progress_time", "timestamp'2024-01-01' as ts")
    got = [(r.kind, r.interactions) for r in parse.client_to_views(df).collect()]
    assert got == [("view", [c]) for c in (1, 3, 5, 6, 10, 13, 15, 11, 7)] + [("view", [7, 18]), ("expose", [])]


def test_client_lists_read_their_own_fields(spark):
    item = ITEM | {"length": 9.0, "standing_time": 3.0, "progress_time": 2.0, "playback_time": 4.0, "author": 5}
    both = {"userId": 4, "posts": [item], "list": [item | {"post_id": "10"}]}
    df = lines(spark, log("postExposure", both), log("videoPlayDuration", both), log("imagePlay", both), log("imagePlay", {"list": [item]}))
    got = sorted((r.event, r.post_id, r.author, r.length, r.standing_time, r.progress_time, r.playback_time) for r in parse.client_posts(parse.client_log(df)).collect())
    assert got == [("imagePlay", 10, 5, 9.0, 3.0, 2.0, 0.0), ("postExposure", 9, 0, 9.0, 0.0, 0.0, 0.0), ("videoPlayDuration", 10, 5, 9.0, 3.0, 2.0, 4.0)]


def test_live_events_read_their_own_fields(spark):
    data = {"uid": 4, "live_id": 1, "anchor_id": 2, "scene": 1, "from_scene": 3, "watch_duration": 7, "stay_duration": 8, "gift_price": 5, "gift_count": 2}
    df = lines(spark, *[log(e, data) for e in parse.LIVE_EVENTS], log("live_view", data | {"anchor_id": 0}), log("live_view", data | {"uid": 0}))
    got = {r.event: (r.watch, r.stay, r.coins) for r in parse.live_events(parse.client_log(df)).collect()}
    assert got == {e: (0, 0, 0) for e in parse.LIVE_EVENTS} | {"live_view": (7, 0, 0), "exit_liveroom": (8, 8, 0), "liveroom_gift_send": (0, 0, 10)}
