"""Stateful operators in front of others: streams of several micro-batches against their batch twins."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tests.test_streams import collect
from tidemark.operators.aggregates import FLAGS
from tidemark.streaming import chains, stateful, steps

T0 = 1_704_067_200  # 2024-01-01


def batches(spark, frames, tmp_path, name):
    """A file stream that takes one of the frames a micro-batch."""
    at = tmp_path / name
    at.mkdir()
    for i, df in enumerate(frames):
        df.coalesce(1).write.parquet(str(tmp_path / f"{name}-{i}"))
        part = next(p for p in (tmp_path / f"{name}-{i}").iterdir() if p.name.startswith("part-"))
        part.rename(at / f"{i}.parquet")
        os.utime(at / f"{i}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
    return spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", 1).parquet(str(at))


def post(second, uid, post_id, standing=0.0, playback=0.0, author=0, *flags):
    return (T0 + second, uid, f"t{uid}", post_id, author, 30.0, standing, playback, playback, *(f in flags for f in FLAGS))


POST = "s long, uid long, rec_token string, post_id long, author long, length double, standing_time double, progress_time double, playback_time double, " + ", ".join(f"`{f}` boolean" for f in FLAGS)


def posts(spark, rows):
    return spark.createDataFrame(rows, POST).withColumn("ts", F.timestamp_seconds("s")).drop("s")


def tick(second):
    """A row that only moves the watermark."""
    return post(second, 99, second)


BATCHES = [
    [post(0, 1, 10, 0.0, 1.0, 0, "like"), post(30, 1, 10, 1.0, 9.0, 7), post(40, 2, 10, 3.0)],
    [tick(150)],
    [post(200, 1, 11, 12.0, 0.0, 5), post(210, 2, 12, 0.0, 0.0, 8, "report")],
    [tick(330)],
    [post(400, 1, 12, 6.0), post(420, 1, 12, 6.0), post(450, 1, 10, 0.0, 0.0, 7, "share")],
    [tick(600)],
    [post(50_000, 2, 13, 0.0, 0.0, 3, "uninterested")],
    [tick(10**7), tick(2 * 10**7)],
]


def test_sessions_feed_lists(spark, tmp_path):
    """Early and final summaries in order, a strong sum without a strong event, lists that expire after 12 hours; the stream's two
    states give what two replays give."""
    one = posts(spark, [r for b in BATCHES for r in b if r[1] != 99])
    rows = lambda d: sorted((r.key, r.ts - T0 * 1000, json.dumps(json.loads(r.value), sort_keys=True)) for r in d.collect() if r.key != "99")
    want = rows(chains.latest_user_lists(one))
    s = batches(spark, [posts(spark, b) for b in BATCHES], tmp_path, "posts")
    got = rows(collect(chains.latest_user_lists(s, watermark="1 second"), "append", tmp_path, "lists"))
    assert got == want
    seen = [(k, t, json.loads(v)) for k, t, v in got]
    first = [(t, v["post_id"], v["final"]) for k, t, v in seen if k == "1"]
    assert first == [(0, 10, False), (100_000, 10, True), (200_000, 11, False), (270_000, 11, True), (450_000, 10, False), (490_000, 12, True), (520_000, 10, True)]
    last = seen[[k for k, _, _ in seen].index("2") - 1][2]["lists"]
    assert last["like"] == [10] and last["share"] == [10] and last["stand_10s"] == [[11, 12.0], [12, 12.0]] and last["play_8s"] == [[10, 10.0]] and last["positive_authors"] == [7]
    other = [v["lists"] for k, _, v in seen if k == "2"]
    assert other[0] == {"report": [12], "negative": [12], "negative_authors": [8]} and other[-1] == {"dislike": [13], "negative": [13], "negative_authors": [3]}


def test_summaries_carry_all_fields(spark):
    s = chains.session_summaries(posts(spark, [r for b in BATCHES[:1] for r in b])).orderBy("at", "uid").collect()
    assert [(r.uid, r.post_id, r.author, r.length, r.standing, r.progress, r.playback, r.like, r.final) for r in s] == [(1, 10, 0, 30.0, 0.0, 1.0, 1.0, True, False), (1, 10, 7, 30.0, 1.0, 9.0, 10.0, True, True), (2, 10, 0, 30.0, 3.0, 0.0, 0.0, False, True)]


@pytest.mark.parametrize("event", [{"ts": 5, "post_id": 1}, {"ts": 5, "post_id": 1, "uid": None, "standing_time": None, "like": None, "author": -3}])
def test_missing_fields_are_nothing(event):
    state, out = steps.post_summaries({}, event)
    assert out == [] and state["author"] == 0 and not state["like"]
    assert steps.post_summaries(state, {"ts": 10**9, "closing": True})[1][0]["final"]


def _rated(spark, sf):
    from tidemark.plans.state_queries import _rated

    return _rated(spark, sf)


def _halves(df):
    ms = df.select(F.unix_millis("ts").alias("t")).approxQuantile("t", [0.5], 0.0)[0]
    return df.filter(F.unix_millis("ts") <= ms), df.filter(F.unix_millis("ts") > ms), ms


MACHINE = ["user_type", "feedback", "pos_tag", "neg_tag"]


def test_a_stream_resumes_from_stored_states(spark, sf, tmp_path):
    """The second half of the events on the states that the first half left equals one replay of all; so does a batch, and
    states of snapshots of halves equal those of one snapshot."""
    from tests.test_streams import replayed

    every = _rated(spark, sf)
    first, second, ms = _halves(every)
    rows = lambda d: sorted((r.key, r.ts, r.value) for r in d.collect())
    want = [x for x in rows(stateful.replay(every, "uid", MACHINE, steps.sensitivity)) if x[1] > ms]
    stored = stateful.snapshot(first, "uid", MACHINE, steps.sensitivity)
    stored.write.parquet(str(tmp_path / "states"))
    kept = spark.read.parquet(str(tmp_path / "states"))
    assert rows(stateful.replay(second, "uid", MACHINE, steps.sensitivity, initial=kept)) == want and len(want) > 20
    s = stateful.stream(replayed(spark, second, tmp_path, "second", 3), "uid", MACHINE, steps.sensitivity, initial=kept)
    assert rows(collect(s, "append", tmp_path, "resumed")) == want
    states = lambda d: sorted((r.key, r.state) for r in d.collect())
    later = {r.key: r.state for r in stateful.snapshot(second, "uid", MACHINE, steps.sensitivity, initial=kept).collect()}
    assert states(stateful.snapshot(every, "uid", MACHINE, steps.sensitivity)) == sorted(({r.key: r.state for r in kept.collect()} | later).items())


def test_a_stored_session_closes_by_its_timer(spark, tmp_path):
    """A session that a snapshot left open gets its timer again and closes without any event of its own."""
    before = posts(spark, [post(0, 1, 10, 0.0, 9.0)])
    step = steps.post_summaries
    e = lambda d: d.withColumn("key", F.concat_ws("|", "rec_token", "post_id"))
    stored = stateful.snapshot(e(before), "key", chains._EVENT, step)
    s = batches(spark, [posts(spark, [tick(10)]), posts(spark, [tick(500)]), posts(spark, [tick(900)])], tmp_path, "ticks")
    out = stateful.stream(e(s), "key", chains._EVENT, step, watermark="1 second", gap_ms=70_000, timed=True, initial=stored)
    got = [json.loads(r.value) for r in collect(out, "append", tmp_path, "stored").collect() if r.key == "t1|10"]
    assert [(x["final"], x["playback"], x["at"]) for x in got] == [(True, 9.0, (T0 + 70) * 1000)]


def test_batch_summaries_equal_the_step(spark):
    """Running aggregates give what the streams' state gives, row for row: equal times, nulls, negative authors, several sessions; no
    row goes through Python."""
    import random

    r = random.Random(5)
    pick = lambda *x: r.choice(x)
    rows = [(r.randrange(900), pick(1, 2, 3), pick("a", "b"), pick(7, 8), pick(None, -3, 0, 5, 6), pick(None, -1.0, 0.0, 30.0), pick(None, 0.25, 1.1, 12.0), pick(None, 0.0, 3.3, 9.0), pick(None, -1.0, 0.7, 8.0), *(pick(None, False, False, False, False, True) for _ in FLAGS)) for _ in range(300)]
    d = posts(spark, rows).withColumn("key", F.concat_ws("|", "rec_token", "post_id"))
    got = chains.session_summaries(d, 20_000)
    one = stateful.replay(d, "key", chains._EVENT, lambda s, e: steps.post_summaries(s, e, 20_000), close=True)
    want = [json.loads(x.value) for x in one.collect()]
    names = [n for n, _ in chains._fields()]
    seen = sorted(str([x[n] for n in names]) for x in got.withColumn("at", F.unix_millis("at")).collect())
    assert seen == sorted(str([x[n] for n in names]) for x in want) and len(want) > 100 and 50 < sum(x["final"] for x in want) < len(want)
    assert "Python" not in got._jdf.queryExecution().optimizedPlan().toString() and "MapInPandas" not in got._jdf.queryExecution().optimizedPlan().toString()
