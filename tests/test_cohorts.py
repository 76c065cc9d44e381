"""Interactions and start records in one state: starts before, after and never, final rows, and the batch twin."""

import pytest
from pyspark.sql import functions as F

from tests.test_chains import T0, batches
from tests.test_streams import collect, replayed, with_sentinel
from tidemark.operators import aggregates as A
from tidemark.plans.domain import events
from tidemark.streaming.cohorts import item_cohort_stream

H = 3600
EVENT = "s long, post_id long, rec_token string, kind string, progress_time double, standing_time double, interactions array<int>, start_s long"


def frame(spark, rows):
    full = [(s, p, t, k, x, 0.0, i, a) for s, p, t, k, x, i, a in rows]
    return spark.createDataFrame(full, EVENT).withColumn("ts", F.timestamp_seconds(F.col("s") + T0)).withColumn("start_ts", F.timestamp_seconds(F.col("start_s") + T0)).drop("s", "start_s")


def view(hour, post, token, progress=0.0, *codes):
    return (hour * H, post, token, "view", progress, list(codes), None)


def start(hour, post, at):
    return (hour * H, post, None, "start", 0.0, [], at * H)


ROWS = [
    # post 1: start first; post 2: start an hour after its first interaction; post 3: never; post 4: start, nothing inside
    [start(0, 1, 0), view(1, 1, "a", 4.0), view(1, 2, "a", 9.0), view(1, 3, "a", 30.0), start(1, 4, 1)],
    [start(2, 2, 0), view(2, 1, "a", 9.0, 1), view(2, 1, "b", 30.0), view(2, 2, "b", 4.0)],
    [view(48, 1, "c", 3.0), view(49, 2, "d", 30.0), view(49, 1, "e", 30.0)],
    [view(60, 5, "z"), view(300, 5, "z")],
    [view(600, 5, "z")],
]


@pytest.mark.parametrize("hold", [True, False])
def test_starts_before_after_and_never(spark, tmp_path, hold):
    s = batches(spark, [frame(spark, b) for b in ROWS], tmp_path, f"posts{hold}")
    out = item_cohort_stream(s.filter("kind != 'start'"), s.filter("kind = 'start'"), hold=hold, watermark="1 second")
    got = collect(out, "append", tmp_path, f"cohorts{hold}")
    last = {r.post_id: ((r.start_ms // 1000 - T0) // H, (r.emit_ms // 1000 - T0) // H, r.view_3s, r.view_8s, r.view_20s, r.like) for r in got.filter("final").collect()}
    assert last == {1: (0, 48, 3, 2, 1, 1), 2: (0, 48, 2, 1, 0, 0) if hold else (0, 48, 1, 0, 0, 0)}
    assert got.filter("final").count() == 2 and {r.post_id for r in got.collect()} == {1, 2}
    running = [r.view_3s for r in got.filter("post_id = 1 and not final").orderBy("view_3s").collect()]
    assert running == [1, 2, 3]


def test_a_moved_start_keeps_the_end(spark, tmp_path):
    rows = [[start(0, 1, 0), view(1, 1, "a", 4.0)], [start(5, 1, 4), view(6, 1, "b", 4.0), view(3, 1, "c", 4.0)], [view(200, 5, "z")], [view(400, 5, "z")]]
    s = batches(spark, [frame(spark, b) for b in rows], tmp_path, "moved")
    got = collect(item_cohort_stream(s.filter("kind != 'start'"), s.filter("kind = 'start'"), watermark="10 hours"), "append", tmp_path, "moved")
    r = got.filter("final").collect()
    # the interaction at hour 3 lies in the cohort as it was when it came
    assert len(r) == 1 and r[0].start_ms == (T0 + 4 * H) * 1000 and r[0].view_3s == 3


def test_final_rows_equal_the_batch(spark, sf, tmp_path):
    """All events of the table; start records are made an hour late."""
    e = events(spark, sf)
    starts = e.filter("kind = 'expose'").groupBy("post_id").agg(F.min("ts").alias("start_ts"))
    names = list(A.item_conditions())
    want = A.item_cohorts(e.filter("post_id is not null"), starts).selectExpr("post_id", "unix_millis(start_ts) as start_ms", *[f"`{n}`" for n in names])
    at = starts.withColumn("ts", F.expr("start_ts + interval 1 hour"))
    s = replayed(spark, with_sentinel(e), tmp_path, "events", 3)
    out = item_cohort_stream(s, replayed(spark, at, tmp_path, "starts", 2), watermark="40 days")
    got = collect(out, "append", tmp_path, "cohorts").filter("final").select("post_id", "start_ms", *names)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() > 20
