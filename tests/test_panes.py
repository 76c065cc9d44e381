"""A table of panes that micro-batches fill, against windows over all events."""

from functools import reduce

import pytest
from pyspark.sql import functions as F

from tests.test_streams import replayed
from tidemark.operators import windows as T
from tidemark.plans.domain import events
from tidemark.streaming.panes import PaneTable

@pytest.fixture
def aggs(spark):
    return {"events": T.count_all(), "longest": T.max_of("progress_time"), "tokens": T.distinct_sketch("rec_token")}


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_a_stream_fills_the_table(spark, sf, tmp_path, aggs):
    """Five micro-batches with merges at every second: the windows of one batch; every event is read once; a stretch of windows
    reads its own days."""
    e = events(spark, sf)
    kept = PaneTable(spark, str(tmp_path / "panes"), ["post_id"], 3600, aggs, fanout=2)
    s = replayed(spark, e, tmp_path, "events", 5)
    q = s.writeStream.foreachBatch(kept.writer()).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    assert q.awaitTermination(200)
    assert sum(p["numInputRows"] for p in q.recentProgress) == e.count()
    want = T.paned(e, ["post_id"], 86400, 3600, aggs)
    assert rows(kept.windows(86400)) == rows(want)
    files = kept.windows(86400).inputFiles()
    assert files and all("/panes/data/" in f for f in files)
    last = want.agg(F.max(F.unix_seconds("window_end"))).first()[0] - 5 * 86400
    some = kept.windows(86400, last - 3600, last)
    assert rows(some) == rows(want.filter(F.unix_seconds("window_end").between(last - 3600, last))) and some.count() > 0
    read = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_day" in read or "_day#" in read.split("PartitionFilters:")[1].split("]")[0], read


def test_a_batch_counts_once(spark, sf, tmp_path, aggs):
    """Retries, one of them after a failure before the manifest, and a batch without rows."""
    e = events(spark, sf)
    kept = PaneTable(spark, str(tmp_path / "panes"), ["post_id"], 3600, aggs, fanout=3)
    with pytest.raises(ValueError):
        kept.windows(86400)
    write = kept.writer()
    parts = [e.filter(f"event_id % 4 = {i}") for i in range(4)]
    write(parts[0], 0)
    write(parts[0], 0)
    whole, kept._folders = kept._folders, lambda v: 1 / 0
    with pytest.raises(ZeroDivisionError):
        write(parts[1], 1)
    kept._folders = whole
    for i, p in enumerate([parts[1], e.limit(0), parts[2], parts[3]], 1):
        write(p, i)
    assert rows(kept.windows(86400)) == rows(T.paned(e, ["post_id"], 86400, 3600, aggs))


def test_merges_drop_old_panes(spark, tmp_path, aggs):
    df = spark.range(10).selectExpr("1L as post_id", "double(id) as progress_time", "string(id) as rec_token", "timestamp_seconds(id * 86400) as ts")
    kept = PaneTable(spark, str(tmp_path / "panes"), ["post_id"], 3600, aggs, fanout=2, keep_s=2 * 86400)
    for i in range(10):
        kept.writer()(df.filter(f"progress_time = {i}"), i)
    panes = kept.panes()
    assert reduce(min, [r[0] for r in panes.select("_pane").collect()]) >= 5 * 24 and panes.count() <= 5


def test_batches_without_rows_merge_to_nothing(spark, tmp_path, aggs):
    df = spark.range(3).selectExpr("1L as post_id", "double(id) as progress_time", "string(id) as rec_token", "timestamp_seconds(id * 86400) as ts")
    kept = PaneTable(spark, str(tmp_path / "panes"), ["post_id"], 3600, aggs, fanout=2)
    for i, rows_ in enumerate([df.limit(0), df.limit(0), df, df.limit(0), df.limit(0)]):
        kept.writer()(rows_, i)
    assert rows(kept.windows(86400)) == rows(T.paned(df, ["post_id"], 86400, 3600, aggs))
