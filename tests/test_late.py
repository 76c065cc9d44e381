"""Late rows: what streams drop, how many they are, and windows that have them after all; inputs of which one is idle."""

import pytest
from pyspark.sql import functions as F

from tests.test_chains import T0, batches
from tests.test_streams import collect
from tidemark.operators import windows as T
from tidemark.plans.domain import events
from tidemark.streaming.late import LateWindows


def rows(df, before=None):
    df = df if before is None else df.filter(F.col("window_end") < before)
    return sorted(map(str, df.select("post_id", "window_end", "n", "longest").collect()))


def test_repaired_windows_equal_a_batch(spark, sf, tmp_path):
    """Four micro-batches, of which the last two hold old rows; in-time windows are those of Spark's append mode on the same files."""
    e = events(spark, sf).select("event_id", "post_id", "progress_time", "ts")
    aggs = {"n": T.count_all(), "longest": T.max_of("progress_time")}
    cut = e.select(F.unix_seconds("ts").alias("t")).approxQuantile("t", [0.4, 0.8], 0.0)
    early, t = F.pmod("event_id", F.lit(7)) < 2, F.unix_seconds("ts")
    parts = [e.filter((t <= cut[0]) & ~early), e.filter((t > cut[0]) & (t <= cut[1]) & ~early), e.filter((t <= cut[1]) & early), e.filter(t > cut[1])]
    end = e.limit(1).withColumn("ts", F.expr("timestamp'2030-01-01'")).withColumn("post_id", F.lit(-1).cast("long"))
    stream = batches(spark, [*parts, end], tmp_path, "events")
    kept = LateWindows(spark, str(tmp_path / "late"), ["post_id"], 86400, 21600, aggs, 3600, fanout=2)
    q = stream.writeStream.foreachBatch(kept.writer()).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    assert q.awaitTermination(200)
    want = T.paned(e, ["post_id"], 86400, 21600, aggs)
    assert rows(kept.repaired(), "2029-01-01") == rows(want)
    plain = T.windowed(stream.withWatermark("ts", "1 hour"), ["post_id"], "24 hours", "6 hours", {"n": F.count("*"), "longest": F.max("progress_time")})
    shown = collect(plain, "append", tmp_path, "plain")
    assert rows(kept.in_time(), "2029-01-01") == rows(shown, "2029-01-01") != rows(want)
    watermark = max(r.ts for r in parts[0].collect()).timestamp() - 3600
    late = sum((r.ts.timestamp() // 21600 + 1) * 21600 <= watermark for r in parts[2].collect())
    assert kept.late_rows() == late > 10
    kept.writer()(parts[2], 2)
    assert rows(kept.repaired(), "2029-01-01") == rows(want)


@pytest.mark.parametrize("policy, closed", [("max", 3), ("min", 0)])
def test_an_idle_input_holds_windows_or_not(spark, tmp_path, policy, closed):
    """Two inputs under a watermark each, one of them silent after its first row: windows close with the faster one under ``max`` and
    wait for the slower under ``min``."""
    make = lambda s: spark.createDataFrame([(x,) for x in s], "s long").select(F.timestamp_seconds(F.col("s") + T0).alias("ts"), F.lit("k").alias("key"))
    busy = batches(spark, [make([0, 100]), make([700, 1300]), make([1900, 5000])], tmp_path, f"busy{policy}")
    idle = batches(spark, [make([10])], tmp_path, f"idle{policy}")
    before = spark.conf.get("spark.sql.streaming.multipleWatermarkPolicy")
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", policy)
    try:
        both = busy.withWatermark("ts", "1 second").unionByName(idle.withWatermark("ts", "1 second"))
        out = T.windowed(both, ["key"], "10 minutes", None, {"n": F.count("*")})
        got = collect(out, "append", tmp_path, f"idle_{policy}")
        assert got.count() >= closed and (got.count() == 0) == (closed == 0)
        if closed:
            assert got.orderBy("window_end").first().n == 3
    finally:
        spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", before)
