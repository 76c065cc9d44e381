"""Heavy hitters: nothing of the wanted share is missed, sketches merge, streams; and salting of hot keys alone."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_streams import collect, replayed, with_sentinel
from tidemark.operators import skew
from tidemark.plans.domain import events


def zipf(spark, n=200_000, a=1.3):
    rng = np.random.default_rng(4)
    keys = np.minimum(rng.zipf(a, n), 10**6).astype("int64")
    return spark.createDataFrame([(int(k), i) for i, k in enumerate(keys)], "key long, id long").repartition(16), keys


@pytest.mark.parametrize("share", [0.2, 0.01, 0.002])
def test_no_key_of_the_share_is_missed(spark, share):
    df, keys = zipf(spark)
    got = {r.key: r.n for r in skew.heavy_hitters(df, "key", share).collect()}
    names, counts = np.unique(keys, return_counts=True)
    wanted = dict(zip(names[counts >= share * len(keys)].tolist(), counts[counts >= share * len(keys)].tolist()))
    slack = 3.5 / skew.counters(share) * len(keys)
    assert set(wanted) <= set(got) and len(got) <= 2 / share
    assert all(abs(got[k] - n) <= slack for k, n in wanted.items())
    exact = dict(zip(names.tolist(), counts.tolist()))
    assert all(exact[k] >= share * len(keys) - 2 * slack for k in got)


def test_a_flat_table_has_none(spark):
    assert skew.heavy_hitters(spark.range(50_000).withColumnRenamed("id", "key"), "key", 0.01).count() == 0
    assert skew.heavy_hitters(spark.createDataFrame([], "key long"), "key", 0.01).count() == 0


def test_stream_finds_what_a_batch_finds(spark, sf, tmp_path):
    e = events(spark, sf)
    make = lambda d: skew.heavy_hitters(d, "uid", 0.05, "5 days")
    got = collect(make(replayed(spark, with_sentinel(e), tmp_path, "hot").withWatermark("ts", "1 hour")), "append", tmp_path, "hot")
    rows = lambda d: sorted(map(tuple, d.filter("window_end < '2029-01-01'").select("window_end", "uid", "n", "total").collect()))
    assert rows(got) == rows(make(e)) and len(rows(got)) > 3


def test_hot_keys_alone_are_spread(spark):
    """A key with a third of the rows: after salting the largest of 8 tasks has less than twice the median's rows, other keys keep one
    salt, and sums and distinct counts stay."""
    df = spark.range(60_000).selectExpr("if(id % 3 = 0, -1L, id % 997) as key", "id % 500 as user", "id")
    hot = skew.hot_salts(df, "key", 0.05, tasks=8)
    assert set(hot) == {-1} and hot[-1] >= 16
    salted = skew.salt_hot(df, "key", hot)
    assert salted.filter("key >= 0 and _salt > 0").count() == 0
    tasks = sorted(r["count"] for r in salted.repartition(8, "key", "_salt").groupBy(F.spark_partition_id()).count().collect())
    plain = sorted(r["count"] for r in df.repartition(8, "key").groupBy(F.spark_partition_id()).count().collect())
    assert tasks[-1] < 2 * tasks[len(tasks) // 2] and plain[-1] > 2 * plain[len(plain) // 2]
    got = skew.salted_hot(df, ["key"], {"n": F.count("*"), "u": F.count_distinct("user")}, {"n": F.sum("n"), "users": F.sum("u")}, 0.05, salt_by="user")
    want = df.groupBy("key").agg(F.count("*").alias("n"), F.count_distinct("user").alias("users"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_shares_out_of_range(spark):
    for share in (0, -1, 2):
        with pytest.raises(ValueError):
            skew.counters(share)
