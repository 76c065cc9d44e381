"""Reports on skewed keys and partitions, and aggregation with hot keys salted.

Heavy hitters come from Spark's mergeable frequent-items sketch (of the Misra-Gries family), one small row a task and window, so
finding hot keys shuffles no counts by key. With a map of s counters over N rows a count is off by 3.5 N / s at most and
every key of more than twice that is reported; :func:`counters` gives the size at which no key of the wanted share is missed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hot_keys(df: DataFrame, key: str, times: float = 3.0, least: int = 1000, top: int = 10) -> DataFrame:
    """The ``top`` keys with ``times`` the mean count and at least ``least`` rows."""
    n = df.groupBy(key).agg(F.count("*").alias("n"))
    mean = n.agg(F.avg("n").alias("mean"))
    return n.join(F.broadcast(mean)).filter((F.col("n") >= times * F.col("mean")) & (F.col("n") >= least)).orderBy(F.desc("n"), key).limit(top).select(key, "n", F.round("mean", 6).alias("mean"))


def window_shares(df: DataFrame, key: str, size: str = "1 minute", share: float = 0.7, least: int = 100, fraction: float | None = None, seed: int = 1, ts: str = "ts") -> DataFrame:
    """Keys with ``share`` of the rows of a window that has ``least`` of them; ``fraction`` samples rows first."""
    d = df.sample(fraction=fraction, seed=seed) if fraction else df
    n = d.groupBy(F.window(ts, size).alias("w"), key).agg(F.count("*").alias("n"))
    total = n.groupBy("w").agg(F.sum("n").alias("total"))
    return n.join(total, "w").filter((F.col("total") >= least) & (F.col("n") >= share * F.col("total"))).select(F.col("w.end").alias("window_end"), key, "n", "total")


def counters(share: float) -> int:
    """Items that a sketch tracks so that no key with ``share`` of the rows is missed: a key is reported from 7 / size of the rows on,
    and the map has at least as many places as items."""
    if not 0 < share <= 1:
        raise ValueError("a share lies above 0 and is 1 at most")
    return max(16, -int(-7.0 / share // 1))


def hot_sketches(df: DataFrame, key: str, share: float, size: str | None = None, ts: str = "ts") -> DataFrame:
    """sketch and total of all rows, or with window_end of each tumbling window of ``size``; sketches merge with
    ``approx_top_k_combine``. Works in streams."""
    aggs = [F.expr(f"approx_top_k_accumulate(`{key}`, {counters(share)})").alias("sketch"), F.count("*").alias("total")]
    if size is None:
        return df.agg(*aggs)
    return df.groupBy(F.window(ts, size).alias("w")).agg(*aggs).select(F.col("w.end").alias("window_end"), "sketch", "total")


def heavy_hitters(df: DataFrame, key: str, share: float, size: str | None = None, ts: str = "ts") -> DataFrame:
    """(window_end,) ``key``, n (estimated), total: every key that has ``share`` of the rows, and perhaps some that have a little less.
    At most 2 / share rows a window. Works in streams."""
    s = hot_sketches(df, key, share, size, ts)
    most = -int(-2 / share // 1)
    found = s.withColumn("_x", F.explode(F.expr(f"approx_top_k_estimate(sketch, {min(most, counters(share))})")))
    over = F.lit(3.5 / counters(share)) * F.col("total")
    out = found.select(*[x for x in s.columns if x == "window_end"], F.col("_x.item").alias(key), F.col("_x.count").alias("n"), "total")
    return out.filter(F.col("n") + over >= share * F.col("total"))


def window_hot_keys(df: DataFrame, key: str, share: float, size: str, ts: str = "ts") -> DataFrame:
    """window_end, ``key``, n, total of exactly the keys with ``share`` of a window's rows: only rows of the sketches' candidates
    are counted by key."""
    found = heavy_hitters(df, key, share, size, ts).select("window_end", F.col(key).alias("_k"), "total")
    rows = df.select(key, F.window(ts, size).alias("_w")).select(key, F.col("_w.end").alias("_e"))
    exact = rows.join(found, (rows[key] == F.col("_k")) & (F.col("_e") == F.col("window_end"))).groupBy("window_end", key, "total").agg(F.count("*").alias("n"))
    return exact.filter(F.col("n") >= share * F.col("total")).select("window_end", key, "n", "total")


def hot_salts(df: DataFrame, key: str, share: float = 0.01, tasks: int | None = None, each: int = 8) -> dict:
    """Hot keys and into how many salts each goes: ``each`` for every task that its share would fill. At most 2 / share keys, which
    the driver holds."""
    tasks = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return {r[key]: max(2, -int(-(r.n / r.total) * tasks * each // 1)) for r in heavy_hitters(df, key, share).collect()}


def salt_hot(df: DataFrame, key: str, salts: dict, salt_by: str | None = None) -> DataFrame:
    """Rows with ``_salt``: of hot keys a number below theirs, any or that of their ``salt_by``; of all others 0."""
    x = F.xxhash64(salt_by) if salt_by else F.monotonically_increasing_id()
    n = reduce(lambda other, kv: F.when(F.col(key) == F.lit(kv[0]), F.lit(kv[1])).otherwise(other), salts.items(), F.lit(1))
    return df.withColumn("_salt", F.pmod(x, n).cast("int"))


def salted_hot(df: DataFrame, keys: list[str], partial: dict[str, Column], final: dict[str, Column], share: float = 0.01, hot: dict | None = None, salt_by: str | None = None) -> DataFrame:
    """Two-step aggregation in which the rows of hot values of the first key alone are spread; ``final`` works on the columns that
    ``partial`` names. ``salt_by``: rows of one value of it share a salt, so that distinct values add up."""
    d = salt_hot(df, keys[0], hot_salts(df, keys[0], share) if hot is None else hot, salt_by)
    first = d.groupBy(*keys, "_salt").agg(*[a.alias(n) for n, a in partial.items()])
    return first.groupBy(*keys).agg(*[a.alias(n) for n, a in final.items()])


def partition_skew(df: DataFrame, ratio: float = 2.0, variation: float = 0.5) -> DataFrame:
    """One row: partitions, largest, smallest, mean, variation, skewed."""
    n = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"))
    s = n.agg(F.count("*").alias("partitions"), F.max("n").alias("largest"), F.min("n").alias("smallest"), F.avg("n").alias("mean"), (F.stddev_pop("n") / F.avg("n")).alias("variation"))
    return s.withColumn("skewed", (F.col("largest") / F.col("smallest") > ratio) | (F.col("variation") > variation))


def salted(df: DataFrame, keys: list[str], partial: dict[str, Column], final: dict[str, Column], salts: int = 10, salt_by: str | None = None) -> DataFrame:
    """Two-step aggregation: by key and salt, then by key. ``final`` works on the columns that ``partial`` names."""
    salt = F.pmod(F.xxhash64(salt_by), F.lit(salts)) if salt_by else F.pmod(F.monotonically_increasing_id(), F.lit(salts))
    first = df.withColumn("_salt", salt).groupBy(*keys, "_salt").agg(*[a.alias(n) for n, a in partial.items()])
    return first.groupBy(*keys).agg(*[a.alias(n) for n, a in final.items()])


def rebalance(df: DataFrame, n: int, *cols: str) -> DataFrame:
    return df.repartition(n, *cols)
