"""Lookups and stream-to-stream joins. No side is told to be broadcast: Spark does so by its bytes, estimated or measured
while the query runs (``spark.sql.autoBroadcastJoinThreshold``), and else takes a shuffled join, which AQE splits at hot
keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Weights of the eight history lists (fixed values), in their order.
HISTORY_WEIGHTS = (1.0, 1.0, 1.2, 1.3, 0.8, 1.1, 1.6, 1.5)


def with_tags(events: DataFrame, tags: DataFrame, pick=None, unknown: str | None = "unk") -> DataFrame:
    """Events with ``tag``: what ``pick`` makes of their post's ``tags`` text; posts without one are ``unknown``."""
    t = tags.select(F.col("post_id").alias("_p"), (pick(F.col("tags")) if pick else F.col("tags")).alias("tag"))
    out = events.join(t, F.col("post_id") == F.col("_p"), "left").drop("_p")
    return out.withColumn("tag", F.coalesce("tag", F.lit(unknown))) if unknown is not None else out


def lookup(rows: DataFrame, dim: DataFrame, keys: list[str], defaults: dict[str, object] | None = None) -> DataFrame:
    """Rows with the columns of a dimension; ``defaults`` where it has no row."""
    out = rows.join(dim, keys, "left")
    for n, v in (defaults or {}).items():
        out = out.withColumn(n, F.coalesce(n, F.lit(v)))
    return out


def user_types(rows: DataFrame, settings: DataFrame) -> DataFrame:
    """``user_type`` by zone mode: 1 zone, 2 block, otherwise none."""
    z = settings.select("uid", F.col("zone_mode_type").alias("_z"))
    return rows.join(z, "uid", "left").withColumn("user_type", F.when(F.col("_z") == 1, "zone").when(F.col("_z") == 2, "block").otherwise("no_zone")).drop("_z")


def members(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in a refreshed set; none while the set is empty."""
    return rows.join(wanted.select(key).distinct(), key, "left_semi")


def with_history(sessions: DataFrame, history: DataFrame, user: str = "uid", item: str = "item_id") -> DataFrame:
    """Session items paired with each item of their user's history (uid, right, weight): an equi-join, so a pair
    costs a row only where a user has both."""
    return sessions.join(history.select(F.col(user).alias("_u"), F.col("right"), F.col("weight")), F.col(user) == F.col("_u")).drop("_u")


def explode_history(profiles: DataFrame, lists: list[str], weights: tuple[float, ...] = HISTORY_WEIGHTS) -> DataFrame:
    """uid, right, weight, pos from id lists, in the lists' order."""

    def weighed(name: str, weight: float) -> Column:  # a lambda with a second argument would get the position
        return F.transform(F.coalesce(F.col(name), F.array().cast("array<bigint>")), lambda x: F.struct(x.alias("right"), F.lit(weight).alias("weight")))

    parts = [weighed(n, w) for n, w in zip(lists, weights)]
    return profiles.select("uid", F.posexplode(F.concat(*parts)).alias("pos", "x")).select("uid", "x.right", "x.weight", "pos")


def weigh_history(rows: DataFrame, weights: tuple[float, ...] = HISTORY_WEIGHTS) -> DataFrame:
    """uid, right, weight from rows (uid, right, list): each id once, with the weight of its first list (from 0). As
    :func:`explode_history` and the first place of each id, with no list held whole."""
    first = rows.groupBy("uid", "right").agg(F.min("list").alias("_list"))
    return first.select("uid", "right", F.element_at(F.array(*map(F.lit, weights)), (F.col("_list") + 1).cast("int")).alias("weight"))


def within_start(events: DataFrame, starts: DataFrame, hours: int = 48, key: str = "post_id", ts: str = "ts", start: str = "start_ts") -> DataFrame:
    """Events within [start, start + hours] of their post's start record. In streams give both a watermark."""
    s = starts.select(F.col(key).alias("_k"), F.col(start).alias(start))
    return events.join(s, (F.col(key) == F.col("_k")) & (F.col(ts) >= F.col(start)) & (F.col(ts) <= F.col(start) + F.expr(f"INTERVAL {hours} HOURS"))).drop("_k")


def unite(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def add_decayed(new: DataFrame, stored: DataFrame, keys: list[str], score: str, minute: str, now_minute: Column, base: float = 0.96, step: float = 2.0) -> DataFrame:
    """New scores plus what is left of the stored ones: score * base ** (minutes / step), rounded."""
    from tidemark.functions.scalars import step_decay

    old = stored.select(*keys, F.col(score).alias("_s"), F.col(minute).alias("_m"))
    left = F.coalesce(step_decay(F.col("_s"), F.greatest(F.lit(0), now_minute - F.col("_m"))), F.lit(0))
    return new.join(old, keys, "left").withColumn(score, (F.col(score) + left).cast("long")).withColumn(minute, now_minute.cast("long")).drop("_s", "_m")
