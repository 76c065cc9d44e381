"""A key-value table: strings, hashes, lists and sets with expiry, as rows key, field, value, seq, updated_at, expires_at.

Strings have an empty field; hash entries their field; list items the field ``[]`` and a sequence number; set
members themselves as field. Functions return the table after a write, so that a micro-batch can replace it (see
:func:`tidemark.sources.sinks.upsert_files`); expired rows never come back from reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

LIST = "[]"


def _rows(df: DataFrame, field: Column, now: Column, ttl_s: int | None, seq: Column | None = None) -> DataFrame:
    end = now + F.make_dt_interval(secs=F.lit(ttl_s)) if ttl_s is not None else F.lit(None).cast("timestamp")
    return df.select(F.col("key").cast("string"), field.cast("string").alias("field"), F.col("value").cast("string"), (seq if seq is not None else F.lit(0)).cast("long").alias("seq"), now.cast("timestamp").alias("updated_at"), end.cast("timestamp").alias("expires_at"))


def alive(kv: DataFrame, now: Column) -> DataFrame:
    return kv.filter(F.col("expires_at").isNull() | (F.col("expires_at") > now))


def last(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key."""
    return df.withColumn("_r", F.row_number().over(W.partitionBy(*keys).orderBy(F.desc(order)))).filter(F.col("_r") == 1).drop("_r")


def _with(kv: DataFrame, new: DataFrame, now: Column) -> DataFrame:
    """Living rows and new ones in one table, ``_new`` telling which: a write reads both once, however many writes are chained."""
    return alive(kv, now).withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))


def _kept(both: DataFrame, by: list[str], new: bool = True) -> DataFrame:
    """Of each group the new rows if it has any, and else all old ones; or the other way round."""
    wanted = (F.max if new else F.min)("_new").over(W.partitionBy(*by))
    return both.withColumn("_t", wanted).filter(F.col("_new") == F.col("_t")).drop("_t", "_new")


def set_strings(kv: DataFrame, rows: DataFrame, now: Column, ttl_s: int | None, order: str) -> DataFrame:
    """SET with expiry: rows key, value; the last of a batch wins, and a key has nothing else."""
    return _kept(_with(kv, _rows(last(rows, ["key"], order), F.lit(""), now, ttl_s), now), ["key"])


def set_fields(kv: DataFrame, rows: DataFrame, now: Column, ttl_s: int | None, order: str, replace: bool = False) -> DataFrame:
    """HSET: rows key, field, value. ``replace``: a key's other fields go."""
    both = _with(kv, _rows(last(rows, ["key", "field"], order), F.col("field"), now, ttl_s), now)
    return _kept(both, ["key"] if replace else ["key", "field"])


def push(kv: DataFrame, rows: DataFrame, now: Column, ttl_s: int | None, order: str, left: bool = False) -> DataFrame:
    """LPUSH or RPUSH: rows key, value in ``order``."""
    r = F.row_number().over(W.partitionBy("key").orderBy(order))
    both = _with(kv, _rows(rows.withColumn("_seq", r), F.lit(LIST), now, ttl_s, F.col("_seq")), now)
    held = F.when((F.col("_new") == 0) & (F.col("field") == LIST), F.col("seq"))
    of = W.partitionBy("key")
    both = both.withColumn("_lo", F.min(held).over(of)).withColumn("_hi", F.max(held).over(of))
    seq = F.coalesce("_lo", F.lit(1)) - F.col("seq") if left else F.coalesce("_hi", F.lit(-1)) + F.col("seq")
    return both.withColumn("seq", F.when(F.col("_new") == 1, seq).otherwise(F.col("seq")).cast("long")).drop("_lo", "_hi", "_new")


def add_members(kv: DataFrame, rows: DataFrame, now: Column, ttl_s: int | None) -> DataFrame:
    """SADD: rows key, value; a member that is there stays as it is."""
    return _kept(_with(kv, _rows(rows.select("key", "value").distinct(), F.col("value"), now, ttl_s), now), ["key", "field"], False)


def scan(kv: DataFrame, pattern: str, now: Column, kind: str = "string") -> DataFrame:
    """key, value of keys like ``pattern`` (SQL): a string, the head of a list, the least member of a set, or the
    first field's value of a hash."""
    d = alive(kv, now).filter(F.col("key").like(pattern))
    if kind == "string":
        return d.filter(F.col("field") == "").select("key", "value")
    if kind == "list":
        return d.filter(F.col("field") == LIST).groupBy("key").agg(F.min_by("value", "seq").alias("value"))
    return d.filter(~F.col("field").isin("", LIST)).groupBy("key").agg(F.min_by("value", "field").alias("value"))
