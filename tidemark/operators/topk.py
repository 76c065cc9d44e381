"""Top-k and bounded lists. Ranks are limited before and after the shuffle, so that a list's group never holds
more than k rows of each task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def top_rows(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each key, with their rank from 1."""
    return df.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= k)


def top_list(df: DataFrame, keys: list[str], ident: str, score: str, k: int, name: str, newest_first: bool = True) -> DataFrame:
    """``keys``, ``name``: array of (id, score), largest score first, ties to smaller ids. ``newest_first`` False turns it round."""
    r = top_rows(df, keys, [F.desc(score), F.asc(ident)], k)
    items = F.sort_array(F.collect_list(F.struct("rank", F.col(ident).alias("id"), F.col(score).alias("score"))), asc=newest_first)
    return r.groupBy(*keys).agg(F.transform(items, lambda x: F.struct(x["id"].alias("id"), x["score"].alias("score"))).alias(name))


def recent_list(df: DataFrame, keys: list[str], ident: str, ts: str, k: int, name: str, oldest_first: bool = False) -> DataFrame:
    """The k ids seen last, each at its latest time."""
    last = df.groupBy(*keys, ident).agg(F.max(ts).alias("_last"))
    return top_list(last, keys, ident, "_last", k, name, newest_first=not oldest_first)


def scored_list(df: DataFrame, keys: list[str], ident: str, score: str, k: int, name: str) -> DataFrame:
    """The k ids of largest score, each at its largest."""
    best = df.groupBy(*keys, ident).agg(F.max(score).alias("_best"))
    return top_list(best, keys, ident, "_best", k, name)


def text(items: str, with_score: bool = True, digits: int | None = None) -> Column:
    """``id:score,...`` or ``id,...``."""
    def one(x):
        s = x["score"] if digits is None else F.format_number(x["score"], digits)
        return F.concat_ws(":", x["id"].cast("string"), s.cast("string")) if with_score else x["id"].cast("string")

    return F.array_join(F.transform(items, one), ",")


def last_distinct(df: DataFrame, user: str, ident: str, ts: str, n: int, least: int = 1) -> DataFrame:
    """The n distinct ids of a user by first time seen, latest n; users with fewer than ``least`` are left out."""
    first = df.groupBy(user, ident).agg(F.min(ts).alias("first_ts"))
    r = top_rows(first, [user], [F.desc("first_ts"), F.asc(ident)], n)
    enough = r.groupBy(user).agg(F.count("*").alias("_n")).filter(F.col("_n") >= least).select(user)
    return r.join(enough, user)


def history(df: DataFrame, user: str, ident: str, pos: str, k: int = 50, ts: str | None = None, as_of: Column | None = None, hours: int = 24) -> DataFrame:
    """A user's history with each id once (its first place), k at most, and none older than ``hours`` where times are known."""
    if ts is not None and as_of is not None:
        df = df.filter(F.col(ts).isNull() | (F.col(ts) >= as_of - F.expr(f"INTERVAL {hours} HOURS")))
    first = top_rows(df, [user, ident], [F.asc(pos)], 1).drop("rank")
    return top_rows(first, [user], [F.asc(pos), F.asc(ident)], k)


def merge_top(new: DataFrame, stored: DataFrame, left: str, right: str, score: str, k: int = 128, least: float = 40) -> DataFrame:
    """Neighbours of each item: new scores replace stored ones; of the rest with a score of ``least``, the k best."""
    cols = [left, right, score]
    kept = stored.select(*cols).join(new.select(left, right), [left, right], "left_anti")
    every = new.select(*cols).unionByName(kept).filter(F.col(score) >= least)
    return top_rows(every, [left], [F.desc(score), F.asc(right)], k)
