"""What the two vector searches share: which rows take part, copies as one class, and blocks of rows that meet
blocks of queries."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scratch import save

QUERY_ROWS = 2048


def finite(vectors: DataFrame, *also: str) -> DataFrame:
    """vec_id, embedding (array of double) and the columns ``also`` of the rows with an id and a vector of finite components."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), *also)
    return v.filter(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))


def usable(vectors: DataFrame, nonzero: bool) -> DataFrame:
    """vec_id, embedding (array of double) of the rows that take part: an id, a vector, finite components only,
    and of the length that most such vectors have."""
    v = finite(vectors)
    if nonzero:
        v = v.filter(F.exists("embedding", lambda x: x != 0))
    common = v.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    return v.filter(F.size("embedding") == (common["d"] if common else 0))


def classes(v: DataFrame, k: int, *also: str) -> DataFrame:
    """ids, embedding (and the columns ``also``): equal vectors as one row with the k + 1 smallest of their ids, all that a
    search for the first k can return of them. Two limits, the first on hashed parts, so that no task gathers a common
    vector."""
    by = ["embedding", *also]
    part = F.pmod(F.xxhash64("vec_id"), F.lit(64))
    first = v.withColumn("part", part).withColumn("r", F.dense_rank().over(W.partitionBy(*by, "part").orderBy("vec_id"))).filter(F.col("r") <= k + 1)
    few = first.select("vec_id", *by).distinct()
    second = few.withColumn("r", F.row_number().over(W.partitionBy(*by).orderBy("vec_id"))).filter(F.col("r") <= k + 1)
    return second.groupBy(*by).agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def queries(v: DataFrame, every: int) -> DataFrame:
    """qno (a row number), query_id, embedding of the rows whose id is divisible by ``every``, in blocks of about QUERY_ROWS."""
    q = save(v.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "embedding").distinct().withColumn("qno", F.monotonically_increasing_id()), "vec-queries")
    n = max(1, -(-q.count() // QUERY_ROWS))
    return q.withColumn("qblock", F.pmod(F.xxhash64("qno"), F.lit(n)).cast("int")).withColumn("qblocks", F.lit(n))


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column of equal lengths."""
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(a.flatten(), float).reshape(len(a), -1) if len(a) else np.zeros((0, 0))


def best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest scores, ties to smaller ids."""
    if len(score) > k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        at = np.flatnonzero(score >= least)
    else:
        at = np.arange(len(score))
    return at[np.lexsort((ids[at], -score[at]))][:k]


def spread(ids: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All ids of classes, and each one's class."""
    a = ids.combine_chunks()
    return np.asarray(a.flatten(), np.int64), np.repeat(np.arange(len(a)), np.diff(np.asarray(a.offsets)))


def ranked(found: DataFrame, k: int, score_type: str) -> DataFrame:
    """The k best of each query over all blocks: query_id, rank, vec_id, score."""
    r = F.row_number().over(W.partitionBy("qno").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", r).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.col("score").cast(score_type).alias("score"))


def meet(data: DataFrame, asked: DataFrame, keys: list[str], work: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    return data.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(work, schema)
