"""Exact top-k search by inner product with a pivot-distance index.

Vectors of whole numbers are lifted by one coordinate, sqrt(M - |x|^2) with M the largest squared norm, which
turns the largest inner product into the least distance: |q - x|^2 = |q|^2 + M - 2 q.x. Each vector is keyed by
its nearest pivot and its distance to it; a pivot's vectors, sorted by distance, are cut into annuli of about
``ring_rows``. By the triangle inequality no vector of an annulus [low, high] around pivot p is nearer to q than
low - d(q, p) or d(q, p) - high. A query first searches the annulus it falls into itself, which bounds its k-th
best; then it expands to exactly those annuli whose bound doesn't rule them out. Nothing is approximate: an
annulus is left out only if it can't hold a better vector. In high dimensions few are left out, and the search is
a scan in blocks.

Queries meet annuli in groups of bounded size (an annulus, split by hash if many distances are equal, and 2,048
queries); neither side is broadcast or gathered. Equal vectors are one index row with their smallest ids. Pivots
are chosen, farthest first, from at most ``sample_rows`` vectors; the choice affects speed alone.

Defined cases: rows with a null id, or a vector that is null, empty, of a rarer length or holds null or non-finite
components, take no part, zero vectors do; repeated (id, vector) rows count once; one id with several vectors is
several queries and candidates; products beyond 64 bits wrap around; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scratch import save, table
from .vectors import best, classes, matrix, meet, queries, ranked, spread, usable

_OUT = pa.schema([("qno", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
_SLACK = 1e-6
RINGS = 256


def whole(v: DataFrame, scale: float) -> DataFrame:
    """Components as floor(scale * x)."""
    return v.withColumn("embedding", F.transform("embedding", lambda x: F.floor(x * F.lit(float(scale))).cast("double")))


def _lift(x: np.ndarray, top: float) -> np.ndarray:
    return np.concatenate([x, np.sqrt(np.maximum(0, top - (x**2).sum(1)))[:, None]], 1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, (a**2).sum(1)[:, None] - 2 * a @ b.T + (b**2).sum(1)))


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Whole inner products, rows of ``q`` by rows of ``x``: in doubles where they are exact, else in 64-bit integers."""
    if np.abs(x).max(initial=0) * np.abs(q).max(initial=0) * max(1, x.shape[1]) < 2**53:
        return np.rint(q @ x.T).astype(np.int64)
    return q.astype(np.int64) @ x.astype(np.int64).T


def choose_pivots(x: np.ndarray, top: float, n: int) -> np.ndarray:
    """Lifted pivots, each the vector farthest from those before it."""
    y = _lift(x, top)
    at = [0]
    d = _distances(y, y[:1])[:, 0]
    while len(at) < min(n, len(y)) and d.max() > 0:
        at.append(int(d.argmax()))
        d = np.minimum(d, _distances(y, y[at[-1:]])[:, 0])
    return y[at]


def _search(rows: pa.Table, some: pa.Table, k: int) -> pa.Table:
    """The k best of an annulus for each query."""
    cols: list[list] = [[], [], [], []]
    if len(rows) and len(some):
        x = matrix(rows["embedding"])
        ids, owner = spread(rows["ids"])
        for at in range(0, len(some), 256):
            part = some.slice(at, 256)
            s = products(x, matrix(part["embedding"]))
            for i, (qno, qid) in enumerate(zip(part["qno"].to_pylist(), part["query_id"].to_pylist())):
                mine = s[i][owner]
                other = ids != qid
                b = best(mine[other], ids[other], k)
                for col, val in zip(cols, ([qno] * len(b), [qid] * len(b), ids[other][b].tolist(), mine[other][b].tolist())):
                    col.extend(val)
    return pa.table([pa.array(c, f.type) for c, f in zip(cols, _OUT)], schema=_OUT)


def top_products(vectors: DataFrame, every: int = 50, k: int = 5, scale: float = 256.0, pivots: int = 8, ring_rows: int = 4096, sample_rows: int = 4096) -> DataFrame:
    """query_id, rank, vec_id, score."""
    empty = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    v = whole(usable(vectors, nonzero=False), scale)
    sample = v.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("embedding").toArrow()
    if not len(sample):
        return empty
    top = float(v.agg(F.max(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x))).first()[0])
    piv = choose_pivots(matrix(sample["embedding"]), top, pivots)

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                d = _distances(_lift(matrix(b.column(0)), top), piv)
                p = d.argmin(1)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p, pa.int32()), pa.array(d[np.arange(len(p)), p])], names=["embedding", "ids", "pivot", "dist"])

    keyed = save(classes(v, k).mapInArrow(key, "embedding array<double>, ids array<long>, pivot int, dist double"), "pivot-keys")
    # annuli: a pivot's distances cut at their quantiles, RINGS at most; what is still large is split by hash
    per = [r.asDict() for r in keyed.groupBy("pivot").agg(F.count("*").alias("n")).collect()]  # a row a pivot
    most = min(RINGS, max(1, -(-max(r["n"] for r in per) // ring_rows)))
    cuts = keyed.groupBy("pivot").agg(F.count("*").alias("n"), F.percentile_approx("dist", [i / most for i in range(1, most + 1)], 10 * most + 100).alias("q"))
    # approximate quantiles depend on the order of merging: taken once, so that a vector has one ring for all that follows
    cuts = save(cuts, "pivot-cuts")
    rings = keyed.join(cuts.select(F.col("pivot").alias("_p"), "q"), F.col("pivot") == F.col("_p")).withColumn("ring", F.size(F.filter("q", lambda c: c < F.col("dist")))).drop("_p", "q")
    facts = rings.groupBy("pivot", "ring").agg(F.count("*").alias("n"), F.min("dist").alias("low"), F.max("dist").alias("high"))
    facts = save(facts.withColumn("parts", F.ceil(F.col("n") / (2 * ring_rows)).cast("int")), "pivot-rings")
    placed = rings.join(facts.select(F.col("pivot").alias("_p"), F.col("ring").alias("_r"), "parts"), (F.col("pivot") == F.col("_p")) & (F.col("ring") == F.col("_r")))
    placed = placed.withColumn("part", F.pmod(F.xxhash64("ids"), F.col("parts")).cast("int")).select("pivot", "ring", "part", "ids", "embedding")

    def pivot_distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                q = matrix(b.column(0))
                d = _distances(np.concatenate([q, np.zeros((len(q), 1))], 1), piv)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(list(d), pa.list_(pa.float64()))], names=["embedding", "qno", "query_id", "qblock", "qblocks", "dists"])

    asked = save(queries(v, every).select("embedding", "qno", "query_id", "qblock", "qblocks").mapInArrow(pivot_distances, "embedding array<double>, qno long, query_id long, qblock int, qblocks int, dists array<double>"), "pivot-queries")
    one = asked.select("qblocks").first()
    if one is None:
        return empty
    qblocks = one[0]
    near = asked.withColumn("at", F.transform("dists", lambda d, p: F.struct(p.alias("p"), d.alias("d"))))
    near = near.select("qno", "query_id", "qblock", "embedding", F.explode("at").alias("z")).select("qno", "query_id", "qblock", "embedding", F.col("z.p").alias("pivot"), F.col("z.d").alias("d"))
    pairs = near.join(facts.select(F.col("pivot").alias("_p"), "ring", "low", "high", "parts"), F.col("pivot") == F.col("_p"))
    pairs = pairs.withColumn("bound", F.greatest(F.col("low") - F.col("d"), F.col("d") - F.col("high"), F.lit(0.0)))
    spread_parts = lambda df: df.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    home = pairs.groupBy("qno").agg(F.min(F.struct("bound", F.col("d").alias("d"), "pivot", "ring")).alias("h")).select(F.col("qno").alias("_q"), F.col("h.pivot").alias("hp"), F.col("h.ring").alias("hr"))
    home = save(home, "pivot-home")
    pairs = pairs.join(home, F.col("qno") == F.col("_q"))
    at_home = (F.col("pivot") == F.col("hp")) & (F.col("ring") == F.col("hr"))
    data = placed.withColumn("qblock", F.explode(F.sequence(F.lit(0), F.lit(qblocks - 1))))
    keys = ["pivot", "ring", "part", "qblock"]
    schema = "qno long, query_id long, vec_id long, score long"
    work = lambda a, b: _search(a, b, k)
    take = lambda df: spread_parts(df).select(*keys, "qno", "query_id", "embedding")
    first = save(ranked_parts(meet(data, take(pairs.filter(at_home)), keys, work, schema), k), "pivot-first")
    # |q|^2 + M - 2 * (k-th best so far): what is farther can't be among the k best
    kth = first.groupBy("qno").agg(F.count("*").alias("have"), F.min("score").alias("kth")).withColumnRenamed("qno", "_q2")
    norm = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)
    rest = pairs.filter(~at_home).join(kth, F.col("qno") == F.col("_q2"), "left")
    reach = F.sqrt(F.greatest(norm + F.lit(top) - 2 * F.col("kth"), F.lit(0.0)))
    open_ = F.col("have").isNull() | (F.col("have") < k) | (F.col("bound") <= reach * (1 + _SLACK) + _SLACK)
    more = meet(data, take(rest.filter(open_)), keys, work, schema)
    return ranked(first.unionByName(more), k, "long")


def ranked_parts(found: DataFrame, k: int) -> DataFrame:
    return found.withColumn("r", F.row_number().over(W.partitionBy("qno").orderBy(F.desc("score"), "vec_id"))).filter(F.col("r") <= k).drop("r")


def op10_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(table(spark, sf_dir, "embeddings"))


OP10_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
