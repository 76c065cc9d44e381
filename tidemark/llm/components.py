"""Connected components of an edge table: alternating large-star and small-star steps, between which each task contracts
the edges it holds to stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .scratch import free, save

#: Edges that a task contracts at once; a step deals about as many to each task.
CHUNK = 1 << 18


def components(edges: DataFrame, max_steps: int = 50) -> DataFrame:
    """id, component (the smallest id reachable) of every id in ``edges`` (a, b). Tasks replace the edges they hold by
    stars, at most one edge a node and CHUNK: what joins the smallest id stays, so that steps only go further, and a forest of
    stars stays as it is. Each step is a partially
    aggregated minimum and a join that Spark can split at a node with very many neighbours; the number of
    steps grows with the logarithm of the longest chain. The driver sees a count and a checksum. Raises RuntimeError if
    ``max_steps`` don't suffice."""
    e, sign = _saved(_contracted(edges.filter(F.col("a") != F.col("b"))))
    for _ in range(max_steps):
        if not sign[0]:
            break
        new, now = _saved(_contracted(_small_star(_large_star(e)).coalesce(-(-sign[0] // CHUNK))))
        free(e)
        e, old, sign = new, sign, now
        if old == sign:
            break
    else:
        raise RuntimeError(f"components: not settled after {max_steps} steps")
    ids = e.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = e.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return ids.unionByName(roots)


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the edges but the smallest of its component, with that smallest one."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(ids))
    while True:
        rx, ry = root[x], root[y]
        if (rx == ry).all():
            break
        np.minimum.at(root, np.maximum(rx, ry), np.minimum(rx, ry))
        while (root[root] != root).any():
            root = root[root]
    below = np.flatnonzero(root != np.arange(len(ids)))
    return ids[below], ids[root[below]]


def _contracted(e: DataFrame) -> DataFrame:
    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            held.append(b)
            n += len(b)
            if n >= CHUNK:
                yield stars(held)
                held, n = [], 0
        if n:
            yield stars(held)

    def stars(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        ends = _stars(*(np.concatenate([b.column(i).to_numpy() for b in held]) for i in (0, 1)))
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in ends], names=["a", "b"])

    return e.select(F.col("a").cast("long"), F.col("b").cast("long")).mapInArrow(contract, "a long, b long")


def _saved(e: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges as a table, and their count and checksum, observed while it is written."""
    seen = Observation()
    checksum = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    out = save(e.observe(seen, F.count(F.lit(1)).alias("n"), checksum.alias("s")), "cc-edges")
    return out, (seen.get["n"], seen.get["s"])


def _large_star(e: DataFrame) -> DataFrame:
    """Larger neighbours of a node are linked with its smallest neighbour; a link may come twice, which the next step
    doesn't mind."""
    both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    out = both.filter(F.col("v") > F.col("u")).join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return out.filter(F.col("a") != F.col("b"))


def _small_star(e: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and the node, are linked with the smallest of them; a link may come twice."""
    e = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    out = e.join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.filter(F.col("a") != F.col("b"))
