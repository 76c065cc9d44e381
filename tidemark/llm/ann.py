"""Approximate nearest neighbours by additive quantisation.

A vector is the sum of one entry from each of M full-dimensional codebooks. Codebooks start from k-means on
residuals and are refitted together by least squares; a vector is encoded by beam search, which keeps the
``beam`` best partial sums after each codebook. The index holds the codes, the squared norm of the sum and the
length of what the sum leaves of the vector. A query turns into a table of its products with all entries; a
vector's approximate score is M look-ups, and its exact score lies above that by at most the length of the rest.
In each block, the ``rerank`` vectors of the largest bounds are scored exactly on the originals, and after them
all whose bound reaches the k-th exact score found: none that could be among the k best is left out, and a group
of nearly equal vectors, however large, is scored whole.

The fit takes at most ``train_rows`` vectors, those of least hashed id (a documented bound); every vector is
indexed. Index rows lie in blocks of about ``block_rows``, queries in blocks of 2,048, and each pair of blocks is
one group: neither the index nor the queries are ever broadcast or gathered, and no block grows. Equal vectors
are one index row with their smallest ids, so a vector that a third of all rows share costs one row.

Defined cases: rows with a null id, or a vector that is null, empty, zero, of a rarer length or holds null or
non-finite components, take no part; repeated (id, vector) rows count once; one id with several vectors is several queries
and candidates; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import save, table
from .vectors import best, classes, matrix, meet, queries, ranked, spread, usable

#: For rounding of look-ups in single precision.
_SLACK = 1e-5


@dataclass
class Codebooks:
    entries: np.ndarray  # books, entries, dimensions

    def encode(self, x: np.ndarray, beam: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """Codes by beam search, and the squared norms of the sums they stand for."""
        books, k, _ = self.entries.shape
        n = len(x)
        codes = np.zeros((n, 1, 0), np.uint8)
        rest = x[:, None, :]
        for c in self.entries:
            err = (rest**2).sum(2)[:, :, None] - 2 * rest @ c.T + (c**2).sum(1)
            width = min(beam, err.shape[1] * k)
            flat = err.reshape(n, -1)
            at = np.argpartition(flat, width - 1, 1)[:, :width]
            b, e = at // k, at % k
            codes = np.concatenate([np.take_along_axis(codes, b[:, :, None], 1), e[:, :, None].astype(np.uint8)], 2)
            rest = np.take_along_axis(rest, b[:, :, None], 1) - c[e]
        i = (rest**2).sum(2).argmin(1)
        own = codes[np.arange(n), i]
        return own, (self.decode(own) ** 2).sum(1)

    def decode(self, codes: np.ndarray) -> np.ndarray:
        return sum(c[codes[:, m]] for m, c in enumerate(self.entries))

    def tables(self, q: np.ndarray) -> np.ndarray:
        """Products of queries with all entries: books, entries, queries."""
        return np.einsum("mkd,qd->mkq", self.entries, q)


def unit(x: np.ndarray) -> np.ndarray:
    """Of length 1; scaled by the largest component first, so that squares neither vanish nor overflow."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x**2).sum(1, keepdims=True))


def fit_codebooks(x: np.ndarray, books: int = 16, entries: int = 64, rounds: int = 2, seed: int = 5) -> Codebooks:
    rng = np.random.default_rng(seed)
    k = min(entries, max(1, len(x)))
    rest, got = x.copy(), []
    for _ in range(books):
        c = rest[rng.choice(len(rest), k, replace=False)]
        for _ in range(8):
            at = ((c**2).sum(1) - 2 * rest @ c.T).argmin(1)
            n = np.bincount(at, minlength=k)
            total = np.zeros_like(c)
            np.add.at(total, at, rest)
            c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], rest[rng.integers(len(rest), size=k)])
        got.append(c)
        rest = rest - c[((c**2).sum(1) - 2 * rest @ c.T).argmin(1)]
    model = Codebooks(np.array(got))
    for _ in range(rounds):
        codes, _ = model.encode(x)
        one = np.zeros((len(x), books * k), np.float32)
        for m in range(books):
            one[np.arange(len(x)), m * k + codes[:, m].astype(int)] = 1
        gram = (one.T @ one).astype(float) + 1e-2 * np.eye(books * k)
        model = Codebooks(np.linalg.solve(gram, one.T.astype(float) @ x + 1e-2 * model.entries.reshape(books * k, -1)).reshape(books, k, -1))
    return model


def train(v: DataFrame, train_rows: int = 8192) -> Codebooks | None:
    sample = v.orderBy(F.xxhash64("vec_id"), "vec_id").limit(train_rows).select("embedding").toArrow()
    x = matrix(sample["embedding"])
    return fit_codebooks(unit(x)) if len(x) else None


def build_index(v: DataFrame, model: Codebooks, k: int = 5, block_rows: int = 4096) -> DataFrame:
    """ids, embedding, codes, norm, rest, block, blocks for every class of equal vectors."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, len(big), 1024):
                b = big.slice(at, 1024)
                x = unit(matrix(b.column(0)))
                codes, norm = model.encode(x)
                rest = np.sqrt(((x - model.decode(codes)) ** 2).sum(1))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(norm), pa.array(rest)], names=["embedding", "ids", "codes", "norm", "rest"])

    index = save(classes(v, k).mapInArrow(encode, "embedding array<double>, ids array<long>, codes binary, norm double, rest double"), "aq-index")
    blocks = max(1, -(-index.count() // block_rows))
    return index.withColumn("block", F.pmod(F.xxhash64("ids", "codes"), F.lit(blocks)).cast("int")).withColumn("blocks", F.lit(blocks))


def search(index: DataFrame, asked: DataFrame, model: Codebooks, blocks: int, qblocks: int, k: int = 5, rerank: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score."""
    data = index.withColumn("qblock", F.explode(F.sequence(F.lit(0), F.lit(qblocks - 1)))).select("block", "qblock", "ids", "embedding", "codes", "rest")
    q = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select("block", "qblock", "qno", "query_id", "embedding")
    out = pa.schema([("qno", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def work(rows: pa.Table, some: pa.Table) -> pa.Table:
        cols: list[list] = [[], [], [], []]
        if len(rows) and len(some):
            x = unit(matrix(rows["embedding"]))
            codes = np.frombuffer(b"".join(rows["codes"].to_pylist()), np.uint8).reshape(len(x), -1)
            rest = rows["rest"].to_numpy() + _SLACK
            ids, owner = spread(rows["ids"])
            first = np.searchsorted(owner, np.arange(len(x)))
            many = np.searchsorted(owner, np.arange(len(x)), "right")

            def expand(c: np.ndarray, exact: np.ndarray, but: int) -> tuple[np.ndarray, np.ndarray]:
                """Scores and ids of the members of classes ``c``, without one id."""
                cand = np.concatenate([ids[first[j] : many[j]] for j in c]) if len(c) else ids[:0]
                other = cand != but
                return np.repeat(exact, (many - first)[c])[other], cand[other]

            for at in range(0, len(some), 256):
                part = some.slice(at, 256)
                q = unit(matrix(part["embedding"]))
                lut = model.tables(q).astype(np.float32)
                near = np.zeros((len(x), len(q)), np.float32)
                for m in range(lut.shape[0]):
                    near += lut[m][codes[:, m]]
                bound = near.T + rest
                asks = list(zip(part["qno"].to_pylist(), part["query_id"].to_pylist()))
                r = min(rerank, len(x))
                top = np.argpartition(bound, len(x) - r, 1)[:, len(x) - r :]
                kth = np.full(len(q), -np.inf)
                for i, (_, qid) in enumerate(asks):
                    exact, cand = expand(top[i], (x[top[i]] * q[i]).sum(1), qid)
                    if len(cand) >= k:
                        kth[i] = np.partition(exact, len(exact) - k)[len(exact) - k] - _SLACK
                # all that may still beat the k-th best, for the queries together
                rows_left = np.flatnonzero((bound >= kth[:, None]).any(0))
                products = q @ x[rows_left].T
                for i, (qno, qid) in enumerate(asks):
                    at_least = np.flatnonzero(products[i] >= kth[i])
                    score, cand = expand(rows_left[at_least], products[i, at_least], qid)
                    b = best(score, cand, k)
                    cand, score = cand[b], score[b]
                    for col, val in zip(cols, ([qno] * len(cand), [qid] * len(cand), cand.tolist(), score.tolist())):
                        col.extend(val)
        return pa.table([pa.array(c, f.type) for c, f in zip(cols, out)], schema=out)

    found = meet(data, q, ["block", "qblock"], work, "qno long, query_id long, vec_id long, score double")
    return ranked(found, k, "double")


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, train_rows: int = 8192, rerank: int = 256) -> DataFrame:
    v = usable(vectors, nonzero=True)
    model = train(v, train_rows)
    if model is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = build_index(v, model, k)
    asked = queries(v, every)
    blocks, qblocks = index.select("blocks").first(), asked.select("qblocks").first()
    return search(index, asked, model, blocks[0] if blocks else 1, qblocks[0] if qblocks else 1, k, rerank)


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))
