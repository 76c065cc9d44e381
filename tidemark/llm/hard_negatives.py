"""Hard-negative mining by threshold joins over norm-bounded inverted indexes.

For an anchor, its positives are the rows of its label with the largest inner products; for each positive, the negatives are the
rows of other labels with the largest products inside a window below the positive's. Both are threshold joins: *all rows with a
product of at least t*, for a t that starts high and is lowered until enough are found or the window's lower end is reached.

A block of rows is indexed by dimension, dimensions of much energy first, a few at a time. With t at hand, a row's last dimensions
are left out of the index once the norm of what follows times the longest query's can't reach t alone. Products are accumulated
over the lists; after each the rest of both norms bounds what may still come (Cauchy-Schwarz), and pairs that can't reach t any
more are dropped; when few are left, they alone are finished. Nothing is approximate.

Positives are searched among blocks of their label, negatives among blocks of all labels, each block of at most ``BLOCK`` rows;
queries meet blocks in groups of at most ``QUERY_ROWS``. Equal vectors of a label are one row with their smallest ids, and equal
anchors of a label one query, whatever their number. No side is broadcast or gathered. The work grows with queries times rows, as
the task does; bounds leave out a part of each pair's dimensions.

Defined cases: rows with a null id, a null label, or a vector that is null, empty or holds null or non-finite components take no part;
vectors meet those of their own length only; zero vectors take part; repeated (id, label, vector) rows count once; one id with
several labels or vectors is several anchors and candidates, never its own; products beyond 64 bits wrap around; positives
of a product below zero have no window; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .exact_search import whole
from .scratch import save, table
from .vectors import QUERY_ROWS, best, classes, finite, matrix, meet, spread

#: Rows of a block, queries taken at once inside it, dimensions accumulated at once.
BLOCK, AT_ONCE, STEP = 8192, 128, 8
#: Below this share of open pairs the rest is finished pair by pair; thresholds fall by this factor.
FEW, FALL = 0.25, 0.8


class Index:
    """Lists by dimension of a block's rows (whole numbers)."""

    def __init__(self, x: np.ndarray):
        self.order = np.argsort(-(x**2).sum(0), kind="stable")
        self.x = np.ascontiguousarray(x[:, self.order])
        d = x.shape[1]
        self.steps = [slice(a, min(d, a + STEP)) for a in range(0, d, STEP)]
        self.rest = self._rests(self.x)
        #: Products of one pair and step that were formed, and those of all pairs and steps.
        self.formed = self.whole = 0

    def _rests(self, y: np.ndarray) -> np.ndarray:
        """Norm of each row from each step on; the last is 0."""
        parts = np.stack([(y[:, s] ** 2).sum(1) for s in self.steps] + [np.zeros(len(y))], 1)
        return np.sqrt(np.cumsum(parts[:, ::-1], 1)[:, ::-1])

    def above(self, q: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, row and product of all pairs whose product reaches the query's ``t``; sorted by query."""
        q, n = q[:, self.order], len(self.x)
        rest = self._rests(q)
        room = 1 + 1e-9
        # steps of each row that are listed: what follows can't reach the least threshold
        listed = (self.rest[:, :-1] * (rest[:, 0].max() * room) >= t.min()).sum(1)
        self.whole += len(q) * n * len(self.steps)
        acc = np.zeros((len(q), n))
        reached = np.zeros(n, int)
        for c, s in enumerate(self.steps):
            rows = np.flatnonzero(listed > c)
            if not len(rows):
                break
            self.formed += len(q) * len(rows)
            if len(rows) == n:
                acc += q[:, s] @ self.x[:, s].T
            else:
                acc[:, rows] += q[:, s] @ self.x[rows, s].T
            reached[rows] = c + 1
            open_ = acc + rest[:, reached] * (self.rest[np.arange(n), reached] * room) >= t[:, None]
            if np.count_nonzero(open_) < FEW * open_.size:
                break
        if not reached.any():
            open_ = rest[:, :1] * (self.rest[:, 0] * room) >= t[:, None]
        qi, xi = np.nonzero(open_)
        score, at = acc[qi, xi], reached[xi]
        for c, s in enumerate(self.steps):
            on = np.flatnonzero(at <= c)
            if len(on):
                self.formed += len(on)
                score[on] += np.einsum("ij,ij->i", q[qi[on], s], self.x[xi[on], s])
                at[on] = c + 1
                keep = score + rest[qi, at] * (self.rest[xi, at] * room) >= t[qi]
                qi, xi, score, at = qi[keep], xi[keep], score[keep], at[keep]
        if np.abs(self.x).max(initial=0) * np.abs(q).max(initial=0) * max(1, q.shape[1]) < 2**53:
            score = np.rint(score).astype(np.int64)
        else:  # doubles aren't exact
            score = np.einsum("ij,ij->i", q[qi].astype(np.int64), self.x[xi].astype(np.int64))
        keep = score >= t[qi]
        return qi[keep], xi[keep], score[keep]

    def fill(self, q: np.ndarray, start: np.ndarray, floor: np.ndarray, enough: Callable[[int, np.ndarray, np.ndarray], bool]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Query, rows and products: all that reach the threshold at which ``enough`` holds, or ``floor``."""
        for a in range(0, len(q), AT_ONCE):
            todo, t = np.arange(a, min(len(q), a + AT_ONCE)), np.maximum(start, floor)[a : a + AT_ONCE]
            while len(todo):
                qi, xi, score = self.above(q[todo], t)
                ends = np.searchsorted(qi, np.arange(len(todo) + 1))
                left = []
                for k, j in enumerate(todo):
                    rows, got = xi[ends[k] : ends[k + 1]], score[ends[k] : ends[k + 1]]
                    if t[k] <= floor[j] or enough(j, rows, got):
                        yield int(j), rows, got
                    else:
                        left.append(k)
                t, todo = t[left], todo[left]
                # near zero the bounds rule nothing out: the floor at once
                near = t <= start[todo] / 16
                t = np.where(near, floor[todo], np.maximum(floor[todo], t * FALL))


_FOUND = pa.schema([("q", pa.string()), ("vec_id", pa.int64()), ("score", pa.int64())])
_SCHEMA = "q string, vec_id long, score long"


def _spread_rows(starts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the flat list of ids of the rows' ids, and which of ``rows`` each is of."""
    n = starts[rows + 1] - starts[rows]
    which = np.repeat(np.arange(len(rows)), n)
    return np.repeat(starts[rows], n) + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n), which


def _found(cols: list[list]) -> pa.Table:
    return pa.table([pa.array(c, f.type) for c, f in zip(cols, _FOUND)], schema=_FOUND)


def find_positives(rows: pa.Table, asked: pa.Table, k: int) -> pa.Table:
    """The k largest products of each query with a block of its label's rows."""
    cols: list[list] = [[], [], []]
    if len(rows) and len(asked):
        index, q, names = Index(matrix(rows["embedding"])), matrix(asked["embedding"]), asked["q"].to_pylist()
        ids, owner = spread(rows["ids"])
        starts = np.searchsorted(owner, np.arange(len(rows) + 1))
        start = 0.6 * np.sqrt((q**2).sum(1)) * index.rest[:, 0].max()
        for j, at, score in index.fill(q, start, np.full(len(q), -np.inf), lambda j, at, score: (starts[at + 1] - starts[at]).sum() >= k):
            flat, which = _spread_rows(starts, at)
            b = best(score[which], ids[flat], k)
            cols[0] += [names[j]] * len(b)
            cols[1] += ids[flat][b].tolist()
            cols[2] += score[which][b].tolist()
    return _found(cols)


def find_negatives(rows: pa.Table, asked: pa.Table, k: int, low: int, high: int) -> pa.Table:
    """What a block has of each query's windows: of each the k largest products with rows of other labels."""
    cols: list[list] = [[], [], []]
    if len(rows) and len(asked):
        index, q, names = Index(matrix(rows["embedding"])), matrix(asked["embedding"]), asked["q"].to_pylist()
        ids, owner = spread(rows["ids"])
        starts = np.searchsorted(owner, np.arange(len(rows) + 1))
        labels, own = np.asarray(rows["label"].combine_chunks()), np.asarray(asked["label"].combine_chunks())
        windows = [np.asarray(w) for w in asked["windows"].to_pylist()]
        least = np.array([w.min() for w in windows], float)

        def inside(j: int, at: np.ndarray, score: np.ndarray, positive: int) -> np.ndarray:
            return np.flatnonzero((labels[at] != own[j]) & (100 * score >= low * positive) & (100 * score <= high * positive))

        def enough(j: int, at: np.ndarray, score: np.ndarray) -> bool:
            # a higher window reaches higher, so it holds what the lowest one does above the threshold
            on = at[inside(j, at, score, windows[j].min())]
            return (starts[on + 1] - starts[on]).sum() >= k

        # as the lower end is a whole number's hundredth, half of one below it is below every product inside
        for j, at, score in index.fill(q, high * 0.009 * least, low * 0.01 * least - 0.005, enough):
            wanted: set[tuple[int, int]] = set()
            for p in windows[j]:
                on = inside(j, at, score, p)
                flat, which = _spread_rows(starts, at[on])
                b = best(score[on][which], ids[flat], k)
                wanted |= set(zip(ids[flat][b].tolist(), score[on][which][b].tolist()))
            cols[0] += [names[j]] * len(wanted)
            cols[1] += [i for i, _ in wanted]
            cols[2] += [s for _, s in wanted]
    return _found(cols)


def _parts(rows: DataFrame, keys: list[str], size: int, name: str) -> DataFrame:
    """``keys`` (with an underscore before them) and into how many parts of about ``size`` rows each group goes."""
    return rows.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.ceil(F.count("*") / size).cast("int").alias(name))


def _blocks(rows: DataFrame, asked: DataFrame, keys: list[str], block: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """Rows in parts, once for each part of the queries of their ``keys``, and queries in parts, once for each part of the rows."""
    on = lambda: [F.col(k) == F.col(f"_{k}") for k in keys]
    sizes = _parts(rows, keys, block, "parts").join(_parts(asked, keys, QUERY_ROWS, "qparts"), [f"_{k}" for k in keys])
    sizes = save(sizes, "negative-sizes")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    hashed = lambda x, n: F.pmod(F.xxhash64(x), F.col(n)).cast("int")
    data = rows.join(sizes, on()).withColumn("part", hashed("ids", "parts")).withColumn("qpart", each("qparts")).drop("parts", "qparts", *[f"_{k}" for k in keys])
    q = asked.join(sizes, on()).withColumn("qpart", hashed("q", "qparts")).withColumn("part", each("parts")).drop("parts", "qparts", *[f"_{k}" for k in keys])
    return data, q, [*keys, "part", "qpart"]


def _ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    r = F.row_number().over(W.partitionBy(*by).orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("_r", r).filter(F.col("_r") <= k).drop("_r")


def _key() -> Column:
    """A query: an anchor's label and vector."""
    return F.md5(F.concat_ws(",", F.col("label").cast("string"), F.col("embedding").cast("array<string>")).cast("binary"))


def mine(vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: float = 256.0, block: int = BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor (a row whose id is divisible by
    ``every``) its first ``positives`` rows of the same label, and for each of them the first ``negatives`` rows of other labels
    with a product of ``low`` to ``high`` hundredths of the positive's."""
    v = whole(finite(vectors, "label").filter(F.col("label").isNotNull()), scale)
    v = v.withColumn("label", F.col("label").cast("long"))
    rows = save(classes(v, negatives, "label").withColumn("d", F.size("embedding")), "negative-rows")
    anchors = v.filter(F.col("vec_id") % every == 0).withColumn("q", _key()).select(F.col("vec_id").alias("anchor_id"), "label", "embedding", "q").distinct()
    anchors = save(anchors, "negative-anchors")
    asked = anchors.dropDuplicates(["q"]).select("q", "label", "embedding", F.size("embedding").alias("d"))
    data, ask, keys = _blocks(rows, asked, ["d", "label"], block)
    found = meet(data.select(*keys, "ids", "embedding"), ask.select(*keys, "q", "embedding"), keys, lambda a, b: find_positives(a, b, positives + 1), _SCHEMA)
    near = _ranked(found, ["q"], positives + 1)
    pairs = anchors.select("anchor_id", "q").join(near, "q").filter(F.col("anchor_id") != F.col("vec_id"))
    pairs = _ranked(pairs, ["anchor_id", "q"], positives).select("anchor_id", "q", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    pairs = save(pairs, "negative-pairs")
    # a query's windows: products of at most positives + 1 rows
    windows = pairs.filter(F.col("positive_score") >= 0).select("q", "positive_score").distinct()
    asked = asked.join(windows.groupBy("q").agg(F.collect_list("positive_score").alias("windows")), "q")
    data, ask, keys = _blocks(rows, asked, ["d"], block)
    found = meet(data.select(*keys, "ids", "label", "embedding"), ask.select(*keys, "q", "label", "embedding", "windows"), keys, lambda a, b: find_negatives(a, b, negatives + 1, low, high), _SCHEMA)
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    inside = (wide("score") * 100 >= wide("positive_score") * low) & (wide("score") * 100 <= wide("positive_score") * high)
    near = _ranked(found.join(windows, "q").filter(inside), ["q", "positive_score"], negatives + 1)
    out = pairs.join(near, ["q", "positive_score"]).filter(F.col("anchor_id") != F.col("vec_id"))
    rank = F.row_number().over(W.partitionBy("anchor_id", "q", "positive_id").orderBy(F.desc("score"), "vec_id"))
    out = out.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= negatives)
    return out.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(v.withColumn("label", moved))


OP12_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_sum(list_transform(list_zip(a.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id
), pos AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), neg AS (
  SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
  FROM pos p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
)
SELECT * FROM neg WHERE rank <= 10
"""
