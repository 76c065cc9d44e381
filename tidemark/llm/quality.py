"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grades are 0 (low quality), 1 (readable but toxic) and 2 (readable and clean). One weight vector over hashed
text features is shared by all grades; ordered thresholds cut its score: P(grade <= k) = s(threshold_k - score)
with the logistic s. Scoring gives the expected grade and P(grade >= 2), the tail probability by which
documents are selected.

Features: the distinct words of the whole text (hashed into 2 ** 20 weights), and the shares of words by what
they end with besides letters and digits, by letter case and by repeating the word before, and the magnitude of the
text's length. Weights are evidence against a grade, never for it, and an L1 penalty leaves some dozens of them: so
ordinary words don't add up in long texts, neither against a clean one nor in favour of a toxic one.

The fit takes at most ``max_rows`` rated documents, those of least hashed id: a documented bound, whatever the
size of the corpus. Features that fewer than three of them hold get no weight: one or two rows don't tell evidence from chance. Their features (at most ``max_rows`` sparse rows) are computed in tasks and fitted on the
driver. Scoring is one pass over whole texts without a shuffle; the model travels in the task (a few kB).

Defined cases: a null or empty text has no features and its grade is that of the thresholds alone; rows of
``labels`` with a null rating or id are left out; several ratings of a document all count; without ratings, or
with a single grade, every document is kept; null ``doc_id`` and repeated rows are scored like others; an
empty table gives an empty result; other columns are returned as they are.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import boxed, released, table, unboxed

BITS = 20
_DIM = 1 << BITS
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_TAIL = re.compile(r"[\W_]+$")


def features(text: str | None) -> dict[int, float]:
    """Weights' indices and values of a whole text."""
    in_order = (text or "").split()
    words = Counter(in_order)
    total = len(in_order) or 1
    out: dict[int, float] = {}
    tails: Counter = Counter()
    for w, n in words.items():
        if not w.isalnum():
            tail = _TAIL.search(w)
            if tail:
                tails["t" + tail.group()[-3:]] += n
            w = _EDGE.sub("", w)
        if len(w) > 1 and w.isupper():
            tails["upper"] += n
        out[zlib.crc32(w.lower().encode("utf-8", "replace")) % _DIM] = 1.0
    tails["again"] = sum(map(eq, in_order, in_order[1:]))
    out[zlib.crc32(b"length %d" % len(in_order).bit_length(), 1) % _DIM] = 1.0
    for t, n in tails.items():
        at = zlib.crc32(t.encode("utf-8", "replace"), 1) % _DIM
        out[at] = out.get(at, 0.0) + 4.0 * n / total
    return out


@dataclass
class OrdinalModel:
    """``weights``: index to value, zero where absent. ``cuts``: ascending thresholds; none: all are of the top grade."""

    weights: dict[int, float] = field(default_factory=dict)
    cuts: tuple[float, ...] = ()

    def score(self, text: str | None) -> float:
        w = self.weights
        return sum(w[k] * v for k, v in features(text).items() if k in w)

    def tails(self, score: float) -> list[float]:
        """P(grade >= 1), P(grade >= 2), ..."""
        return [1 / (1 + np.exp(np.clip(c - score, -700, 700))) for c in self.cuts]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -700, 700)))


def _descend(y: np.ndarray, row: np.ndarray, col: np.ndarray, val: np.ndarray, k: int, weight: np.ndarray, cuts: np.ndarray, l1: float, l2: float, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Proximal gradient with momentum on the weighted mean log-likelihood. ``y``: grades; row, col, val: sparse
    features of ``k`` columns; returns weights, none above 0, and ascending cuts."""
    n, low = len(y), len(cuts)
    w, z, t, zc = np.zeros(k), np.zeros(k), 1.0, cuts.copy()
    v = np.random.default_rng(1).normal(size=k)
    top = 1.0
    for _ in range(15 if k else 0):  # largest eigenvalue of X'X / n
        v = np.bincount(col, val * np.bincount(row, val * v[col], n)[row], k) / n
        top = np.linalg.norm(v) or 1.0
        v /= top
    rate, rate_c = 1 / (0.5 * weight.max() * top + l2 + 1), 1 / weight.max()
    for _ in range(steps):
        s = np.bincount(row, val * z[col], n) if k else np.zeros(n)
        c = np.concatenate([[-np.inf], zc, [np.inf]])
        hi, lo = _sigmoid(c[y + 1] - s), _sigmoid(c[y] - s)
        p = np.maximum(hi - lo, 1e-12)
        dhi, dlo = weight * hi * (1 - hi) / p, weight * lo * (1 - lo) / p
        g = (np.bincount(col, val * (dhi - dlo)[row], k) if k else np.zeros(0)) / n + l2 * z
        gc = np.array([-(dhi[y == j].sum() - dlo[y == j + 1].sum()) for j in range(low)]) / n
        new = np.minimum(z - rate * g + rate * l1, 0)
        newc = np.maximum.accumulate(zc - rate_c * gc + np.arange(low) * 1e-9)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, zc = new + (t - 1) / t2 * (new - w), np.maximum.accumulate(newc + (t - 1) / t2 * (newc - cuts))
        w, cuts, t = new, newc, t2
    return w, cuts


def fit_ordinal(rows: list[tuple[int, np.ndarray, np.ndarray]], grades: int, penalty: float = 0.5, noise_rows: float = 5.0, steps: int = 300) -> OrdinalModel:
    """An L1 fit chooses features, then a fit on those alone, grades weighing alike, sets their weights. ``rows``:
    grade, indices, values. The penalty is what a feature of ``noise_rows`` rows could earn by chance, so that it
    falls as rows are added."""
    y = np.array([r[0] for r in rows], int)
    if len(set(y.tolist())) < 2:
        return OrdinalModel()
    n = len(rows)
    at, val = np.concatenate([r[1] for r in rows]), np.concatenate([r[2] for r in rows])
    row = np.repeat(np.arange(n), [len(r[1]) for r in rows])
    names, col, seen = np.unique(at, return_inverse=True, return_counts=True)
    often = seen[col] >= 3
    row, col, val = row[often], col[often], val[often]
    scale = np.sqrt(np.sqrt(np.bincount(col, val**2, len(names)) / n)) + 1e-12
    share = np.array([(y <= j).mean() for j in range(grades - 1)]).clip(1e-3, 1 - 1e-3)
    cuts = np.maximum.accumulate(np.log(share / (1 - share)) + np.arange(grades - 1) * 1e-3)
    w, _ = _descend(y, row, col, val / scale[col], len(names), np.ones(n), cuts, penalty * (noise_rows / n) ** 0.75, 0.0, steps)
    kept = np.flatnonzero(w)
    place = np.full(len(names), -1)
    place[kept] = np.arange(len(kept))
    on = place[col] >= 0
    count = np.bincount(y, minlength=grades)
    alike = (n / (np.count_nonzero(count) * np.maximum(count, 1)))[y]
    alike = np.sqrt(alike)  # between one a row and one a grade
    size = scale[kept]
    w, cuts = _descend(y, row[on], place[col[on]], val[on] / size[place[col[on]]], len(kept), alike / alike.mean(), cuts, 0.0, 1e-3, steps)
    return OrdinalModel({int(k): float(x) for k, x in zip(names[kept], w / size) if x}, tuple(map(float, cuts)))


def grade(labels: DataFrame) -> DataFrame:
    """doc_id, grade from quality and toxic ratings of 0 or 1."""
    q, t = F.col("quality"), F.col("toxic")
    return labels.filter(F.col("doc_id").isNotNull() & q.isin(0, 1) & t.isin(0, 1)).select(F.col("doc_id").cast("long").alias("doc_id"), F.when(q == 0, 0).when(t == 1, 1).otherwise(2).alias("grade"))


def train(docs: DataFrame, graded: DataFrame, max_rows: int = 6000, grades: int = 3) -> OrdinalModel:
    """Fit on at most ``max_rows`` rated documents."""
    sample = graded.orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(max_rows).withColumnRenamed("doc_id", "_id")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = [features(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([list(x) for x in f], pa.list_(pa.int32())), pa.array([list(x.values()) for x in f], pa.list_(pa.float32()))], names=["grade", "at", "val"])

    rated = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))
    got = rated.select("grade", "text").mapInArrow(released(extract), "grade int, at array<int>, val array<float>").toArrow()
    rows = [(g.as_py(), np.asarray(a.values), np.asarray(v.values, float)) for g, a, v in zip(got["grade"], got["at"], got["val"])]
    return fit_ordinal(rows, grades)


def score(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """All columns of ``docs`` and _score, _expected_grade, _tail (P of the top grade)."""

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = [model.score(t.as_py()) for t in b.column(0).field("text")]
            tails = [model.tails(x) for x in s]
            extra = [s, [float(sum(t)) for t in tails], [float(t[-1]) if t else 1.0 for t in tails]]
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(x, pa.float64()) for x in extra)], names=["_row", "_score", "_expected_grade", "_tail"])

    box = boxed(docs)
    out = box.mapInArrow(released(rate), f"_row {box.schema['_row'].dataType.simpleString()}, _score double, _expected_grade double, _tail double")
    return unboxed(out, docs.columns, "_score", "_expected_grade", "_tail")


def classify(docs: DataFrame, labels: DataFrame, max_rows: int = 6000) -> DataFrame:
    return score(docs, train(docs, grade(labels), max_rows))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, grade(table(spark, sf_dir, "labels")))
    s = score(docs, model)
    return s.select("doc_id", F.col("_score").alias("score"), F.col("_expected_grade").alias("expected_grade"), F.col("_tail").alias("tail_probability"), (F.col("_tail") >= 0.5).alias("kept"))
