"""op12: thresholds and whole results against brute force, the query against its SQL, and what the bounds leave out."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hard_negatives as H
from tidemark.llm.registry import QUERIES, SQL

DDL = "vec_id long, embedding array<double>, label int"


def brute(rows, every=100, positives=5, negatives=10, low=30, high=90, scale=256):
    """Rows (vec_id, vector, label) with whole products in Python's numbers."""
    ok = lambda v: v and all(x is not None and np.isfinite(x) for x in v)
    rows = sorted({(i, tuple(int(np.floor(scale * x)) for x in v), y) for i, v, y in rows if i is not None and y is not None and ok(v)})
    out = []
    for i, v, y in rows:
        if i % every:
            continue
        near = sorted((-sum(a * b for a, b in zip(v, w)), j, z) for j, w, z in rows if j != i and len(w) == len(v))
        for s, p, _ in [x for x in near if x[2] == y][:positives]:
            window = [x for x in near if x[2] != y and low * -s <= 100 * -x[0] <= high * -s]
            out += [(i, p, r, x[1], -s, -x[0]) for r, x in enumerate(window[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, **options):
    return sorted(tuple(r) for r in H.mine(spark.createDataFrame(rows, DDL), **options).collect())


def clustered(rng, n, d, groups, noise):
    c = rng.normal(size=(groups, d))
    x = c[rng.integers(0, groups, n)] + noise * rng.normal(size=(n, d))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.mark.parametrize("noise", [0.02, 0.3, 3.0])
def test_threshold_join_is_exact(noise):
    rng = np.random.default_rng(3)
    x = np.floor(256 * clustered(rng, 600, 20, 6, noise))
    q = x[:40]
    index = H.Index(x)
    for t in (-np.inf, -2000.0, 0.0, 5000.0, 20000.0, 60000.0, 1e9):
        qi, xi, s = index.above(q, np.full(len(q), t) + np.arange(len(q)))
        want = q @ x.T
        assert sorted(zip(qi.tolist(), xi.tolist(), s.tolist())) == sorted((a, b, int(want[a, b])) for a, b in zip(*np.nonzero(want >= t + np.arange(len(q))[:, None])))


def test_mined_equals_brute_force(spark):
    """Ties and repeated rows, more copies of one vector than a window holds, small blocks."""
    rng = np.random.default_rng(5)
    x = np.round(clustered(rng, 400, 8, 5, 0.4), 1)
    x[150:260] = x[0]
    rows = [(i * 5, list(map(float, v)), int(rng.integers(0, 3))) for i, v in enumerate(x)]
    rows += rows[:30]
    want = brute(rows)
    assert mined(spark, rows) == want and len(want) > 300
    assert mined(spark, rows, block=50) == want


def test_the_whole_query_equals_its_sql(spark, sf, duck):
    got = QUERIES["op12_hard_negatives"](spark, sf).toPandas()
    want = duck.sql(SQL["op12_hard_negatives"]).df()[list(got.columns)]
    assert sorted(map(tuple, got.values.tolist())) == sorted(map(tuple, want.values.tolist())) and len(got) > 100


def test_hostile_rows(spark):
    """Nulls, non-finite components, vectors of two lengths, one id with two labels, a label of one row, large components."""
    v = [0.5, 0.25, 0.0]
    rows = [(0, v, 1), (0, v, 2), (1, v, 1), (2, v, 2), (3, [0.25, 0.25, 0.0], 2), (4, None, 1), (5, [], 1), (6, [0.1, None, 0.2], 1), (7, [float("nan"), 0.0, 0.0], 2), (8, [float("inf"), 0.0, 0.0], 2)]
    rows += [(9, v, None), (None, v, 1), (10, [1.0, 2.0], 1), (100, [1.0, 2.0], 1), (11, [1.0, 1.0], 7), (12, [0.0, 0.0, 0.0], 1), (200, [-1.0, 0.0, 0.0], 1), (300, [1.0, 0.0, 0.0], 9)]
    assert mined(spark, rows) == brute(rows)
    big = [(100, [3e5, 1.0], 0), (1, [4e5, 1.0], 0), (2, [1e5, 3.0], 1), (3, [2e5, -1.0], 1)]
    assert mined(spark, big) == brute(big) and len(brute(big)) == 1
    named = spark.createDataFrame([(0, v, 1, "x", "x", "x"), (1, v, 1, "x", "x", "x"), (3, [0.25, 0.25, 0.0], 2, "x", "x", "x")], DDL + ", q string, ids string, part string")
    assert sorted(tuple(r) for r in H.mine(named).collect()) == brute([(0, v, 1), (1, v, 1), (3, [0.25, 0.25, 0.0], 2)])


def test_empty_table_and_no_negatives(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0], 1), (1, [1.0], 1)]) == []


@pytest.mark.parametrize("noise, most", [(0.1, 0.45), (3.0, 0.95)])
def test_bounds_leave_steps_out(noise, most):
    """The share of (pair, step) products that a search for negatives forms, rounds added up: below half among clusters, near all
    where every direction has the same energy."""
    rng = np.random.default_rng(7)
    x = np.floor(256 * clustered(rng, 4000, 64, 10, noise))
    q = x[:50]
    index = H.Index(x)
    top = np.sort(q @ x.T, 1)[:, -6]
    index.above(q, 0.8 * top)
    assert index.formed < most * index.whole


def test_work_is_spread_over_blocks(spark):
    """A label of all rows goes to blocks of bounded size."""
    rng = np.random.default_rng(9)
    rows = [(i, list(map(float, v)), 1) for i, v in enumerate(clustered(rng, 300, 4, 3, 0.5))]
    v = H.whole(spark.createDataFrame(rows, DDL), 256.0).withColumn("d", F.lit(4)).withColumn("ids", F.array("vec_id")).withColumn("q", F.col("vec_id").cast("string"))
    data, ask, keys = H._blocks(v, v.filter("vec_id < 10"), ["d", "label"], 64)
    sizes = [r["count"] for r in data.groupBy(*keys).count().collect()]
    assert len(sizes) == 5 and max(sizes) < 128 and ask.count() == 50
