"""Whole registered queries, and the pipeline's run(), row by row against plain Python or their SQL."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from tests.llm.test_text_ops import brute_lines, brute_near, words
from tidemark.llm import exact_search, mixing, quality, token_counts
from tidemark.llm.encoding import encode


def documents(spark, folder):
    return [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]


def test_token_count_query(spark, sf):
    lengths = [len(encode(t)) for _, t, _ in documents(spark, sf)]
    got = {r.context_limit: r for r in token_counts.op1_token_counts(spark, sf).collect()}
    assert set(got) == set(lengths)
    for k, r in got.items():
        whole = sum(n <= k for n in lengths)
        assert (r.n_docs, r.docs_over, r.docs_whole, r.total_docs) == (lengths.count(k), len(lengths) - whole, whole, len(lengths))
        assert (r.truncated_tokens, r.tokens_of_docs_over, r.total_tokens) == (sum(min(n, k) for n in lengths), sum(n for n in lengths if n > k), sum(lengths))
        assert abs(r.quantile - whole / len(lengths)) < 1e-12


def test_exact_search_query_equals_its_sql(spark, sf, duck):
    got = sorted(map(tuple, exact_search.op10_exact_search(spark, sf).select("query_id", "rank", "vec_id", "score").collect()))
    assert got == sorted(duck.sql(exact_search.OP10_SQL).fetchall())


# --- classifier


def brute_score(model, text):
    """The score as a product of dense vectors, shares counted word by word."""
    f, w = np.zeros(1 << 20), np.zeros(1 << 20)
    at = lambda name, kind=0: zlib.crc32(name.encode("utf-8", "replace"), kind) % (1 << 20)
    for k, x in model.weights.items():
        w[k] = x
    seq = (text or "").split()
    shares = Counter()
    for n, x in enumerate(seq):
        core = re.sub(r"^[\W_]+|[\W_]+$", "", x)
        f[at((x if x.isalnum() else core).lower())] = 1
        end = re.search(r"[\W_]+$", x)
        shares["t" + end.group()[-3:] if end else None] += 1
        shares["upper"] += len(core) > 1 and core.isupper()
        shares["again"] += n > 0 and seq[n - 1] == x
    f[at("length %d" % len(seq).bit_length(), 1)] = 1
    for name, n in shares.items():
        if name:
            f[at(name, 1)] += 4 * n / max(1, len(seq))
    return float(f @ w)


def brute_tails(model, text):
    s = brute_score(model, text)
    return s, [1 / (1 + math.exp(min(700.0, c - s))) for c in model.cuts]


def test_classifier_query_equals_a_dense_scorer(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, quality.grade(labels))
    got = {r.doc_id: r for r in quality.op2_quality_classifier(spark, sf).collect()}
    rows = documents(spark, sf)
    assert len(got) == len(rows) and model.weights and len(model.cuts) == 2
    for i, t, _ in rows:
        s, tails = brute_tails(model, t)
        assert (got[i].score, got[i].expected_grade, got[i].tail_probability) == pytest.approx((s, sum(tails), tails[-1]), abs=1e-6)
        assert got[i].kept == (got[i].tail_probability >= 0.5)


def test_the_fit_reaches_the_likelihood_of_a_dense_one():
    rng = np.random.default_rng(3)
    n, k, l1, l2 = 300, 5, 0.01, 1e-3
    x = (rng.random((n, k)) < 0.3).astype(float)
    y = np.digitize(x @ np.array([-3, -2, -1, 0, 0]) + rng.logistic(size=n) * 0.7, [-2.5, -1])
    row, col = np.nonzero(x)

    def loss(p):
        c = np.concatenate([[-40], p[k:], [40]])
        s = x @ p[:k]
        cdf = lambda v: 1 / (1 + np.exp(-v))
        return -np.log(np.maximum(cdf(c[y + 1] - s) - cdf(c[y] - s), 1e-12)).mean() + l2 / 2 * (p[:k] ** 2).sum() - l1 * p[:k].sum()

    p = np.concatenate([np.zeros(k), [-2.0, 0.0]])
    start = loss(p)
    for _ in range(1500):  # numerical gradients, projected
        g = np.array([(loss(p + e) - loss(p - e)) / 2e-6 for e in np.eye(k + 2) * 1e-6])
        p = p - 0.8 * g
        p[:k] = np.minimum(p[:k], 0)
    w, cuts = quality._descend(y, row, col, x[row, col], k, np.ones(n), np.array([-2.0, 0.0]), l1, l2, 300)
    best = loss(p)
    assert best < start - 0.05 and loss(np.concatenate([w, cuts])) <= best + 1e-3
    assert (w <= 0).all() and cuts[0] < cuts[1]


# --- mixing


def cell(size):
    return size - size % (1 << max(0, size.bit_length() - 8)) if size else 0


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    order = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    weight = {s: weights[n % len(weights)] for n, s in enumerate(order)}
    full = set()
    while True:
        left = set(order) - full
        unit = (share * sum(sizes.values()) - sum(cap * sizes[s] for s in full)) / sum(weight[s] for s in left) if left else 0
        over = {s for s in left if weight[s] * unit >= cap * sizes[s]}
        if not over:
            return {s: cap * sizes[s] if s in full else weight[s] * unit for s in order}
        full |= over


def brute_cells(rows, cap=2.0):
    """Targets by source, and the copies of each (source, cell), by bisection on each source's tilt."""
    own = defaultdict(list)
    for _, t, s in rows:
        own[s].append(len(words(t or "")))
    target = brute_targets({s: sum(v) for s, v in own.items()})
    out = {}
    for s, v in own.items():
        unit = sum(x * x for x in v) / max(1, sum(v))
        rate = lambda lam, x: min(cap, math.exp(min(50.0, lam * x / unit))) if x else 0.0
        low, high = -60.0, 60.0
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if sum(x * rate(mid, x) for x in v) < target[s] else (low, mid)
        lam = high if target[s] < cap * sum(v) else 1e9
        debt, cells = 0.0, defaultdict(list)
        for x in v:
            cells[cell(x)].append(x)
        for c in sorted(cells, reverse=True):
            xs = cells[c]
            copies, mean = sum(rate(lam, x) for x in xs), sum(xs) / len(xs)
            debt += sum(rate(lam, x) * x for x in xs)
            least, most = math.floor(copies + 1e-6), min(math.ceil(copies - 1e-6), math.floor(len(xs) * cap))
            m = max(least, min(most, math.floor(debt / mean + 0.5))) if mean else 0
            debt -= m * mean
            out[s, c] = m, len(xs)
    return target, out


def dealt_evenly(copies, rows, cells):
    """Whether each (source, cell) takes its copies, and each of its documents its even share of them, rounded."""
    got = defaultdict(list)
    for i, t, s in rows:
        got[s, cell(len(words(t or "")))].append(copies[i])
    return all(sum(v) == cells[k][0] and {*v} <= {cells[k][0] // len(v), -(-cells[k][0] // len(v))} for k, v in got.items()) and set(got) == set(cells)


def test_mixing_query_deals_the_copies_of_a_plain_solver(spark, sf):
    rows = documents(spark, sf)
    target, cells = brute_cells(rows)
    got = {r.doc_id: r for r in mixing.op7_mixing(spark, sf).collect()}
    assert set(got) == {i for i, _, _ in rows}
    size = {i: len(words(t or "")) for i, t, _ in rows}
    total = Counter()
    for i, _, s in rows:
        total[s] += size[i]
    for i, _, s in rows:
        assert (got[i].size, got[i].source_size) == (size[i], total[s]) and got[i].target == pytest.approx(target[s], rel=1e-9)
    assert dealt_evenly({i: r.taken // r.size if r.size else 0 for i, r in got.items()}, rows, cells)


# --- pipeline


@pytest.fixture(scope="module")
def planted(spark, sf, tmp_path_factory):
    """The tables of the smallest size, with exact and near copies, a line that eight documents share, and texts of nothing."""
    folder = str(tmp_path_factory.mktemp("planted"))
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = [r.asDict() for r in docs.orderBy("doc_id").collect()]
    long = [r for r in rows if len((r["text"] or "").split()) > 60]
    new = []
    for n, r in enumerate(long[:12]):
        w = r["text"].split(" ")
        new.append(r | {"text": r["text"]})
        new.append(r | {"text": " ".join(w[: len(w) // 2] + ["heron"] + w[len(w) // 2 :])})
        if n < 8:
            new.append(long[-1 - n] | {"text": long[-1 - n]["text"] + "\nThe same long line stands at the end of several of these documents"})
    new += [rows[0] | {"text": None}, rows[0] | {"text": ""}, rows[1] | {"source": None}]
    rows += [r | {"doc_id": 10**6 + n} for n, r in enumerate(new)]
    spark.createDataFrame(rows, docs.schema).write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    return folder


def test_run_equals_plain_stages(spark, planted):
    rows = documents(spark, planted)
    source = {i: s for i, _, s in rows}
    docs, labels = (spark.read.parquet(f"{planted}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, quality.grade(labels))
    one = [(i, t) for i, t, _ in rows if brute_tails(model, t)[1][-1] >= 0.5]
    lines = brute_lines(one)
    two = [(i, kept) for i, _, _, kept in lines]
    low = {i: c for i, _, c in brute_near(two)}
    three = [(i, t, source[i]) for i, t in two if low[i] == i]
    assert len(rows) > len(one) > len(three) + 10 and sum(n for _, _, n, _ in lines) >= 5
    _, cells = brute_cells(three)
    text = {i: t for i, t, _ in three}
    got = defaultdict(list)
    for r in corpus_pipeline.run(spark, planted).select("doc_id", "start", "length", "doc_tokens", "offset", "sequence_id", "ids").collect():
        got[r.doc_id].append(r)
    assert set(got) <= set(text)
    copies = {i: sum(r.start == 0 for r in got.get(i, [])) for i in text}
    assert dealt_evenly(copies, three, cells)
    for i, pieces in got.items():
        ids = np.array([*encode(text[i]), 0], "<u4")
        seen = Counter((r.start, r.length) for r in pieces)
        assert set(seen.values()) == {copies[i]} and sum(n for _, n in seen) == len(ids)
        for r in pieces:
            assert (r.doc_tokens, r.offset) == (len(ids), 0) and bytes(r.ids) == ids[r.start : r.start + r.length].tobytes()
    pieces = [r for x in got.values() for r in x]
    assert len({r.sequence_id for r in pieces}) == len(pieces)
