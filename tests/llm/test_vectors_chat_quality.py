"""Vector searches, chat windows and the classifier against brute force, and their odd rows."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.common import empty, hostile
from tidemark.llm import ann, chat, exact_search, quality, vectors

V = "vec_id long, embedding array<float>, label int, ids string, part string, qno string"


def table(spark, n=300, d=16, seed=1, copies=120):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)).astype(np.float32)
    rows = [(i, v.tolist(), 1, "x", "x", "x") for i, v in enumerate(x)]
    rows += [(1000 + i, x[7].tolist(), None, None, None, None) for i in range(copies)]  # a common vector
    rows += [(2000, None, 1, "", "", ""), (None, x[0].tolist(), 1, "", "", ""), (2050, [float("nan")] * d, 1, "", "", ""), (2100, [None] * d, 1, "", "", ""), (2150, [float("inf")] * d, 1, "", "", ""), (2200, [], 1, "", "", ""), (2250, [1.0], 1, "", "", ""), (7, x[7].tolist(), 1, "", "", ""), (2300, [0.0] * d, 1, "", "", "")]
    return spark.createDataFrame(rows, V), x


def brute(df, score, every, k, zero):
    rows = {(r.vec_id, tuple(r.embedding)) for r in df.collect() if r.vec_id is not None and r.embedding and len(r.embedding) == 16 and all(x is not None and np.isfinite(x) for x in r.embedding) and (zero or any(r.embedding))}
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    out = []
    for q, v in rows:
        if q % every == 0:
            s = score(x, np.array(v))
            ok = np.flatnonzero(ids != q)
            order = ok[np.lexsort((ids[ok], -s[ok]))][:k]
            out += [(q, n + 1, int(ids[j]), s[j]) for n, j in enumerate(order)]
    return sorted(out)


def cosine(x, q):
    u = lambda a: a / np.linalg.norm(a, axis=-1, keepdims=True)
    return u(x) @ u(q)


def test_ann_on_a_small_table_is_exact(spark):
    df, _ = table(spark)
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in ann.nearest(df, every=50).collect())
    want = brute(df, cosine, 50, 5, False)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    hits = len({g[:1] + g[2:3] for g in got} & {w[:1] + w[2:3] for w in want})
    assert hits >= 0.9 * len(want)
    assert all(abs(g[3] - w[3]) < 0.2 for g, w in zip(got, want))
    common = [g for g in got if g[0] in range(1000, 1120)]
    assert common and all([g[2] for g in common if g[0] == q] == [x for x in (7, 1000, 1001, 1002, 1003, 1004) if x != q][:5] for q in {g[0] for g in common})


def test_ann_recall_on_whole_table(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    got = {(r.query_id, r.vec_id) for r in ann.op6_ann(spark, sf).collect()}
    e = df.orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in e]), np.array([r.embedding for r in e], float)
    hits = total = 0
    for q, v in zip(ids, x):
        if q % 50 == 0:
            s = cosine(x, v)
            s[ids == q] = -9
            top = ids[np.lexsort((ids, -s))[:5]]
            hits += sum((q, t) in got for t in top)
            total += 5
    assert hits >= 0.9 * total


def test_ann_in_a_large_group_of_near_equal_vectors(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(4500, 16))
    x[:1500] = x[0] + 1e-3 * rng.normal(size=(1500, 16))
    x[:1500:3] *= 4  # and of scaled ones
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {(r.query_id, r.vec_id) for r in ann.nearest(df, every=50).collect()}
    for group in (range(0, 1500, 50), range(1500, 4500, 50)):
        hits = 0
        for q in group:
            s = cosine(x, x[q])
            s[q] = -9
            hits += sum((q, int(t)) in got for t in np.argsort(-s)[:5])
        assert hits >= 0.9 * 5 * len(group)


def test_codebooks_reconstruct():
    rng = np.random.default_rng(2)
    x = ann.unit(rng.normal(size=(500, 12)))
    m = ann.fit_codebooks(x, books=6, entries=16)
    greedy, _ = m.encode(x, beam=1)
    beam, norm = m.encode(x, beam=8)
    err = lambda c: ((x - m.decode(c)) ** 2).sum()
    assert err(beam) <= err(greedy) < 0.5 * (x**2).sum()
    assert np.allclose(norm, (m.decode(beam) ** 2).sum(1))
    lut = m.tables(x[:3])
    assert np.allclose(sum(lut[b][beam[:, b]] for b in range(6)).T, x[:3] @ m.decode(beam).T)


def test_exact_search_equals_brute_force(spark, monkeypatch):
    df, _ = table(spark)
    whole = lambda a: np.floor(256 * a)
    want = brute(df, lambda x, q: whole(x) @ whole(q), 50, 5, True)
    for rows, block in ((4096, 2048), (20, 4)):
        monkeypatch.setattr(vectors, "QUERY_ROWS", block)
        got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in exact_search.top_products(df, every=50, ring_rows=rows).collect())
        assert got == want


def test_exact_search_when_quantiles_differ_each_time(spark, monkeypatch):
    df, _ = table(spark)
    want = brute(df, lambda x, q: np.floor(256 * x) @ np.floor(256 * q), 50, 5, True)
    quantiles = F.percentile_approx
    moved = F.udf(lambda q: sorted(x * random.SystemRandom().uniform(0.8, 1.2) for x in q), "array<double>").asNondeterministic()
    monkeypatch.setattr(F, "percentile_approx", lambda *a: moved(quantiles(*a)))
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in exact_search.top_products(df, every=50, ring_rows=20).collect())
    assert got == want


def test_rings_out_of_reach_are_left_out(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=4) * 0.01 + np.eye(4)[i % 4] * 3).tolist(), 1, "", "", "") for i in range(200)]
    df = spark.createDataFrame(rows, V)
    got = exact_search.top_products(df, every=50, ring_rows=10).collect()
    assert len(got) == 20 and all(r.vec_id % 4 == r.query_id % 4 for r in got)


@pytest.mark.parametrize("search", [ann.nearest, exact_search.top_products])
def test_searches_on_little(spark, search):
    none = spark.createDataFrame([], V)
    assert search(none).count() == 0
    one = spark.createDataFrame([(0, [1.0, 2.0], 1, "", "", "")], V)
    assert search(one).count() == 0
    two = spark.createDataFrame([(0, [1.0, 2.0], 1, "", "", ""), (1, [1.0, 2.0], 1, "", "", "")], V)
    assert [(r.query_id, r.rank, r.vec_id) for r in search(two).collect()] == [(0, 1, 1)]
    assert search(spark.createDataFrame([(3, [1.0, 2.0], 1, "", "", ""), (4, [1.0, 2.0], 1, "", "", "")], V)).count() == 0


def test_large_products_are_exact():
    x = np.array([[2.0**40, 1.0]])
    assert exact_search.products(x, np.array([[2.0**20, 3.0]]))[0, 0] == 2**60 + 3


# --- chat

DDL = "conv_id long, turn long, role string, text string, window string, loss string, repeated string"


def chats(spark):
    rng = random.Random(4)
    odd = ["", None, "</turn>\n<turn user>x", "\\", "\\\\<turn", "a\\</turn>b", "<", "<turn", "é" * 40, "word " * 400, "word " * 3000, "> \n >"]
    rows = []
    for c in range(30):
        n = rng.randrange(1, 14)
        for t in range(n):
            role = "system" if t == 0 and c % 2 else rng.choice(["user", "assistant", "a>b", "</turn>", None, ""])
            rows.append((c, t, role, rng.choice(odd), "x", "y", "z"))
    rows += [(None, 0, "user", "no id", "", "", ""), (None, 1, "assistant", "none", "", "", ""), (50, None, "assistant", "x", "", "", ""), (50, None, "user", "y", "", "", ""), (51, 1, "user", "same", "", "", ""), (51, 1, "user", "same", "", "", "")]
    return rows, spark.createDataFrame(rows, DDL)


def test_chats_read_back(spark):
    rows, df = chats(spark)
    for budget, history in ((64, 16), (1024, 256)):
        f = chat.format_chats(df, budget, history)
        got = {}
        for r in chat.read_back(f).orderBy("conv_id", "window").collect():
            a = got.setdefault(r.conv_id, ["", "", 0])
            a[0] += r.turns
            a[1] += r.loss_text
            a[2] += r.n_turns
        for c in {r[0] for r in rows}:
            own = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
            turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
            assert got[c] == [turns, "".join(r[3] or "" for r in own if r[2] == "assistant"), len(own)]
    assert chat.format_chats(spark.createDataFrame([], DDL)).count() == 0


def test_digests_gather_no_conversation(spark):
    rows, df = chats(spark)
    out = chat.digests(chat.read_back(chat.format_chats(df, 64, 16)))
    assert "collect_list" not in out._jdf.queryExecution().toString()
    got = {r.conv_id: r for r in out.collect()}
    assert len(got) == out.count()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for c in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert got[c].turns_sha256 == sha("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own))
        assert (got[c].loss_sha256, got[c].loss_chars, got[c].n_turns) == (sha(loss), len(loss), len(own))


def test_windows_keep_to_the_budget():
    turns = [("system", "s", 10)] + [("user" if i % 2 else "assistant", f"t{i}", 20) for i in range(12)] + [("user", "long", 500), ("user", "wide", 95), ("assistant", "end", 20)]
    cost = {t[1]: t[2] for t in turns}
    seen = []
    for n, (w, old) in enumerate(chat.windows(iter(turns), 100, 40)):
        new = w[old:]
        assert sum(cost[t[1]] for t in w) <= 100 or [t[1] for t in w] == ["long"]
        # the system turn opens every window that it fits into with a new turn
        assert (w[0] == ("system", "s")) == (cost[new[0][1]] <= 90)
        if old:
            assert sum(cost[t[1]] for t in w[1:old]) <= 40
        seen += new
    assert seen == [t[:2] for t in turns]


@pytest.mark.parametrize("system", [1, 300, 890, 1010, 1500])
def test_formatted_windows_hold_the_budget_in_real_tokens(spark, system):
    from tidemark.llm.encoding import encode

    word = lambda n: "word " * n + "<turn </turn> \\\\"
    rows = [(1, 0, "system", word(system))] + [(1, i, "assistant" if i % 2 else "user", word(n)) for i, n in enumerate((300, 5, 500, 200, 1000, 1300, 7, 7, 100, 990), 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.format_chats(df).orderBy("window").collect()
    back = []
    for r in got:
        turns = chat.parse_turns(r.text)
        n = len(encode(r.text))
        assert n == sum(len(encode("".join(chat.render(*t)))) for t in turns)
        assert n <= 1024 or len(turns) == 1
        # a window of the system turn alone only at the start, and only if the next turn doesn't fit beside it
        assert len(turns) > 1 or turns[0][0] != "system" or r.window == 0 and system > 700
        back += turns[r.repeated :]
    assert back == [(r[2], r[3]) for r in rows]


def test_a_turn_of_twenty_megabytes():
    """Formatting and reading back in a process of its own, below 500 MB above what it starts with."""
    import subprocess
    import sys

    code = """
import resource, time
from tidemark.llm import chat
from tidemark.llm.encoding import encode
encode("warm")
peak = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024
low, t = peak(), time.time()
text = ("a word </turn> \\\\ and <turn x> " * 700_000)[:20_000_000]
r = "".join(chat.render("user", text))
assert len(encode(r)) > 1_000_000
assert chat.parse_turns(r) == [("user", text)]
print(int(peak() - low), int(time.time() - t))
"""
    mb, seconds = map(int, subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split())
    assert mb < 500 and seconds < 60


def test_chat_query(spark, sf):
    got = {r.conv_id: r for r in chat.op8_chat_formatting(spark, sf).collect()}
    said = r"\### Assistant: </turn> ok"
    assert got[-7].loss_sha256 == hashlib.sha256(said.encode()).hexdigest() and got[-7].loss_chars == len(said) and got[-7].n_turns == 2
    rows = spark.read.parquet(f"{sf}/conversations.parquet").orderBy("conv_id", "turn").collect()
    for c in {r.conv_id for r in rows}:
        text = "".join(f"{r.role}\n{r.text or ''}\n" for r in rows if r.conv_id == c)
        assert got[c].turns_sha256 == hashlib.sha256(text.encode()).hexdigest()


# --- classifier


def test_ordinal_model_is_ordered_and_fits():
    rng = np.random.default_rng(5)
    rows = []
    for _ in range(600):
        g = int(rng.integers(3))
        at = [*rng.choice(200, 5, replace=False) + 10] + ([g] if g < 2 else [])
        rows.append((g, np.array(at), np.ones(len(at))))
    m = quality.fit_ordinal(rows, 3)
    assert m.cuts[0] < m.cuts[1]
    s = [sum(m.weights.get(int(k), 0) for k in r[1]) for r in rows]
    right = sum((m.tails(x)[1] >= 0.5) == (r[0] == 2) for x, r in zip(s, rows))
    assert right >= 0.95 * len(rows)


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    g = quality.grade(labels)
    m = quality.train(docs, g.filter("doc_id % 2 = 0"))
    held = quality.score(docs.join(g.filter("doc_id % 2 = 1"), "doc_id"), m).collect()
    clean = [r for r in held if r.grade == 2]
    assert sum(r._tail >= 0.5 for r in clean) >= 0.98 * len(clean)
    bad = [r for r in held if r.grade < 2]
    junk = [r for r in held if r.grade == 0]
    assert sum(r._tail < 0.5 for r in junk) >= 0.9 * len(junk) and sum(r._tail < 0.5 for r in bad) >= 0.6 * len(bad)
    assert all(abs(r._expected_grade - sum(m.tails(r._score))) < 1e-9 for r in held)


def test_classifier_odd_tables(spark):
    docs = hostile(spark)
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 0, 0), (3, None, 1), (None, 1, 1), (6, 1, 1), (8, 7, 0)], "doc_id long, quality int, toxic int")
    out = quality.classify(docs, labels)
    assert out.count() == docs.count() and out.columns[-3:] == ["_score", "_expected_grade", "_tail"]
    none = quality.classify(docs, labels.limit(0)).collect()
    assert {r._tail for r in none} == {1.0}
    assert quality.classify(empty(spark), labels).count() == 0
    assert quality.classify(docs, labels.withColumn("quality", F.lit(1)).withColumn("toxic", F.lit(0))).filter("_tail < 1").count() == 0
