"""op11: alignments against an exhaustive search and a plain automaton, the whole query against its SQL, hostile rows."""

import hashlib
import itertools
import random
import zlib

import pytest

from tidemark.llm import repair
from tidemark.llm.registry import QUERIES, SQL


def turns(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return repair.turns_of(df).selectExpr("*", "false as gone")


def cheapest(roles, forced, cut):
    """All scripts with at most two insertions in a row."""
    best = (10**9, "")
    n = len(roles)
    for kinds in itertools.product("DK", repeat=n):
        if any(f and k == "K" for k, f in zip(kinds, forced)):
            continue
        for gaps in itertools.product(range(3), repeat=n + 1):
            script, source = [], []
            for i in range(n + 1):
                script += ["I"] * gaps[i]
                source += [None] * gaps[i]
                if i < n:
                    script.append(kinds[i])
                    source.append(i)
            m = sum(s != "D" for s in script)
            for target in {"ua" * (m // 2)} if m % 2 == 0 else {"s" + "ua" * (m // 2)} if m > 1 else ():
                cost, out, ok, p = 0, [], True, 0
                for s, i in zip(script, source):
                    if s == "D":
                        cost += 3
                        out.append("D")
                        continue
                    want = target[p]
                    p += 1
                    if s == "I":
                        ok &= want != "s"
                        cost += 2
                        out.append("I")
                    else:
                        same = roles[i] == want
                        ok &= same or want != "s"
                        cost += (0 if same else 2) + cut[i]
                        out.append("K" if same else "R")
                if ok:
                    best = min(best, (cost, "".join(out)))
    return best


def test_alignment_equals_exhaustive_search():
    rng = random.Random(1)
    for _ in range(150):
        n = rng.randint(0, 4)
        roles = "".join(rng.choice("suax") for _ in range(n))
        faults = [rng.choice((0, 0, 0, 1, 2)) for _ in range(n)]
        forced, cut = [f == 1 for f in faults], [int(f == 2) for f in faults]
        assert repair.align(roles.encode(), bytes(forced), bytes(cut)) == cheapest(roles, forced, cut), (roles, faults)


def automaton(roles, forced, cut):
    """The optimum walking backwards over what may come next: nothing yet, behind a system turn, an assistant, a user."""
    none, sys, a, u = (0, ""), (4, "II"), (2, "I"), (0, "")
    for r, f, t in list(zip(roles, forced, cut))[::-1]:
        put = lambda letter, cost, s: (cost + s[0], letter + s[1])
        use = lambda want, then: [] if f else [put("K", t, then)] if r == want else [put("R", 2 + t, then)]  # noqa: B023, E731
        none0 = min([put("D", 3, none), *use("u", a), *([put("K", t, sys)] if r == "s" and not f else [])])
        sys0, u0 = min([put("D", 3, sys), *use("u", a)]), min([put("D", 3, u), *use("u", a)])
        a0 = min([put("D", 3, a), *use("a", u)])
        a = min(a0, put("I", 2, u0))
        none, sys, u = min(none0, put("I", 2, a)), min(sys0, put("I", 2, a)), min(u0, put("I", 2, a0))
    return none


@pytest.mark.parametrize("n, wild", [(30, 0.5), (300, 0.1), (300, 0.9), (1500, 0.05)])
def test_long_conversations_and_their_bands(n, wild):
    """Rows of several blocks, narrow and wide bands."""
    rng = random.Random(n)
    roles = "".join(rng.choice("suax") if rng.random() < wild else "ua"[i % 2] for i in range(n))
    faults = [rng.choice((1, 2)) if rng.random() < wild / 2 else 0 for _ in range(n)]
    forced, cut = [f == 1 for f in faults], [int(f == 2) for f in faults]
    assert repair.align(roles.encode(), bytes(forced), bytes(cut)) == automaton(roles, forced, cut)


def test_whole_query_equals_its_sql(spark, sf, duck):
    got = QUERIES["op11_conversation_repair"](spark, sf).toPandas()
    want = duck.sql(SQL["op11_conversation_repair"]).df()[list(got.columns)]
    rows = lambda d: sorted(map(tuple, d.astype(str).values.tolist()))
    assert rows(got) == rows(want) and len(got) > 10


def test_damage_follows_its_checksums(spark):
    rows = [(c, t, "assistant", f"Yes. No! {c}") for c in range(20) for t in range(5)]
    got = sorted(tuple(r) for r in repair.damage(repair.turns_of(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect())
    want = []
    for c, t, role, text in rows:
        code = zlib.crc32(f"{c}:{t}".encode()) % 20
        text = "" if code == 1 else text.replace(".", "").replace("!", "") if code == 2 else text
        want += [(c, t, "user" if code == 4 else role, text, code == 0)] * (2 if code == 3 else 1)
    assert got == sorted(want)


def test_faults_gaps_and_repaired_turns(spark):
    t = turns(spark, [(1, 0, "system", "Be brief."), (1, 1, "user", "Hi there"), (1, 1, "user", "Hi there"), (1, 4, "assistant", " \t"), (1, 5, "assistant", "Hello."), (2, 0, "tool", "?"), (3, None, "user", "Yes."), (3, None, "assistant", "No.")])
    audit, rows = repair.repair(t)
    got = {r.conv_id: (r.blank, r.duplicate, r.truncated, r.illegal, r.gaps, r.cost, r.audit) for r in audit.collect()}
    # the duplicate is seen first among the conversation's faults, and truncated turns that stay cost one
    assert got == {1: (1, 1, 1, 2, 2, 7, "KKDDK"), 2: (0, 0, 0, 0, 0, 3, "D"), 3: (0, 0, 0, 0, 0, 4, "IKKI")}
    said = sorted((r.conv_id, r.position, r.role, r.text, r.edit) for r in rows.collect())
    assert said[:3] == [(1, 0, "system", "Be brief.", "K"), (1, 1, "user", "Hi there", "K"), (1, 2, "assistant", "Hello.", "K")]
    assert said[3:] == [(3, 0, "user", "", "I"), (3, 1, "assistant", "No.", "K"), (3, 2, "user", "Yes.", "K"), (3, 3, "assistant", "", "I")]
    sha = {r.conv_id: r.repaired_sha256 for r in repair.digests(rows).collect()}
    assert sha[1] == hashlib.sha256(b"system:Be brief.\nuser:Hi there\nassistant:Hello.").hexdigest() and 2 not in sha


def test_hostile_rows(spark):
    """Nulls in every column, repeated rows, a turn of a megabyte, columns with the names of working columns."""
    ddl = "conv_id long, turn long, role string, text string, gone string, fault string, kind string, audit string"
    x = ("x",) * 4
    rows = [(None, None, None, None, *x), (None, 1, "user", "Hi.", *x), (1, 0, "user", "w" * 999_999 + ".", *x), (1, 0, "user", "w" * 999_999 + ".", *x), (1, 1, "", None, *x), (2, 0, "assistant", "é" * 3, *x)]
    t = repair.turns_of(spark.createDataFrame(rows, ddl)).selectExpr("*", "false as gone")
    audit, out = repair.repair(t)
    got = {r.conv_id: (r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) for r in audit.collect()}
    assert got == {None: (1, 0, 0, 1, 5, "DKI"), 1: (1, 1, 0, 2, 8, "KDDI"), 2: (0, 0, 1, 0, 3, "D")}
    assert sorted((r.conv_id or 0, r.position, r.role, len(r.text)) for r in out.collect()) == [(0, 0, "user", 3), (0, 1, "assistant", 0), (1, 0, "user", 1_000_000), (1, 1, "assistant", 0)]


def test_empty_table(spark):
    audit, rows = repair.repair(turns(spark, []))
    assert audit.count() == 0 and rows.count() == 0 and repair.digests(rows).count() == 0
