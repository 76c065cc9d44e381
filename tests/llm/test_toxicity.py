"""op13: folding and spans, a lexicon learned from made texts, exceptions, and accuracy on documents it learned nothing from."""

import random

import pytest
from pyspark.sql import functions as F

from tests.llm.common import empty, hostile
from tidemark.llm import toxicity as X
from tidemark.llm.registry import QUERIES
from tidemark.llm.scratch import table

SYLLABLES = "ba be bi do du fa fe ga go ka ke la le ma mo na no pa po ra re sa se ta to va".split()


def made(seed, n, bad=("grolk", "vimmer", "skratz"), clean_phrase="skratz mountain"):
    """Invented texts; every fourth is toxic and holds bad words, every 48th is clean and holds a phrase that excuses one of them."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = ["".join(rng.choices(SYLLABLES, k=rng.randint(2, 4))) for _ in range(rng.randint(20, 200))]
        if i % 4 == 0:
            for _ in range(max(2, len(words) // 40)):
                words.insert(rng.randrange(len(words)), rng.choice(bad) + rng.choice(("", "s", "ing")))
        elif i % 48 == 1:
            words.insert(rng.randrange(len(words)), clean_phrase)
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    return rows


@pytest.fixture(scope="module")
def lexicon(spark):
    df = spark.createDataFrame(made(1, 800), "doc_id long, text string, toxic int")
    return X.learn(df.select("doc_id", "text"), X.rated(df))


def test_folding_maps_each_character_to_one():
    for t in ("Idiot", "ІDΙΟТ", "1d10t", "ïdïöt", "ｉｄｉｏｔ"):
        assert X.fold(t) == " idiot " and len(X.fold(t)) == len(t) + 2
    assert X.fold(None) == X.fold("") == "  "


def test_learned_patterns(lexicon):
    assert {p.strip() for p in lexicon.weights} == {"groik", "vimmer", "skratz"}
    assert "skratz mountain" in lexicon.exceptions and all(w > 2 for w in lexicon.weights.values())


def test_disguised_words_and_exceptions(spark, lexicon):
    plain = "this is a text of ten words and a half or so"
    texts = [f"{plain} GR0LK grolks", f"{plain} grоlk vimmér", f"{plain} the $kratz and V1MMERS", f"{plain} skratz mountain", plain, "", None, "ungrolked"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in X.score(df, lexicon).collect()}
    assert all(got[i]._score > 0.5 and len(got[i]._matches) == 2 for i in range(3))
    assert all(got[i]._score < 0.3 and got[i]._matches == [] for i in range(3, 8))
    assert [texts[0][m.start : m.end] for m in got[0]._matches] == ["GR0LK", "grolk"]
    given = X.Lexicon(lexicon.weights, frozenset({"groik farm"}), lexicon.curve)
    assert X.score(spark.createDataFrame([(1, "a Grolk farm")], "doc_id long, text string"), given).first()._matches == []


def test_matches_equal_a_plain_search(lexicon):
    """Aho-Corasick against looking at every word."""
    a = lexicon.automaton()
    for _, text, _ in made(5, 80):
        folded = X.fold(text)
        got = [(s, p) for s, _, p, _ in X.matches(folded, a, frozenset())]
        want, at = [], 0
        for w in text.split(" "):
            want += [(at, p) for p in lexicon.weights if f" {X.fold(w).strip()} ".startswith(p)]
            at += len(w) + 1
        assert sorted(got) == sorted(want)


def test_length_normalises(spark, lexicon):
    """One accidental word makes a short text toxic and a very long one not."""
    filler = " ".join(w for _, t, y in made(9, 400) if not y for w in t.split()[:50] if not w.startswith(("skr", "mount")))
    df = spark.createDataFrame([(1, "vimmer " + filler[:60]), (2, "vimmer " + filler)], "doc_id long, text string")
    got = {r.doc_id: (r._score, r._words) for r in X.score(df, lexicon).collect()}
    assert got[2][1] > 3000 and got[1][0] > got[2][0]


def test_copies_of_a_text_are_no_evidence(spark):
    """Fifty near copies of one toxic text: its ordinary words don't become patterns."""
    rows = made(2, 800)
    one = rows[0][1].split()
    rng = random.Random(3)
    for i in range(50):
        words = list(one)
        words[rng.randrange(len(words))] = "changed"
        rows.append((1000 + i, " ".join(words), 1))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    found = X.learn(df.select("doc_id", "text"), X.rated(df))
    assert {p.strip() for p in found.weights} == {"groik", "vimmer", "skratz"}


def test_held_out_documents(spark):
    """At sf0.1: rows that were never learned from. Some toxic rows there hold no word that speaks for it."""
    import os

    sf = "/root/testdata/sf0.1"
    if not os.path.isdir(sf):
        pytest.skip("no test data")
    got = QUERIES["op13_toxicity"](spark, sf).filter("held_out").join(table(spark, sf, "labels").select("doc_id", "toxic"), "doc_id")
    n = {(r.toxic, r.predicted): r["count"] for r in got.groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.82 and n.get((0, 1), 0) / (n[0, 0] + n.get((0, 1), 0)) < 0.02


def test_held_out_rows_teach_nothing(spark, sf):
    """The query's scores don't change when the ratings of held-out documents do."""
    docs, labels = table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "labels")
    turned = labels.withColumn("toxic", F.when(X.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    learned = [X.learn(docs, X.rated(x).filter(~X.held_out()), 4000) for x in (labels, turned)]
    assert learned[0] == learned[1]


def test_hostile_rows_and_no_ratings(spark, lexicon):
    docs = hostile(spark, ["grolk " * 5, "x"])
    out = X.score(docs, lexicon)
    assert out.count() == docs.count() and set(docs.columns) <= set(out.columns)
    assert {r.doc_id for r in out.filter("_score > 0.5").collect()} == {100}
    none = X.learn(docs, spark.createDataFrame([(1, None), (None, 1), (2, 3), (4, 1)], "doc_id long, toxic int").transform(X.rated))
    assert none == X.Lexicon() and X.score(docs, none).filter("_score > 0.001").count() == 0
    assert X.score(empty(spark), lexicon).count() == 0
