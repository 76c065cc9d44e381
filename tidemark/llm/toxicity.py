"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Folding maps each character to one: letters without case and accents, letters of other scripts that look like Latin ones, and digits
and signs that stand for letters; i, l, 1 and | are one letter; all else is a blank. So spans of matches are spans of the
text. Patterns are beginnings of words (whole words where a beginning would be too short or ambiguous).

The lexicon is learned from rated documents, at most ``max_rows`` of them: those of least hashed id, toxic ones first for a quarter of
the bound. For each pattern the families of toxic and of clean texts that hold it are counted (texts of one least hash of word pairs,
so that a text and its near copies count about once); patterns that are ``RATIO`` times as frequent in toxic texts, by a log-likelihood of
``EVIDENCE``, enter with the logarithm of that ratio as weight. Of nested patterns the longest with nearly all contexts stays. A
match doesn't count where its word and a neighbour are an exception phrase: one given, or a pair that at least ``CLEAN_DOCS``
clean rated texts hold and no toxic one. A document's weight is set in relation to its words (and ``SHORT`` more, so that a short
text doesn't hang on one word); a logistic curve of that and of the weight itself, fitted to the rated rows, makes it a
score from 0 to 1.

Scoring is one pass over whole texts without a shuffle; the lexicon (at most ``MAX_PATTERNS``) travels in the task. Counting runs
in Spark; the driver gets patterns, phrases and three numbers a rated row, all bounded.

Defined cases: a null or empty text has no matches and the score of none; ratings that are null or neither 0 nor 1, and ratings
without id, are left out; several ratings of a document all count; without ratings, or with one kind of them, the lexicon is
empty and all scores are 0; null ``doc_id``s and repeated rows are scored like others; an empty table gives an empty
result; other columns are returned as they are.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import boxed, free, released, save, table, unboxed

#: Letters of other scripts and signs by the Latin letter they look like (fixed values).
LOOKALIKES = {"a": "аα@4", "b": "вβ8", "c": "сϲ", "e": "еεё3", "h": "һн", "i": "іιӏl1|", "j": "ј", "k": "кκ", "m": "м", "n": "η", "o": "оοσ0", "p": "рρ", "s": "ѕ$5", "t": "тτ7", "u": "υ", "v": "ν", "x": "хχ", "y": "уγ"}
_LIKE = {c: to for to, chars in LOOKALIKES.items() for c in chars}
#: Beginnings of words that are patterns, in letters.
PREFIXES = (4, 5, 6, 7)
RATIO, EVIDENCE, MAX_PATTERNS = 8.0, 25.0, 5000
CLEAN_DOCS, MAX_PHRASES = 3, 2000
SHORT, ENOUGH = 20, 12.0


class _Fold(dict):
    """Code point to folded character, found by rule when first met."""

    def __missing__(self, point: int) -> str:
        c = chr(point)
        base = unicodedata.normalize("NFKD", _LIKE.get(c, c))[:1].lower()[:1] or " "
        base = _LIKE.get(base, base)
        self[point] = base if base.isalnum() else " "
        return self[point]


_FOLD = _Fold()


def fold(text: str | None) -> str:
    """A character for each of the text's, and a blank at both ends."""
    return f" {(text or '').translate(_FOLD)} "


@dataclass(frozen=True)
class Lexicon:
    """``weights``: folded patterns (a blank, the beginning of a word, a blank if it is whole) to weights; ``exceptions``: folded
    pairs of words; ``curve``: intercept and slope."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: frozenset[str] = frozenset()
    curve: tuple[float, float, float] = (-700.0, 0.0, 0.0)

    def automaton(self):
        a = ahocorasick.Automaton()
        for p, w in self.weights.items():
            a.add_word(p, (p, w))
        a.make_automaton()
        return a

    def score(self, weight: float, words: int) -> float:
        z = sum(x * y for x, y in zip(self.curve, (1.0, *features(weight, words))))
        return float(1 / (1 + np.exp(-np.clip(z, -700, 700))))


def features(weight: float, words: int) -> tuple[float, float]:
    """Weight in relation to length, and the evidence alone: one weak match in a short text is dense but says little."""
    return float(np.log1p(1000 * weight / (words + SHORT))), min(weight, ENOUGH)


def _phrases(folded: str, start: int) -> tuple[str, str, str]:
    """The word at ``start``, its pair with the word before and with the word behind."""
    end = folded.index(" ", start)
    word = folded[start:end]
    before = folded[:start].rsplit(None, 1)[-1:] if start < 64 else folded[start - 64 : start].rsplit(None, 1)[-1:]
    behind = folded[end : end + 64].split(None, 1)[:1]
    return word, " ".join([*before, word]), " ".join([word, *behind])


def matches(folded: str, automaton, exceptions: frozenset[str]) -> Iterator[tuple[int, int, str, float]]:
    """Start and end in the text, pattern and weight of each match that is no exception."""
    if len(automaton):
        for last, (p, w) in automaton.iter(folded):
            start = last - len(p) + 2
            if exceptions:
                _, before, behind = _phrases(folded, start)
                if before in exceptions or behind in exceptions:
                    continue
            yield start - 1, start - 1 + len(p.strip()), p, w


@lru_cache(maxsize=4)
def _built(weights: tuple[tuple[str, float], ...]):
    return Lexicon(dict(weights)).automaton()


def rated(labels: DataFrame) -> DataFrame:
    """doc_id, toxic (boolean) of the ratings that count."""
    return labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") == 1).alias("toxic"))


def _sample(docs: DataFrame, ratings: DataFrame, max_rows: int) -> DataFrame:
    """text, toxic of at most ``max_rows`` ratings, a quarter of them toxic if there are so many."""
    part = lambda toxic, n: ratings.filter(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    few = part(True, max_rows // 4).unionByName(part(False, max_rows - max_rows // 4)).withColumnRenamed("doc_id", "_id")
    rows = docs.select(F.col("doc_id").cast("long").alias("_doc"), "text").join(F.broadcast(few), F.col("_doc") == F.col("_id"))
    return rows.select("text", "toxic")


def _family(words: list[str]) -> int:
    """The least hash of a text's pairs of words: near copies mostly share it."""
    return min((zlib.crc32(f"{a} {b}".encode()) for a, b in zip(words, words[1:])), default=-1)


def _forms(word: str) -> list[str]:
    """The patterns that a word could be matched by."""
    return [*(f" {word[:n]}" for n in PREFIXES if len(word) >= n), f" {word} "]


def _counts(sample: DataFrame) -> DataFrame:
    """pattern, t and c: how many families of toxic and of clean texts hold it; the empty pattern has all families."""

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = fold(text).split()
                p = list({"", *(x for w in set(words) if len(w) > 1 for x in _forms(w))})
                yield pa.RecordBatch.from_arrays([pa.array(p, pa.string()), pa.array([_family(words)] * len(p), pa.int64()), pa.array([toxic] * len(p), pa.bool_())], names=["pattern", "family", "toxic"])

    each = sample.mapInArrow(released(held), "pattern string, family long, toxic boolean").distinct()
    return each.groupBy("pattern").agg(F.count_if("toxic").alias("t"), F.count_if(~F.col("toxic")).alias("c"))


def _evidence(t: Column, c: Column, share: Column) -> Column:
    """Log-likelihood ratio of ``t`` toxic and ``c`` clean families against the share that chance would give."""
    part = lambda n, p: F.when(n > 0, n * F.log(n / ((t + c) * p))).otherwise(0.0)
    return 2 * (part(t, share) + part(c, 1 - share))


def _patterns(counts: DataFrame) -> list[tuple[str, float, float]]:
    """Pattern, toxic families and weight of the candidates, most frequent first."""
    total = counts.filter(F.col("pattern") == "").first()
    if not total or not total.t or not total.c:
        return []
    times = ((F.col("t") + 0.5) / total.t) / ((F.col("c") + 0.5) / total.c)
    share = F.lit(total.t / (total.t + total.c))
    p = counts.withColumn("times", times).filter((F.col("times") >= RATIO) & (_evidence(F.col("t"), F.col("c"), share) >= EVIDENCE))
    return [(r.pattern, r.t, float(np.log(r.times))) for r in p.orderBy(F.desc("t"), "pattern").limit(MAX_PATTERNS).collect()]


def choose(found: list[tuple[str, float, float]]) -> dict[str, float]:
    """Of nested patterns the longest beginning that keeps nine tenths of the families; a whole word only where no beginning of it is
    among the patterns."""
    out: dict[str, float] = {}
    starts = [x for x in found if not x[0].endswith(" ")]
    for p, t, _ in starts:
        if any(q.startswith(p) or p.startswith(q) for q in out):
            continue
        longest = max((x for x in starts if x[0].startswith(p) and x[1] >= 0.9 * t), key=lambda x: len(x[0]))
        out[longest[0]] = longest[2]
    for p, _, w in found:
        if p.endswith(" ") and not any(p.startswith(q) for q in out):
            out[p] = w
    return out


def _learned_exceptions(sample: DataFrame, weights: dict[str, float]) -> frozenset[str]:
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = _built(tuple(weights.items()))
        for b in batches:
            out = []
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                folded = fold(text)
                found = {x for start, _, _, _ in matches(folded, a, frozenset()) for x in _phrases(folded, start + 1)[1:] if " " in x}
                out += [(x, toxic) for x in found]
            if out:
                x, t = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()), pa.array(t, pa.bool_())], names=["phrase", "toxic"])

    p = sample.mapInArrow(pairs, "phrase string, toxic boolean").groupBy("phrase").agg(F.count_if("toxic").alias("t"), F.count_if(~F.col("toxic")).alias("c"))
    return frozenset(r.phrase for r in p.filter((F.col("c") >= CLEAN_DOCS) & (F.col("t") == 0)).orderBy(F.desc("c"), "phrase").limit(MAX_PHRASES).collect())


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-4, steps: int = 100) -> tuple[float, float, float]:
    """Logistic regression on the two features by Newton's method; a slope below 0 is fitted again as 0."""
    use = np.ones(3, bool)
    m = np.concatenate([np.ones((len(x), 1)), x], 1)
    while True:
        b, mu = np.zeros(use.sum()), m[:, use]
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(mu @ b, -30, 30)))
            step = np.linalg.solve((mu * (p * (1 - p))[:, None]).T @ mu / len(x) + ridge * np.eye(len(b)), mu.T @ (p - y) / len(x) + ridge * b)
            b -= step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
            if np.abs(step).max() < 1e-9:
                break
        full = np.zeros(3)
        full[use] = b
        if (full[1:] >= 0).all():
            return tuple(map(float, full))
        use &= np.concatenate([[True], full[1:] >= 0])


def learn(docs: DataFrame, ratings: DataFrame, max_rows: int = 8000, exceptions: Iterable[str] = ()) -> Lexicon:
    """A lexicon from documents and their :func:`rated` rows; ``exceptions``: phrases of two words that excuse a match."""
    sample = save(_sample(docs, ratings, max_rows), "toxic-sample")
    counts = save(_counts(sample), "toxic-counts")
    weights = choose(_patterns(counts))
    if not weights:
        free(sample, counts)
        return Lexicon()
    given = frozenset(" ".join(fold(x).split()) for x in exceptions)
    held = Lexicon(weights, given | _learned_exceptions(sample, weights))
    seen = _weighed(sample.withColumn("_row", F.struct("text")), held, False).select("toxic", "_weight", "_words").toArrow()
    x = np.array([features(w, n) for w, n in zip(seen["_weight"].to_pylist(), seen["_words"].to_pylist())])
    free(sample, counts)
    return Lexicon(weights, held.exceptions, fit_curve(x, np.asarray(seen["toxic"].to_pylist(), bool)))


_SPANS = "array<struct<start:int,end:int,pattern:string,weight:double>>"
_SPAN_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("pattern", pa.string()), ("weight", pa.float64())]))


def _weighed(df: DataFrame, lexicon: Lexicon, spans: bool) -> DataFrame:
    """All columns of ``df`` and _score, _weight, _words, _matches for the text of its struct ``_row``."""
    at = df.columns.index("_row")
    weights, exceptions, names = tuple(lexicon.weights.items()), lexicon.exceptions, [*df.columns, "_score", "_weight", "_words", "_matches"]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = _built(weights)
        for b in batches:
            score, weight, words, found = [], [], [], []
            for t in b.column(at).field("text"):
                folded = fold(t.as_py())
                mine = list(matches(folded, a, exceptions))
                weight.append(sum(m[3] for m in mine))
                words.append(len(folded.split()))
                score.append(lexicon.score(weight[-1], words[-1]))
                found.append([dict(zip(("start", "end", "pattern", "weight"), m)) for m in mine] if spans else None)
            extra = [pa.array(score, pa.float64()), pa.array(weight, pa.float64()), pa.array(words, pa.int64()), pa.array(found, _SPAN_TYPE)]
            yield pa.RecordBatch.from_arrays([*b.columns, *extra], names=names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(released(weigh), f"{schema}, _score double, _weight double, _words long, _matches {_SPANS}")


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """All columns of ``docs`` and _score, _weight, _words and _matches (start and end in code points, pattern, weight)."""
    return unboxed(_weighed(boxed(docs), lexicon, True), docs.columns, "_score", "_weight", "_words", "_matches")


def held_out() -> Column:
    """Documents that the query learns nothing from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = learn(docs, rated(table(spark, sf_dir, "labels")).filter(~held_out()))
    s = score(docs, lexicon)
    return s.select("doc_id", held_out().alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= 0.3).cast("int").alias("predicted"))
