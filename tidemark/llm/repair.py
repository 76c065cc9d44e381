"""Conversation structure repair by Wagner-Fischer alignment of turns to a grammar of roles.

A well-formed conversation's role initials read ``(s?(ua)+)?``: nothing, or pairs of a user's and an assistant's turn, with one
system turn before them at most. For each length there is one such string (two families: ``ua..ua`` and ``sua..ua``), and a
conversation's turns are aligned to it by edits: keep (K), give another role (R), delete (D, required of turns that are blank
or repeat an earlier one), insert an empty turn (I). The cheapest script wins, among equally cheap ones that whose letters
are least.

All strings of a family end alike, so one Wagner-Fischer table over (turns left, characters left) holds the alignments to all
lengths: its first row has the cost of each. Only Ukkonen's band of it is computed. A greedy repair gives the incumbent's
cost; every script pays for its required deletions and a unit for each truncated turn, and two more at least for each step
off the diagonal, so cells farther from the diagonal than half of what the incumbent pays beyond that can't be part of a
cheapest script. The audits of all lengths that tie are backtraced side by side, letter by letter, and the least letter
decides which of them go on.

Faults are found with windows and features are a few bytes a turn, so that a conversation's texts are never held: the
aligning pass keeps two numbers a turn and the square root of the band's rows, and the pass that writes the repaired turns
streams texts behind their conversation's audit. A conversation is aligned by one task, as its turns depend on each other.
Equal short conversations are aligned once a task.

Defined cases: null roles, texts, ids and numbers read as one space (a turn number that is null sorts first and counts in no
gap; null ``conv_id`` is a conversation); turns with equal numbers follow by role, then by a hash of role and text; repeated rows
are repeated turns; role initials are compared as they are, so another letter or none must be reroled or deleted; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .line_dedup import BLANKS
from .scratch import save, table

#: Costs of edits (fixed values), and of a truncated turn that stays.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
_FAR = 1 << 29
#: Conversations of so many turns at most are remembered by their features.
SHORT = 32


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with nulls of role and text as one space."""
    space = F.lit(" ")
    ident, turn = F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn")
    return conversations.select(ident, turn, F.coalesce(F.col("role"), space).alias("role"), F.coalesce(F.col("text"), space).alias("text"))


def damage(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone: what crc32 of ``conv_id:turn`` modulo 20 does to a turn: 0 drops it (``gone``; the row stays,
    so that its conversation is known), 1 empties its text, 2 takes its ``.!?`` away, 3 repeats it, 4 makes it a user's."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    d = turns.withColumn("_code", code)
    text = F.when(F.col("_code") == 1, "").when(F.col("_code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    d = d.withColumn("text", text).withColumn("role", F.when(F.col("_code") == 4, "user").otherwise(F.col("role")))
    times = F.explode(F.sequence(F.lit(1), F.when(F.col("_code") == 3, 2).otherwise(1)))
    return d.select("conv_id", "turn", "role", "text", (F.col("_code") == 0).alias("gone"), times.alias("_n")).drop("_n")


def _same() -> Column:
    return F.md5(F.concat(F.col("role"), F.lit("\n"), F.col("text")).cast("binary"))


def faults(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, same (hash of role and text), gone, fault of each turn: blank, duplicate, truncated or null.
    ``gone`` rows have no fault."""
    gone = F.col("gone")
    last = F.substring(F.rtrim("text", F.expr(f"'{BLANKS}'")), -1, 1)
    d = turns.select("conv_id", "turn", "role", _same().alias("same"), "gone", last.alias("_last"))
    again = F.row_number().over(W.partitionBy("conv_id", "role", "same", "gone").orderBy(F.asc_nulls_first("turn"))) > 1
    fault = F.when(F.col("_last") == "", "blank").when(again, "duplicate").when(~F.col("_last").isin(".", "!", "?"), "truncated")
    return d.withColumn("fault", F.when(~gone, fault)).drop("_last")


# --- alignment of one conversation -----------------------------------------------------------------------------------


def _greedy(roles: bytes, forced: bytes, cut: bytes) -> int:
    """Cost of a repair that deletes what must go and inserts what is missing."""
    cost, want, other = 0, "u", {"u": "a", "a": "u"}
    left = [(chr(r), t) for r, f, t in zip(roles, forced, cut) if not f]
    headed = bool(left) and left[0][0] == "s"
    for role, _ in left[headed:]:
        if role not in other:
            cost, want = cost + REROLE, other[want]
        else:
            cost, want = cost + INSERT * (role != want), other[role]
    missing = 2 if headed and len(left) == 1 else want == "a"
    return cost + INSERT * missing + DELETE * sum(forced) + TRUNCATED * sum(t for _, t in left)


class _Band:
    """Costs of aligning the turns from i on with the last r characters of ``..uaua``, for r within ``half`` of the turns left
    that needn't go. Every block's last row is kept, the other rows of two blocks, and computed again for others."""

    def __init__(self, roles: bytes, forced: bytes, cut: bytes, half: int):
        self.roles, self.forced, self.cut, self.half, self.n = roles, forced, cut, half, len(roles)
        need = 1 - np.frombuffer(forced, np.uint8).astype(int)
        self.left = np.append(np.cumsum(need[::-1])[::-1], 0)
        self.block = max(64, isqrt(self.n) + 1)
        #: of each row, the cheapest way to one pair or more
        self.pairs = np.full(self.n + 1, _FAR)
        self.ends: dict[int, np.ndarray] = {}
        self.blocks: dict[int, dict[int, np.ndarray]] = {}
        r = np.arange(-half, half + 1)
        row = np.where(r >= 0, INSERT * r, _FAR).astype(np.int32)
        held = {self.n: row}
        self.ends[self.n] = row
        self._pair(self.n, row)
        for i in range(self.n - 1, -1, -1):
            row = self._row(i, row)
            if i % self.block == self.block - 1:
                held = {}
                self.ends[i] = row
            held[i] = row
            self._pair(i, row)
        self.blocks[0] = held

    def reach(self, i: int) -> np.ndarray:
        """Characters left of each entry of row i."""
        return int(self.left[i]) - self.half + np.arange(2 * self.half + 1)

    def _pair(self, i: int, row: np.ndarray) -> None:
        r = self.reach(i)
        self.pairs[i] = row[(r >= 2) & (r % 2 == 0)].min(initial=_FAR)

    def _row(self, i: int, below: np.ndarray) -> np.ndarray:
        """Row i from row i + 1."""
        r = self.reach(i)
        if self.forced[i]:
            row = DELETE + below
        else:  # one turn more is left: r is entry x + 1 below, r - 1 is entry x
            own = np.where(r % 2 == 0, self.roles[i] != ord("u"), self.roles[i] != ord("a")) * REROLE
            row = np.minimum(DELETE + np.append(below[1:], _FAR), own + TRUNCATED * self.cut[i] + below)
        steps = INSERT * np.arange(len(r))
        row = np.minimum.accumulate(np.where(r >= 0, row, _FAR) - steps) + steps
        return np.where((r >= 0) & (row < _FAR // 2), row, _FAR).astype(np.int32)

    def row(self, i: int) -> np.ndarray:
        b = i // self.block
        if b not in self.blocks:
            for old in list(self.blocks)[:-1]:
                del self.blocks[old]
            end = min(self.n, (b + 1) * self.block - 1)
            held = {end: self.ends[end]}
            for k in range(end - 1, b * self.block - 1, -1):
                held[k] = self._row(k, held[k + 1])
            self.blocks[b] = held
        return self.blocks[b][i]

    def at(self, i: int, r: int) -> int:
        x = r - int(self.left[i]) + self.half
        return int(self.row(i)[x]) if 0 <= x <= 2 * self.half and r >= 0 else _FAR


def align(roles: bytes, forced: bytes, cut: bytes) -> tuple[int, str]:
    """Cost and audit of the cheapest repair. ``roles``: initials; ``forced``: 1 where the turn must go; ``cut``: 1 where it is
    truncated."""
    n = len(roles)
    if n == 0:
        return 0, ""
    base = DELETE * sum(forced) + TRUNCATED * sum(t for t, f in zip(cut, forced) if not f)
    band = _Band(roles, forced, cut, max(1, (_greedy(roles, forced, cut) - base) // 2))
    # ``headed[i]``: the cheapest script that keeps a system turn from row i on and has deleted all turns before i
    headed = [_FAR] * (n + 1)
    for i in range(n - 1, -1, -1):
        keep = TRUNCATED * cut[i] + int(band.pairs[i + 1]) if roles[i] == ord("s") and not forced[i] else _FAR
        headed[i] = min(DELETE + headed[i + 1], keep)
    r0 = band.reach(0)
    even = (r0 >= 0) & (r0 % 2 == 0)
    best = min(int(band.row(0)[even].min(initial=_FAR)), headed[0])
    # the lengths that tie, side by side: they have the letters so far in common, so all stand before the same turn
    now = {int(r) for r in r0[even & (band.row(0) == best)]}
    head = headed[0] == best
    i, audit = 0, []
    while not (i == n and 0 in now):
        cost = {r: band.at(i, r) for r in now}
        gone = {r for r in now if DELETE + band.at(i + 1, r) == cost[r]} if i < n else set()
        head_gone = head and DELETE + headed[i + 1] == headed[i]
        if gone or head_gone:
            now, head, letter = gone, head_gone, "D"
        elif added := {r - 1 for r in now if INSERT + band.at(i, r - 1) == cost[r]}:
            now, head, letter = added, False, "I"
        else:
            kept, reroled = set(), set()
            for r in now:
                same = roles[i] == ord("ua"[r % 2])
                if (0 if same else REROLE) + TRUNCATED * cut[i] + band.at(i + 1, r - 1) == cost[r]:
                    (kept if same else reroled).add(r - 1)
            if head:
                r = band.reach(i + 1)
                kept |= {int(x) for x in r[(r >= 2) & (r % 2 == 0) & (band.row(i + 1) == band.pairs[i + 1])]}
            now, head, letter = kept or reroled, False, "K" if kept else "R"
        i += letter != "I"
        audit.append(letter)
    return best, "".join(audit)


@lru_cache(maxsize=1 << 16)
def _remembered(roles: bytes, forced: bytes, cut: bytes) -> tuple[int, str]:
    return align(roles, forced, cut)


_AUDIT = "conv_id long, blank long, duplicate long, truncated long, illegal long, gaps long, cost long, audit string"
_FAULTS = {"blank": 1, "duplicate": 2, "truncated": 3}


def audits(found: DataFrame) -> DataFrame:
    """A row a conversation from :func:`faults`: conv_id, blank, duplicate, truncated, illegal (adjacent initials that the grammar
    hasn't), gaps, cost, audit."""
    names = [x.split()[0] for x in _AUDIT.split(", ")]
    code = F.coalesce(*[F.when(F.col("fault") == f, n) for f, n in _FAULTS.items()], F.lit(0)).cast("tinyint")
    initial = F.coalesce(F.ascii(F.substring("role", 1, 1)), F.lit(0)) % 128
    other = F.when(F.substring("role", 1, 1).isin("s", "u", "a"), initial).otherwise(0).cast("tinyint")
    rows = found.select("conv_id", "turn", "role", "same", "gone", other.alias("initial"), code.alias("code"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "same", F.col("code") == 2).drop("role", "same")

    def closed(conv, roles: bytearray, codes: bytearray, seen: list) -> tuple:
        r, c = bytes(roles), bytes(codes)
        forced, cut = bytes(x in (1, 2) for x in c), bytes(x == 3 for x in c)
        cost, audit = (_remembered if len(r) <= SHORT else align)(r, forced, cut)
        wrong = sum(p not in (b"su", b"ua", b"au") for p in map(bytes, zip(r, r[1:])))
        low, high, different = seen
        return conv, c.count(1), c.count(2), c.count(3), wrong, high - low + 1 - different if different else 0, cost, audit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, any_row, out = None, False, []
        roles, codes, seen = bytearray(), bytearray(), [0, 0, 0]
        for b in batches:
            for conv, turn, gone, initial, c in zip(*[b.column(k).to_pylist() for k in range(5)]):
                if not any_row or conv != now:
                    if any_row:
                        out.append(closed(now, roles, codes, seen))
                    now, any_row, roles, codes, seen = conv, True, bytearray(), bytearray(), [0, 0, 0]
                if gone:
                    continue
                roles.append(initial)
                codes.append(c)
                if turn is not None and (not seen[2] or turn != seen[1]):  # sorted: another number, another turn
                    seen = [seen[0] if seen[2] else turn, turn, seen[2] + 1]
            if out:
                yield _batch(out, names)
                out = []
        if any_row:
            out.append(closed(now, roles, codes, seen))
            yield _batch(out, names)

    return rows.mapInArrow(run, _AUDIT)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n in ("audit", "role", "text", "edit", "repaired_sha256") else pa.int64()) for n, c in zip(names, zip(*rows))], names=names)


def repaired(turns: DataFrame, audit: DataFrame) -> DataFrame:
    """conv_id, position (from 0), role, text, edit of each repaired turn. A conversation's rows are in one partition, in order.
    Its audit is sorted before its turns, so that texts stream through."""
    empty = F.lit(None)
    rows = turns.filter(~F.col("gone")).select("conv_id", F.lit(1).alias("kind"), "turn", "role", _same().alias("same"), "text")
    heads = audit.select("conv_id", F.lit(0).alias("kind"), empty.cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("same"), F.col("audit").alias("text"))
    both = rows.unionByName(heads).repartition("conv_id").sortWithinPartitions("conv_id", "kind", F.asc_nulls_first("turn"), "role", "same")
    both = both.select("conv_id", "kind", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "position", "role", "text", "edit"]
        audit, at, place, odd, now, out, size = "", 0, 0, False, None, [], 0

        def role_at(p: int) -> str:
            return "user" if (p - odd) % 2 == 0 else "assistant"

        def insert() -> None:
            nonlocal at, place
            while at < len(audit) and audit[at] == "I":
                out.append((now, place, role_at(place), "", "I"))
                at, place = at + 1, place + 1

        for b in batches:
            for conv, kind, role, text in zip(*[b.column(k).to_pylist() for k in range(4)]):
                if kind == 0:
                    now, audit, at, place = conv, text, 0, 0
                    odd = (len(audit) - audit.count("D")) % 2 == 1
                    insert()
                    continue
                edit = audit[at]
                at += 1
                if edit != "D":
                    out.append((conv, place, role if edit == "K" else role_at(place), text, edit))
                    place += 1
                insert()
                size += len(text)
                if size > 4 << 20:
                    if out:
                        yield _batch(out, names)
                    out, size = [], 0
            if out:
                yield _batch(out, names)
                out, size = [], 0

    return both.mapInArrow(run, "conv_id long, position long, role string, text string, edit string")


def digests(rows: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 of rows as :func:`repaired` gives them, through running digests: ``role:text``, line breaks between."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha, out = None, None, []
        for b in batches:
            for conv, place, role, text in zip(*[b.column(k).to_pylist() for k in range(4)]):
                if sha is None or place == 0:
                    if sha is not None:
                        out.append((now, sha.hexdigest()))
                    now, sha = conv, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(f"{role}:{text}".encode())
            if out:
                yield _batch(out, ["conv_id", "repaired_sha256"])
                out = []
        if sha is not None:
            yield _batch([(now, sha.hexdigest())], ["conv_id", "repaired_sha256"])

    return rows.select("conv_id", "position", "role", "text").mapInArrow(run, "conv_id long, repaired_sha256 string")


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The audits and the repaired turns of ``turns`` (conv_id, turn, role, text, gone)."""
    audit = save(audits(faults(turns)), "turn-audits")
    return audit, repaired(turns, audit)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit, rows = repair(damage(turns_of(table(spark, sf_dir, "conversations"))))
    sha = digests(rows).withColumnRenamed("conv_id", "_c")
    out = audit.join(sha, F.col("conv_id").eqNullSafe(F.col("_c")), "left")
    none = F.coalesce(F.col("repaired_sha256"), F.sha2(F.lit("").cast("binary"), 256))
    return out.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", none.alias("repaired_sha256"))


_ID = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
#: The polynomial of CRC-32 (fixed value).
_CRC = "xor(list_reduce(list_prepend(4294967295, list_transform(string_split(id, ''), lambda x: CAST(ord(x) AS BIGINT))), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, n: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"
_RTRIM = "chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"


def _step(letter: str, cost: str, state: str) -> str:
    return f"{{'c': {cost} + {state}.c, 'p': '{letter}' || {state}.p}}"


def _pair_sql(initial: str, then: str) -> str:
    """Keep or rerole a turn as one of ``initial``."""
    return f"CASE WHEN forced THEN far WHEN z = '{initial}' THEN {_step('K', 'cut', then)} ELSE {_step('R', '2 + cut', then)} END"


#: The same optimum as a walk backwards over an automaton: nothing yet, behind a system turn, before an assistant's, before a user's.
OP11_SQL = f"""
WITH RECURSIVE c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_ID} AS id FROM conversations),
k AS (SELECT *, {_CRC} % 20 AS code FROM c),
d AS (
  SELECT conv_id, turn, CASE code WHEN 4 THEN 'user' ELSE role END AS role, CASE code WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM k, range(2) AS t(n) WHERE code <> 0 AND (n = 0 OR code = 3)
), h AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(role || chr(10) || text)) AS i FROM d),
o AS (
  SELECT *, left(role, 1) AS z, right(rtrim(text, {_RTRIM}), 1) AS e, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS again, count(*) OVER (PARTITION BY conv_id) AS n FROM h
), f AS (SELECT *, CASE WHEN e = '' THEN 'blank' WHEN again > 1 THEN 'duplicate' WHEN e NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault, lag(z) OVER (PARTITION BY conv_id ORDER BY i) AS y FROM o),
g AS (SELECT *, fault IN ('blank', 'duplicate') AS forced, CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END::BIGINT AS cut, {{'c': 536870912::BIGINT, 'p': ''}} AS far FROM f),
r(conv_id, i, none, sys, a, u) AS (
  SELECT DISTINCT conv_id, n + 1, {{'c': 0::BIGINT, 'p': ''}}, {{'c': 4::BIGINT, 'p': 'II'}}, {{'c': 2::BIGINT, 'p': 'I'}}, {{'c': 0::BIGINT, 'p': ''}} FROM g
  UNION ALL
  SELECT conv_id, i, list_min([none0, {_step('I', '2', 'a1')}]), list_min([sys0, {_step('I', '2', 'a1')}]), a1, list_min([u0, {_step('I', '2', 'a0')}]) FROM (
    SELECT *, list_min([a0, {_step('I', '2', 'u0')}]) AS a1 FROM (
      SELECT g.conv_id, g.i, list_min([{_step('D', '3', 'none')}, {_pair_sql('u', 'a')}, CASE WHEN z = 's' AND NOT forced THEN {_step('K', 'cut', 'sys')} ELSE far END]) AS none0,
        list_min([{_step('D', '3', 'sys')}, {_pair_sql('u', 'a')}]) AS sys0, list_min([{_step('D', '3', 'a')}, {_pair_sql('a', 'u')}]) AS a0, list_min([{_step('D', '3', 'u')}, {_pair_sql('u', 'a')}]) AS u0
      FROM r JOIN g ON g.conv_id IS NOT DISTINCT FROM r.conv_id AND g.i = r.i - 1))
), best AS (SELECT conv_id, none.c AS cost, none.p AS audit FROM r WHERE i = 1),
l AS (SELECT conv_id, unnest(string_split(audit, '')) AS letter, generate_subscripts(string_split(audit, ''), 1) AS p FROM best),
m AS (SELECT *, count(*) FILTER (WHERE letter <> 'I') OVER w AS i, count(*) FILTER (WHERE letter <> 'D') OVER w AS q, count(*) FILTER (WHERE letter <> 'D') OVER (PARTITION BY conv_id) % 2 AS odd FROM l WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
t AS (
  SELECT m.conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (q - 1 - odd) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS said
  FROM m LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM m.conv_id AND g.i = m.i WHERE letter <> 'D' GROUP BY m.conv_id
), s AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE i > 1 AND y || z NOT IN ('su', 'ua', 'au')) AS illegal FROM g GROUP BY conv_id
), every AS (SELECT DISTINCT conv_id FROM conversations)
SELECT every.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
FROM every LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM every.conv_id LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM every.conv_id LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM every.conv_id
"""
