"""Chat formatting in budgeted windows.

A conversation's turns, in order, are cut into windows of at most ``budget`` tokens. A window opens with the system turn,
repeats the last turns of the window before it as history while they fit in ``history`` tokens and in the window, and
goes on with new turns; spans are found on running sums of turn tokens and always end between turns. Loss falls on the
text of new assistant turns alone: what is repeated is masked. A turn's tokens are those of the whole rendered turn, and a
window's are their sum, for no token crosses from one turn into the next.

The budget is held but for a turn that is longer than it: that one has a window of its own, whole and with nothing else.
A turn that doesn't fit beside the system turn opens a window without it. The system turn itself is a turn of the
conversation and stands, as new, in the first window; alone, if the next turn doesn't fit beside it.

Template: ``<turn ROLE>TEXT</turn>`` and a line break. In roles and texts, a backslash comes before every backslash,
before ``<turn`` and ``</turn``, and (in roles) before ``>``; taking it away again restores the text.

Turns are hash-partitioned by conversation and sorted, and one pass writes windows as they close: memory is bound by a
window, not by a conversation, and formatting and reading back take time and memory in proportion to the text.

Defined cases: a null text or role is empty; a null ``conv_id`` is a conversation; turns with equal numbers follow by role
and text, null numbers first; repeated rows are repeated turns; a system turn is the first turn if its role is ``system``;
an empty table gives no windows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .encoding import encode
from .scratch import table

_ESCAPED = re.compile(r"\\(.)", re.S)
OPEN, END = "<turn ", "</turn>\n"


def escape(text: str, role: bool = False) -> str:
    text = text.replace("\\", "\\\\").replace("<turn", "\\<turn").replace("</turn", "\\</turn")
    return text.replace(">", "\\>") if role else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


def render(role: str, text: str) -> tuple[str, str, str]:
    """What stands before the text, the text, and what ends the turn."""
    return f"{OPEN}{escape(role, True)}>", escape(text), END


def _unescaped(text: str, mark: str, at: int) -> int:
    """Where ``mark`` stands at or behind ``at`` with an even number of backslashes before it."""
    while True:
        found = text.index(mark, at)
        back = found
        while back > at and text[back - 1] == "\\":
            back -= 1
        if (found - back) % 2 == 0:
            return found
        at = found + 1


def parse_turns(text: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a formatted window."""
    out, at = [], 0
    while at < len(text):
        begin = _unescaped(text, ">", at + len(OPEN)) + 1
        end = _unescaped(text, END, begin)
        out.append((unescape(text[at + len(OPEN) : begin - 1]), unescape(text[begin:end])))
        at = end + len(END)
    return out


def windows(turns: Iterator[tuple[str, str, int]], budget: int, history: int) -> Iterator[tuple[list[tuple[str, str]], int]]:
    """Turns of each window, and how many of them come again. ``turns``: role, text, tokens."""
    system: tuple[str, str, int] | None = None
    now: list[tuple[str, str, int]] = []
    used, old, first = 0, 0, True
    for turn in turns:
        if len(now) > old and used + turn[2] > budget:
            yield [t[:2] for t in now], old
            again: list[tuple[str, str, int]] = []
            head = [system] if system and system[2] + turn[2] <= budget else []
            room = min(history, budget - turn[2] - sum(t[2] for t in head))
            for t in reversed([t for t in now if t is not system]):
                room -= t[2]
                if room < 0:
                    break
                again.insert(0, t)
            now = head + again
            old, used = len(now), sum(t[2] for t in now)
        if first and turn[0] == "system":
            system = turn
        first = False
        now.append(turn)
        used += turn[2]
    if len(now) > old:
        yield [t[:2] for t in now], old


def format_chats(conversations: DataFrame, budget: int = 1024, history: int = 256, loss_role: str = "assistant", ranks_path: str | None = None) -> DataFrame:
    """A row a window: conv_id, window, first_turn (number of the first new turn), repeated, text, loss (array of
    [start, end) code points in the text)."""
    t = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    t = t.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").withColumn("conv_id", F.col("conv_id").cast("string"))  # ids of pandas with nulls would be floats

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows():
            for f in frames:
                for c, role, text in zip(f["conv_id"], f["role"], f["text"]):
                    yield c, role, text

        source = rows()
        ahead = next(source, None)
        out: list[tuple] = []
        size = 0
        while ahead is not None:
            conv = ahead[0]

            def own():
                nonlocal ahead
                while ahead is not None and ahead[0] == conv:
                    role, text = ahead[1:]
                    ahead = next(source, None)
                    yield role, text, len(encode("".join(render(role, text)), ranks_path))

            new_from = 0
            for n, (turns, old) in enumerate(windows(own(), budget, history)):
                body, at, loss = [], 0, []
                for k, (role, text) in enumerate(turns):
                    a, b, c = render(role, text)
                    if k >= old and role == loss_role:
                        loss.append([at + len(a), at + len(a) + len(b)])
                    body += [a, b, c]
                    at += len(a) + len(b) + len(c)
                out.append((conv, n, new_from, old, "".join(body), loss))
                new_from += len(turns) - old
                size += at
                if size > 4 << 20:
                    yield _frame(out)
                    out, size = [], 0
        if out:
            yield _frame(out)

    out = t.mapInPandas(write, "conv_id string, window long, first_turn long, repeated int, text string, loss array<array<int>>")
    return out.withColumn("conv_id", F.col("conv_id").cast("long"))


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["conv_id", "window", "first_turn", "repeated", "text", "loss"])


def read_back(formatted: DataFrame) -> DataFrame:
    """From windows' texts alone: conv_id, window, n_turns (new ones), turns (role, line break, text, line break of
    each new turn), loss_text (unescaped text under the mask), chars."""

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            n, turns, loss = [], [], []
            for text, old, spans in zip(f["text"], f["repeated"], f["loss"]):
                found = parse_turns(text)[old:]
                n.append(len(found))
                turns.append("".join(f"{r}\n{t}\n" for r, t in found))
                loss.append("".join(unescape(text[a:b]) for a, b in spans))
            yield pd.DataFrame({"conv_id": f["conv_id"], "window": f["window"], "n_turns": n, "turns": turns, "loss_text": loss, "chars": f["text"].str.len()})

    out = formatted.withColumn("conv_id", F.col("conv_id").cast("string")).mapInPandas(parse, "conv_id string, window long, n_turns long, turns string, loss_text string, chars long")
    return out.withColumn("conv_id", F.col("conv_id").cast("long"))


def digests(read: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of each conversation of :func:`read_back`
    rows: windows in order through running digests, so that no conversation is gathered."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        now, out = None, []
        for f in frames:
            for c, n, turns, loss, chars in zip(f["conv_id"], f["n_turns"], f["turns"], f["loss_text"], f["chars"]):
                if now is None or now[0] != c:
                    if now is not None:
                        out.append(_closed(now))
                    now = [c, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                now[1] += n
                now[2].update(turns.encode())
                now[3] += len(loss)
                now[4].update(loss.encode())
                now[5] += chars
            yield pd.DataFrame(out, columns=names)
            out = []
        if now is not None:
            yield pd.DataFrame([_closed(now)], columns=names)

    r = read.select(F.col("conv_id").cast("string").alias("conv_id"), "window", "n_turns", "turns", "loss_text", "chars")
    r = r.repartition("conv_id").sortWithinPartitions("conv_id", "window")
    out = r.mapInPandas(run, "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return out.withColumn("conv_id", F.col("conv_id").cast("long"))


def _closed(now: list) -> tuple:
    return tuple(x.hexdigest() if i in (2, 4) else x for i, x in enumerate(now))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    planted = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    return digests(read_back(format_chats(chats)))
