"""A hostile table: nulls in every column, empty and long texts, repeated rows, and columns whose names operators use."""

EXTRA = ["_row", "_size", "_id", "_lost", "_copies", "_score", "_found", "n_lines", "length", "key", "node"]
DDL = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in EXTRA)


def hostile(spark, texts=()):
    rows = [(1, "one two three four five six"), (2, None), (3, ""), (None, "no id here at all"), (None, None), (4, "one two three four five six"), (4, "one two three four five six"), (5, "w" * 70_000), (6, "a b " * 30_000), (7, " \t\n\x0b\x0c\r "), (8, "x\ny\n\n")]
    rows += [(100 + i, t) for i, t in enumerate(texts)]
    src = ["a", None, "b", "", "a"]
    return spark.createDataFrame([(i, t, None if n % 3 else "en", src[n % 5], None if n % 2 else 5, *(["x"] * len(EXTRA))) for n, (i, t) in enumerate(rows)], DDL)


def empty(spark):
    return spark.createDataFrame([], DDL)
