"""Line dedup over levelled sorted runs of line hashes. DataFrame functions only.

A *run* holds keys (128-bit hashes of long lines) with the number of documents that hold each and the largest of their
ids, bucketed and sorted by key. No key is in two runs: a batch's keys are anti-joined with the runs so far, and what
passes becomes the batch's own run at level 0; what doesn't is known, and its counts go to the *hits*, one row for each
batch that saw the key again. When a level has ``fanout`` runs they are merged into one run of the next level, so a key is
rewritten once a level and a batch meets few runs. A key's total is that of its run and its hits; documents lose the
lines of keys that reach ``min_docs``, except in the largest document id.

All runs have equally many buckets, more for larger tables: anti-joins and merges need no shuffle. Texts are read twice, once for the table of
long lines (document, position, key), of which the batches are parts, and once to cut lines out; only then they are
shuffled, to meet the positions that their document loses. A very common line is one row of a run however many documents
hold it; documents meet only the frequent keys, in a join that Spark can split at a hot key. Cutting takes time in
proportion to a text's lines.

Defined cases: a null or empty text is one empty line; documents with a null ``doc_id`` aren't counted and keep all lines;
rows that share a ``doc_id`` count as one document and each loses its own lines; keys shorter than ``min_chars`` code
points are never dropped; an empty table gives an empty result; other columns are returned as they are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import boxed, free, save, save_bucketed, saved_bytes, table, unboxed

BLANKS = r" \u0009\u000A\u000B\u000C\u000D"
#: Bytes of the table of long lines for which the runs have a bucket, where that makes more than shuffles have partitions.
BUCKET_BYTES = 256 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """Blanks stripped at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.expr(f"'{BLANKS}'")), _UPPER, _LOWER)


def key_hash(key: Column) -> Column:
    """128 bits, so that no two keys of a large corpus share one."""
    return F.unhex(F.md5(F.encode(key, "UTF-8")))


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def long_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """doc_id, text_id (a hash that tells rows of one doc_id apart), pos (from 0), key of every long line."""
    text = F.col("text")
    # the hash and the lines are made once, below the generator of lines: an expression on the text beside it would be
    # computed, and the text copied, for each line
    whole = F.explode(F.array(F.struct(F.xxhash64(text).alias("text_id"), text_lines(text).alias("lines")))).alias("whole")
    split = docs.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), whole)
    split = split.select("doc_id", F.col("whole.text_id").alias("text_id"), F.col("whole.lines").alias("lines"))
    lines = split.select("doc_id", "text_id", F.posexplode("lines").alias("pos", "line"))
    # the length is tested on the line first: most lines are short
    keyed = lines.filter(F.length("line") >= min_chars).select("doc_id", "text_id", "pos", line_key(F.col("line")).alias("line")).filter(F.length("line") >= min_chars)
    return keyed.select("doc_id", "text_id", "pos", key_hash(F.col("line")).alias("key"))


class LineRuns:
    """Runs by level (key, n_docs, max_doc), and hits (the same columns) of keys met again."""

    def __init__(self, spark: SparkSession, fanout: int = 2, buckets: int | None = None):
        self.fanout = fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = []
        self.hits: list[DataFrame] = []

    def runs(self) -> list[DataFrame]:
        return [r for level in self.levels for r in level]

    def _save(self, rows: DataFrame, name: str) -> DataFrame:
        return save_bucketed(rows, name, "key", self.buckets)

    def add(self, lines: DataFrame) -> None:
        """Count a batch of lines (key, doc_id) of documents that no earlier batch held a part of."""
        held = lines.select("key", "doc_id").distinct()
        counts = held.groupBy("key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("max_doc"))
        if not self.runs():
            self._put(self._save(counts, "line-run"), 0)
            return
        counts = self._save(counts, "line-batch")
        new = self._save(self.unknown(counts), "line-run")
        self.hits.append(self._save(counts.join(new, "key", "left_anti"), "line-hits"))
        free(counts)
        self._put(new, 0)

    def unknown(self, counts: DataFrame) -> DataFrame:
        """A batch's keys that no run holds."""
        return reduce(lambda rows, run: rows.join(run, "key", "left_anti"), self.runs(), counts)

    def _put(self, run: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            old, self.levels[level] = self.levels[level], []
            merged = self._save(reduce(_merged, old), "line-run")
            free(*old)
            self._put(merged, level + 1)

    def frequent(self, min_docs: int) -> DataFrame:
        """key, max_doc of the keys found in at least ``min_docs`` documents."""
        n, last = F.col("n_docs"), F.col("max_doc")
        again = reduce(lambda a, b: a.unionByName(b), self.hits).groupBy("key").agg(F.sum("n_docs").alias("_n"), F.max("max_doc").alias("_last")) if self.hits else None
        parts = []
        for run in self.runs():
            if again is not None:
                total = run.join(again, "key", "left").select("key", (n + F.coalesce("_n", F.lit(0))).alias("n_docs"), F.greatest(last, F.col("_last")).alias("max_doc"))
            parts.append((run if again is None else total).filter(n >= min_docs).select("key", "max_doc"))
        return reduce(lambda a, b: a.unionByName(b), parts)

    def free(self) -> None:
        free(*self.runs(), *self.hits)


def _merged(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two runs, whose keys differ, as one: a merge of sorted buckets."""
    b = b.toDF("key", "_n", "_last")
    return a.join(b, "key", "full_outer").select("key", F.coalesce("n_docs", "_n").alias("n_docs"), F.coalesce("max_doc", "_last").alias("max_doc"))


def lost_lines(lines: DataFrame, frequent: DataFrame) -> DataFrame:
    """doc_id, text_id, lost (positions) of the documents that lose lines."""
    lost = lines.join(frequent, "key").filter(F.col("doc_id") < F.col("max_doc"))
    return lost.groupBy("doc_id", "text_id").agg(F.collect_set("pos").alias("lost"))


def cut(docs: DataFrame, lost: DataFrame) -> DataFrame:
    """All columns of ``docs`` with the text cut, and n_lines, n_dropped."""
    text = F.col("_row")["text"]
    l = lost.withColumnsRenamed({"doc_id": "_id", "text_id": "_text"})
    d = boxed(docs).join(l, (F.col("_row")["doc_id"].cast("long") == F.col("_id")) & (F.xxhash64(text) == F.col("_text")), "left")
    # a generator, so that a text is split once and not for each of its lines
    d = d.withColumn("_lines", F.explode(F.array(F.when(F.col("lost").isNotNull(), text_lines(text)))))
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("lost"))
    kept = F.array_join(F.transform(left, lambda i: F.get(F.col("_lines"), i)), "\n")
    none = F.col("lost").isNull()
    d = d.withColumn("text", F.when(none, text).otherwise(kept)).withColumn("n_dropped", F.when(none, 0).otherwise(F.size("lost")).cast("long"))
    return unboxed(d.withColumn("n_lines", F.size(text_lines(text)).cast("long")), docs.columns, "text", "n_lines", "n_dropped")


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = 3, fanout: int = 2) -> DataFrame:
    """All columns of ``docs`` with repeated lines gone, and n_lines, n_dropped. The table is taken in ``batches`` parts by
    document id, as it would arrive over time."""
    part = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")
    lines = save(long_lines(docs, min_chars).withColumn("batch", part), "line-rows", "batch")
    shuffled = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = LineRuns(docs.sparkSession, fanout, max(shuffled, -(-saved_bytes(lines) // BUCKET_BYTES)))
    for i in range(batches):
        runs.add(lines.filter(F.col("batch") == i))
    # a table of its own, so that Spark can split the join at a line that very many documents hold
    frequent = save(runs.frequent(min_docs), "line-frequent")
    lost = save(lost_lines(lines, frequent), "line-lost")
    runs.free()
    free(lines, frequent)
    return cut(docs, lost)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


_STRIP = "chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"
OP9_SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents
), keyed AS (
  SELECT doc_id, line, pos, translate(trim(line, {_STRIP}), '{_UPPER}', '{_LOWER}') AS key FROM lines
), frequent AS (
  SELECT key, max(doc_id) AS max_doc FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT k.doc_id, k.line, k.pos, (f.key IS NOT NULL AND k.doc_id < f.max_doc) AS dropped FROM keyed k LEFT JOIN frequent f ON k.key = f.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
