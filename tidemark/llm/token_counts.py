"""Token counts from an exact length histogram.

Documents are encoded once and counted by (encoded length). From the histogram alone, suffix sums answer for
every context limit how many documents are longer, what truncation to it keeps, and every quantile.

The sums are taken in two levels: lengths fall into at most 1,024 blocks for each power of two, sums run
inside a block, and block totals (a few thousand rows at any input size) are summed over all. Neither level
grows with the number of documents.

Defined cases: a null text has length 0; ``by`` values may be null and form a group; an empty table gives an
empty result; repeated rows count each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .encoding import encode
from .scratch import save, table


def length_histogram(docs: DataFrame, by: Sequence[str] = (), ranks_path: str | None = None) -> DataFrame:
    """``by``..., length, n_docs."""

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = pa.array([len(encode(t.as_py(), ranks_path)) for t in b.column(0)], pa.int64())
            yield pa.RecordBatch.from_arrays([n, *b.columns[1:]], names=["length", *by])

    kinds = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in by)
    encoded = docs.select("text", *by).mapInArrow(lengths, f"length long{kinds}")
    return encoded.groupBy(*by, "length").agg(F.count("*").alias("n_docs"))


def context_table(hist: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A row for each length that occurs, taken as the context limit: the documents over it, the tokens kept
    when all are truncated to it, and the share of documents it holds whole."""
    hist = save(hist, "token-histogram")  # read twice below; its documents are encoded once
    h = hist.withColumn("block", F.expr("length(bin(length)) * 2048L + shiftright(length, cast(greatest(length(bin(length)) - 10, 0) as int))"))
    h = h.withColumn("tokens", F.col("length") * F.col("n_docs"))
    inside = W.partitionBy(*by, "block").orderBy("length")
    over = W.partitionBy(*by).orderBy(F.desc("block")).rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*by)
    blocks = h.groupBy(*by, "block").agg(F.sum("n_docs").alias("bd"), F.sum("tokens").alias("bt"))
    blocks = blocks.select(
        *[F.col(c).alias(f"_{c}") for c in by], F.col("block").alias("_block"),
        F.coalesce(F.sum("bd").over(over), F.lit(0)).alias("docs_above"), F.coalesce(F.sum("bt").over(over), F.lit(0)).alias("tokens_above"),
        F.sum("bd").over(whole).alias("total_docs"), F.sum("bt").over(whole).alias("total_tokens"),
    )
    later = inside.rowsBetween(1, W.unboundedFollowing)
    h = h.withColumn("later_docs", F.coalesce(F.sum("n_docs").over(later), F.lit(0))).withColumn("later_tokens", F.coalesce(F.sum("tokens").over(later), F.lit(0)))
    on = F.col("block") == F.col("_block")
    for c in by:
        on &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    longer, longer_tokens = F.col("later_docs") + F.col("docs_above"), F.col("later_tokens") + F.col("tokens_above")
    kept = F.col("total_tokens") - longer_tokens + longer * F.col("length")
    return h.join(blocks, on).select(
        *by, F.col("length").alias("context_limit"), "n_docs", longer.alias("docs_over"), longer_tokens.alias("tokens_of_docs_over"), kept.alias("truncated_tokens"),
        (F.col("total_docs") - longer).alias("docs_whole"), "total_docs", "total_tokens", ((F.col("total_docs") - longer) / F.col("total_docs")).alias("quantile"),
    )


def at_limits(hist: DataFrame, limits: Sequence[int], by: Sequence[str] = ()) -> DataFrame:
    """Totals for any limits, whether such a length occurs or not: ``by``..., context_limit, truncated_tokens, docs_over."""
    x = hist.withColumn("context_limit", F.explode(F.array(*[F.lit(int(k)).cast("long") for k in limits])))
    return x.groupBy(*by, "context_limit").agg(
        F.sum(F.least("length", "context_limit") * F.col("n_docs")).alias("truncated_tokens"), F.sum(F.when(F.col("length") > F.col("context_limit"), F.col("n_docs")).otherwise(0)).alias("docs_over")
    )


def quantiles(contexts: DataFrame, qs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """The least length that holds a share ``q`` of the documents whole: ``by``..., q, length."""
    x = contexts.withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in qs]))).filter(F.col("docs_whole") >= F.col("q") * F.col("total_docs"))
    return x.groupBy(*by, "q").agg(F.min("context_limit").alias("length"))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_table(length_histogram(table(spark, sf_dir, "documents")))
