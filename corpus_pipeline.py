"""The corpus pipeline: stages over ``documents``, each reading what its predecessor wrote.

Every stage works on all rows that its predecessor kept and returns the columns of ``documents``, the last one
packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import line_dedup, mixing, near_dedup, packing, quality
from tidemark.llm.scratch import free, save, table

#: Tokens, a trained classifier and hashed rounding can't be stated in SQL.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay that are of the top grade with a probability of one half at least."""
    rated = quality.classify(docs, table(spark, sf_dir, "labels"))
    return rated.filter(F.col("_tail") >= 0.5).select(*docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Long lines found in many documents stay in one; n_chars follows the text."""
    out = line_dedup.dedup_lines(docs).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that of the smallest id. Shingles are of four words, as in the
    registered query of this operator. Rows that share an id are one document and stay or go together, repeated rows too."""
    return near_dedup.deduplicate(docs, width=4)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its copies say."""
    return mixing.repeat(mixing.mix(docs), docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each with its sequence and place; a document that is there several times is packed as often."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), None
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            before, docs = held, save(docs, f"stage-{name}")
            held = docs
            free(before)
    return docs
