"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; in local mode without one, a temporary folder."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _LOCAL.setdefault("dir", tempfile.mkdtemp(prefix="spark-scratch-"))


def save(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage and outlives lost executors.
    Unlike ``checkpoint()``, it computes ``df`` once. :func:`free` removes it; a cluster's clean-up of the
    checkpoint folder removes what a lazy result still needs when its operator returns."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """The same as a table in ``buckets`` buckets of ``key``, each sorted by it: tables of equally many buckets are joined
    on the key without a shuffle."""
    spark, ident = df.sparkSession, uuid.uuid4().hex
    path, table_name = f"{scratch_dir(spark)}/{name}-{ident}", f"{name.replace('-', '_')}_{ident}"
    df.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table_name)
    out = spark.table(table_name)
    out._scratch_path, out._scratch_table = path, table_name
    return out


def released(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` for ``mapInArrow``, giving back to the system what Arrow keeps for reuse: a Python worker lives on for the tasks of the
    operators that follow, and each would add its share to what the executor holds."""

    def run(batches: Iterator) -> Iterator:
        for out in work(batches):
            yield out
            pa.default_memory_pool().release_unused()
        del batches
        pa.default_memory_pool().release_unused()

    return run


def saved_bytes(df: DataFrame) -> int:
    """Bytes of a table's files."""
    at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._scratch_path)
    return at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).getContentSummary(at).getLength()


def free(*frames: DataFrame | None) -> None:
    """Delete tables made by :func:`save` that nothing reads any more."""
    for df in frames:
        path = getattr(df, "_scratch_path", None)
        if path:
            if getattr(df, "_scratch_table", None):
                df.sparkSession.sql(f"DROP TABLE IF EXISTS {df._scratch_table}")
            at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def boxed(docs: DataFrame) -> DataFrame:
    """The rows as one struct column ``_row``, so that no working column of an operator clashes with theirs."""
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"))


def unboxed(df: DataFrame, columns: list[str], *added: str) -> DataFrame:
    """``columns`` out of ``_row`` and the columns that the operator added; where names are equal, the added one."""
    return df.select(*[F.col("_row")[c].alias(c) for c in columns if c not in added], *added)
