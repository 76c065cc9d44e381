"""Sinks for batches and micro-batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_LOCAL: dict[str, str] = {}


def kafka(df: DataFrame, servers: str, topic: str, checkpoint: str | None = None):
    """Rows as JSON to a topic. Needs Spark's Kafka package on the class path."""
    out = df.select(F.to_json(F.struct("*")).alias("value"))
    opts = {"kafka.bootstrap.servers": servers, "topic": topic}
    if df.isStreaming:
        return out.writeStream.format("kafka").options(**opts, checkpointLocation=checkpoint).start()
    return out.write.format("kafka").options(**opts).save()


def jdbc_upsert(df: DataFrame, url: str, target: str, staging: str, merge: list[str] | str, **options: str) -> None:
    """Write a staging table in parallel, then run the statements of ``merge`` in one transaction of the database
    (``MERGE``, or ``INSERT .. ON DUPLICATE KEY UPDATE``); ``{target}`` and ``{staging}`` in them are the tables' names.
    ``options`` (user, password, driver's own) hold for both."""
    df.write.format("jdbc").option("url", url).option("dbtable", staging).options(**options).mode("overwrite").save()
    jvm = df.sparkSession._jvm
    properties = jvm.java.util.Properties()
    for name, value in options.items():
        properties.setProperty(name, str(value))
    con = jvm.java.sql.DriverManager.getConnection(url, properties)
    try:
        con.setAutoCommit(False)
        for sql in [merge] if isinstance(merge, str) else merge:
            st = con.createStatement()
            st.execute(sql.replace("{target}", target).replace("{staging}", staging))
            st.close()
        con.commit()
    except Exception:
        con.rollback()
        raise
    finally:
        con.close()


def fan_out(targets: list[Callable[[DataFrame, int], None]]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes the same rows to every target, computed once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            for t in targets:
                t(held, batch_id)
        finally:
            held.unpersist()

    return write


def upsert_files(spark: SparkSession, path: str, change: Callable[[DataFrame, DataFrame], DataFrame], schema: str, key: str = "key", buckets: int = 16, keep: int = 2) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that keeps a table as Parquet in ``buckets`` folders by a hash of ``key``. A batch
    rewrites the buckets of its keys alone: a bucket's new version is ``change(its old rows, the batch's rows)``, so
    ``change`` may not look at other keys. A manifest of bucket versions, written last, is the table; a batch that ran
    before is not applied again, so retries give the same table. Bucket versions that the last ``keep`` manifests don't
    name are removed."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if _exists(spark, f"{path}/manifest/{batch_id + 1}/_SUCCESS"):
            return
        held = batch.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
        touched = sorted(r[0] for r in held.select("_bucket").distinct().collect())  # at most ``buckets`` numbers
        old = _manifest(spark, path, _last(spark, path, batch_id))
        now = dict(old)
        if touched:
            rows = _bucket_rows(spark, path, schema, {b: v for b, v in old.items() if b in touched})
            new = change(rows, held.drop("_bucket")).withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
            new.repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{path}/data/{batch_id + 1}")
            now |= {b: batch_id + 1 for b in touched}
        spark.createDataFrame(sorted(now.items()), "bucket int, version long").coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/{batch_id + 1}")
        _forget(spark, path, batch_id + 1, keep)

    return write


def read_files(spark: SparkSession, path: str, schema: str, version: int | None = None) -> DataFrame:
    """The table as of a version (a batch id and 1), or its newest."""
    return _bucket_rows(spark, path, schema, _manifest(spark, path, _last(spark, path, version)))


def _bucket_rows(spark: SparkSession, path: str, schema: str, versions: dict[int, int]) -> DataFrame:
    paths = [p for b, v in versions.items() if _exists(spark, p := f"{path}/data/{v}/_bucket={b}")]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folder's entries; one listing."""
    if not _exists(spark, folder):
        return []
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return sorted(f.getPath().getName() for f in at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at))


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    """The names as numbers, which they are."""
    return sorted(map(int, _names(spark, folder)))


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _last(spark: SparkSession, path: str, version: int | None) -> int:
    done = [v for v in _numbers(spark, f"{path}/manifest") if (version is None or v <= version) and _exists(spark, f"{path}/manifest/{v}/_SUCCESS")]
    return max(done, default=0)


def _manifest(spark: SparkSession, path: str, version: int) -> dict[int, int]:
    if not version:
        return {}
    return {r.bucket: r.version for r in spark.read.schema("bucket int, version long").parquet(f"{path}/manifest/{version}").collect()}


def _forget(spark: SparkSession, path: str, version: int, keep: int) -> None:
    manifests = [v for v in _numbers(spark, f"{path}/manifest") if v <= version]
    named = {x for v in manifests[-keep:] for x in _manifest(spark, path, v).values()}
    gone = [f"{path}/manifest/{v}" for v in manifests[:-keep]] + [f"{path}/data/{v}" for v in _numbers(spark, f"{path}/data") if v <= version and v not in named]
    for p in gone:
        _delete(spark, p)


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's name where the driver and all executors see it: under ``spark.checkpoint.dir``, or, in local mode without one,
    under the system's folder for temporary files."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = _LOCAL.setdefault("dir", tempfile.mkdtemp(prefix="spark-tables-"))
    return f"{named}/{name}-{uuid.uuid4().hex}"


def show(df: DataFrame, checkpoint: str | None = None):
    """Rows to the console."""
    return df.writeStream.format("console").start() if df.isStreaming else df.show()
