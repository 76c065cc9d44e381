"""Sources: topics, JSON files with the same columns, JDBC queries and polled dimensions."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

RAW = "value string, timestamp timestamp, offset long, partition int, topic string"


def kafka(spark: SparkSession, servers: str, topic: str, group: str | None = None, start: str = "latest", streaming: bool = True, **options: str) -> DataFrame:
    """Text of a topic with its record's metadata. Needs Spark's Kafka package on the class path."""
    r = (spark.readStream if streaming else spark.read).format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", start if streaming else "earliest").options(**options)
    if group:
        r = r.option("kafka.group.id", group)
    return r.load().selectExpr("cast(value as string) as value", "timestamp", "offset", "partition", "topic")


def text_files(spark: SparkSession, path: str, streaming: bool = False, files_per_trigger: int | None = None) -> DataFrame:
    """JSON lines as text: the file twin of a topic."""
    r = spark.readStream if streaming else spark.read
    if streaming and files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.text(path)


def raw_files(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Parquet files with a topic's columns."""
    return (spark.readStream if streaming else spark.read).schema(RAW).parquet(path)


def jdbc_query(spark: SparkSession, url: str, query: str, fetch_size: int = 1000, partition_column: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 8, **options: str) -> DataFrame:
    """A bounded query; with a partition column and its bounds it is read in parallel."""
    r = spark.read.format("jdbc").option("url", url).option("fetchsize", fetch_size).options(**options)
    if partition_column and bounds:
        return r.option("dbtable", f"({query}) q").option("partitionColumn", partition_column).option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", partitions).load()
    return r.option("query", query).load()


class Polled:
    """A dimension that is read again when it is older than ``max_age_s``; for use inside ``foreachBatch``."""

    def __init__(self, read: Callable[[], DataFrame], max_age_s: float = 60, clock: Callable[[], float] = time.monotonic):
        self._read, self._age, self._clock = read, max_age_s, clock
        self._held: DataFrame | None = None
        self._at = 0.0

    def get(self) -> DataFrame:
        if self._held is None or self._clock() - self._at > self._age:
            if self._held is not None:
                self._held.unpersist()
            self._held, self._at = self._read().persist(), self._clock()
        return self._held


def in_memory(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)
