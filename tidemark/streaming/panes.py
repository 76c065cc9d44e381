"""Mergeable panes kept in a table, so that a window of a day doesn't read its day of events again.

A micro-batch adds one folder with its own partial aggregates by key and pane, and reads nothing; when ``fanout`` folders of a level
are there, they are merged into one of the next level, so a pane is rewritten once a level. A manifest, written
last, names the folders that are the table: a batch that ran before isn't applied again, and what failed
half-way is overwritten by its retry. Windows merge the panes that they cover; panes are partitioned by day, so that a few
windows read a few days.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import windows as T
from tidemark.sources import sinks

DAY = 86_400


class PaneTable:
    """Panes of ``slide_s`` seconds under ``path``, aggregated by ``keys`` with ``aggs``. ``keep_s``: merges drop panes that are older
    than the newest by more."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], slide_s: int, aggs: dict[str, T.Agg], fanout: int = 8, keep_s: int | None = None):
        self.spark, self.path, self.keys, self.slide, self.aggs, self.fanout, self.keep = spark, path, keys, slide_s, aggs, fanout, keep_s

    def writer(self, ts: str = "ts") -> Callable[[DataFrame, int], None]:
        """A ``foreachBatch`` function."""

        def write(batch: DataFrame, batch_id: int) -> None:
            version = batch_id + 1
            if sinks._exists(self.spark, f"{self.path}/manifest/{version}/_SUCCESS"):
                return
            folders = self._folders(sinks._last(self.spark, self.path, batch_id))
            new = T.pane_rows(batch, self.keys, self.slide, self.aggs, ts)
            self._write(new, f"data/{version}-0")
            folders.append((f"data/{version}-0", 0))
            level = 0
            while len(full := [f for f, at in folders if at == level]) >= self.fanout:
                level += 1
                folders = [x for x in folders if x[0] not in full]
                if self._filled(full):
                    self._write(self._recent(self._merged(self._read(full))), f"data/{version}-{level}")
                    folders.append((f"data/{version}-{level}", level))
            self.spark.createDataFrame(folders, "folder string, level int").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/{version}")
            self._forget(version)

        return write

    def panes(self, first_end: int | None = None, last_end: int | None = None, size_s: int = 0) -> DataFrame:
        """Merged panes, or those of the windows of ``size_s`` that end from ``first_end`` to ``last_end`` (epoch seconds)."""
        rows = self._read([f for f, _ in self._folders(sinks._last(self.spark, self.path, None))])
        if first_end is not None:
            low = first_end - size_s
            rows = rows.filter((F.col("_day") >= low // DAY) & (F.col("_pane") >= low // self.slide))
        if last_end is not None:
            rows = rows.filter((F.col("_day") <= last_end // DAY) & (F.col("_pane") < last_end // self.slide))
        return self._merged(rows)

    def windows(self, size_s: int, first_end: int | None = None, last_end: int | None = None) -> DataFrame:
        """``keys``, window_end, aggregates of windows of ``size_s``: all, or those that end in a stretch."""
        out = T.pane_windows(self.panes(first_end, last_end, size_s), self.keys, size_s, self.slide, self.aggs)
        end = F.unix_seconds("window_end")
        out = out if first_end is None else out.filter(end >= first_end)
        return out if last_end is None else out.filter(end <= last_end)

    def _merged(self, panes: DataFrame) -> DataFrame:
        return T.merged_panes(panes, self.keys, self.aggs)

    def _recent(self, panes: DataFrame) -> DataFrame:
        if self.keep is None:
            return panes
        newest = panes.agg(F.max("_pane")).first()[0]
        return panes.filter(F.col("_pane") * self.slide >= newest * self.slide - self.keep)

    def _write(self, panes: DataFrame, folder: str) -> None:
        day = F.floor(F.col("_pane") * self.slide / DAY).cast("long")
        panes.withColumn("_day", day).write.mode("overwrite").partitionBy("_day").parquet(f"{self.path}/{folder}")

    def _filled(self, folders: list[str]) -> list[str]:
        """Those that hold panes."""
        return [f for f in folders if any(x.startswith("_day=") for x in sinks._names(self.spark, f"{self.path}/{f}"))]

    def _read(self, folders: list[str]) -> DataFrame:
        parts = [self.spark.read.parquet(f"{self.path}/{f}") for f in self._filled(folders)]
        if not parts:
            raise ValueError(f"no panes in {self.path}")
        return reduce(DataFrame.unionByName, parts)

    def _folders(self, version: int) -> list[tuple[str, int]]:
        if not version:
            return []
        return [(r.folder, r.level) for r in self.spark.read.schema("folder string, level int").parquet(f"{self.path}/manifest/{version}").collect()]

    def _forget(self, version: int) -> None:
        """Merged folders and older manifests; the last manifest but one and what it names stay for readers."""
        old = [v for v in sinks._numbers(self.spark, f"{self.path}/manifest") if v < version]
        named = {f for v in old[-1:] for f, _ in self._folders(v)}
        for p in [f"{self.path}/manifest/{v}" for v in old[:-1]] + [f"{self.path}/{f}" for f in self._unnamed(version, named)]:
            sinks._delete(self.spark, p)

    def _unnamed(self, version: int, named: set[str]) -> list[str]:
        now = named | {f for f, _ in self._folders(version)}
        return [f"data/{x}" for x in sinks._names(self.spark, f"{self.path}/data") if f"data/{x}" not in now and int(x.split("-")[0]) <= version]
