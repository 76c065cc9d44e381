"""Late rows kept aside and merged into the windows that they missed.

A stream's append mode drops a row for the windows that are closed, without a trace. Here a micro-batch splits its rows in the
same way, by the watermark that closed windows in the batch before it (which is the one that all batches before that
have left): what is in time goes to a table of panes, what a closed window
has missed to a table of partial windows, with a count. Both are mergeable, so the repaired windows are those of a
batch over all rows, and nothing is computed again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import windows as T
from tidemark.sources import sinks
from tidemark.streaming.panes import PaneTable

#: The watermark behind a batch, the one that the batch itself closed windows by, and its late rows.
_MARK = "watermark_us long, passed_us long, late_rows long"


class LateWindows:
    """Windows of ``size_s`` every ``slide_s`` by ``keys``, behind a watermark ``delay_s`` behind the newest event."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], size_s: int, slide_s: int, aggs: dict[str, T.Agg], delay_s: int, fanout: int = 8):
        self.spark, self.path, self.keys, self.size, self.slide, self.aggs, self.delay = spark, path, keys, size_s, slide_s, aggs, delay_s
        self.table = PaneTable(spark, f"{path}/panes", keys, slide_s, aggs, fanout)

    def writer(self, ts: str = "ts") -> Callable[[DataFrame, int], None]:
        """A ``foreachBatch`` function; a batch that ran before changes nothing."""

        def write(batch: DataFrame, batch_id: int) -> None:
            if sinks._exists(self.spark, f"{self.path}/marks/manifest/{batch_id + 1}/_SUCCESS"):
                return
            before = self._marks(sinks._last(self.spark, f"{self.path}/marks", batch_id))
            us, passed = (None, None) if before is None else (before.watermark_us, before.passed_us)
            n = T.panes_in(self.size, self.slide)
            rows = T.with_panes(batch, self.slide, ts)
            closed = -(1 << 40) if passed is None else passed // (self.slide * 1_000_000)
            first = F.greatest(F.col("_from"), F.lit(closed + 1))
            self.table.writer(ts)(rows.withColumn("_from", first).filter(F.col("_from") <= F.col("_pane") + n), batch_id)
            missed = rows.filter(F.col("_from") <= closed).withColumn("_end", F.explode(F.sequence(F.col("_from"), F.least(F.col("_pane") + n, F.lit(closed)))))
            late = missed.groupBy(*self.keys, "_end").agg(*[a.partial.alias(x) for x, a in self.aggs.items()])
            late.write.mode("overwrite").parquet(f"{self.path}/late/{batch_id}")
            seen = rows.agg(F.max(F.unix_micros(ts)).alias("us"), F.count_if(F.col("_from") <= closed).alias("late")).first()
            newest = None if seen.us is None else seen.us - self.delay * 1_000_000
            mark = max((x for x in (us, newest) if x is not None), default=None)
            self.spark.createDataFrame([(mark, us, seen.late)], _MARK).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/marks/manifest/{batch_id + 1}")

        return write

    def _marks(self, version: int):
        return self.spark.read.schema(_MARK).parquet(f"{self.path}/marks/manifest/{version}").first() if version else None

    def late_rows(self) -> int:
        """Rows that came too late for one of their windows or more."""
        versions = sinks._numbers(self.spark, f"{self.path}/marks/manifest")
        if not versions:
            return 0
        return self.spark.read.schema(_MARK).parquet(*[f"{self.path}/marks/manifest/{v}" for v in versions]).agg(F.sum("late_rows")).first()[0]

    def in_time(self) -> DataFrame:
        """What an append-mode stream shows: windows without the rows that came too late for them."""
        return self.table.windows(self.size)

    def repaired(self) -> DataFrame:
        """``keys``, window_end, aggregates with late rows merged in: the windows of a batch over all rows."""
        ends = T.merged_windows(self.table.panes(), self.keys, self.size, self.slide, self.aggs)
        folders = [f"{self.path}/late/{b}" for b in sinks._numbers(self.spark, f"{self.path}/late")]
        late = self.spark.read.schema(ends.select(*self.keys, "_end", *self.aggs).schema).parquet(*folders)
        both = ends.unionByName(late).groupBy(*self.keys, "_end").agg(*[a.merged(x).alias(x) for x, a in self.aggs.items()])
        return T.finished_windows(both, self.keys, self.slide, self.aggs)
