"""A topic kept as files, read record by record with offsets: a Python data source for batches and streams.

A topic is a folder of JSON lines; a file ``<partition>-<first offset>.jsonl`` holds a partition's records from that offset on, one
a line: ``{"timestamp": epoch milliseconds, "value": text}``. Files are written whole (under another name, then renamed)
and never changed. A stream's offsets are the next record of each partition, so a restarted query goes on exactly behind what its
checkpoint has committed; records come with the metadata of a topic. A file is one task, however long the topic.

``spark.dataSource.register(TopicFiles)``, then ``spark.readStream.format("topic_files").option("path", ..).option("topic", ..)``;
``start`` is ``earliest`` or ``latest``. A micro-batch takes all that is there: Spark asks for the newest offset without naming the
one it starts from, so a bound could fall behind it after a restart. The path may be any that ``pyarrow.fs`` opens on
every executor.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import datetime, timezone

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "value string, timestamp timestamp, offset long, partition int, topic string"


class _Stretch(InputPartition):
    """Records of one file from offset ``first`` to before ``last``."""

    def __init__(self, file: str, partition: int, base: int, first: int, last: int):
        self.file, self.partition, self.base, self.first, self.last = file, partition, base, first, last


class _Topic:
    def __init__(self, options: dict):
        self.path, self.topic = options["path"], options.get("topic", options["path"].rstrip("/").rsplit("/", 1)[-1])
        self.start = options.get("start", "earliest")

    def _open(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path)

    def files(self) -> list[tuple[int, int, str]]:
        """Partition, first offset and path of each file."""
        from pyarrow import fs

        store, at = self._open()
        found = [f for f in store.get_file_info(fs.FileSelector(at)) if f.base_name.endswith(".jsonl") and not f.base_name.startswith((".", "_"))]
        names = [(f.base_name.removesuffix(".jsonl").split("-"), f.path) for f in found]
        return sorted((int(p), int(base), path) for (p, base), path in names)

    def lines(self, file: str) -> Iterator[bytes]:
        import io

        store, _ = self._open()
        with store.open_input_stream(file) as f:
            yield from io.BufferedReader(f)

    def ends(self) -> dict[str, int]:
        """The next offset of each partition; only the lines of its last file are counted."""
        last = {p: (base, path) for p, base, path in self.files()}
        return {str(p): base + sum(1 for _ in self.lines(path)) for p, (base, path) in last.items()}

    def stretches(self, start: dict[str, int], end: dict[str, int]) -> list[_Stretch]:
        files = self.files()
        out = []
        for i, (p, base, path) in enumerate(files):
            behind = files[i + 1][1] if i + 1 < len(files) and files[i + 1][0] == p else end.get(str(p), 0)
            first, last = max(base, start.get(str(p), 0)), min(behind, end.get(str(p), 0))
            if first < last:
                out.append(_Stretch(path, p, base, first, last))
        return out

    def read(self, s: _Stretch) -> Iterator[tuple]:
        for at, line in enumerate(self.lines(s.file), s.base):
            if at >= s.last:
                return
            if at >= s.first:
                r = json.loads(line)
                yield r.get("value"), datetime.fromtimestamp(r["timestamp"] / 1000, timezone.utc), at, s.partition, self.topic


class _Batch(DataSourceReader):
    def __init__(self, topic: _Topic):
        self._topic = topic

    def partitions(self) -> list[InputPartition]:
        return self._topic.stretches({}, self._topic.ends()) or [_Stretch("", 0, 0, 0, 0)]

    def read(self, partition: _Stretch) -> Iterator[tuple]:
        return self._topic.read(partition) if partition.file else iter(())


class _Stream(DataSourceStreamReader):
    def __init__(self, topic: _Topic):
        self._topic = topic

    def initialOffset(self) -> dict:
        ends = self._topic.ends()
        return ends if ends and self._topic.start == "latest" else {"0": 0}

    def latestOffset(self) -> dict:
        return self._topic.ends() or {"0": 0}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return self._topic.stretches(start, end)

    def read(self, partition: _Stretch) -> Iterator[tuple]:
        return self._topic.read(partition)


class TopicFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "topic_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Batch(_Topic(dict(self.options)))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Stream(_Topic(dict(self.options)))
