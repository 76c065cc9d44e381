"""A topic as files: metadata, offsets, restarts that neither lose nor repeat a record."""

import json
import os

import pytest

from tidemark.sources.topics import TopicFiles


def put(path, partition, base, values):
    os.makedirs(path, exist_ok=True)
    lines = "".join(json.dumps({"timestamp": 1_704_067_200_000 + base + i, "value": v}) + "\n" for i, v in enumerate(values))
    hidden = path / f"_{partition}-{base}.tmp"
    hidden.write_text(lines)
    hidden.rename(path / f"{partition}-{base}.jsonl")


@pytest.fixture
def topic(spark, tmp_path):
    spark.dataSource.register(TopicFiles)
    path = tmp_path / "clicks"
    put(path, 0, 0, [f"a{i}" for i in range(7)])
    put(path, 0, 7, ["a7", None])
    put(path, 1, 0, ["b0", "b1"])
    return path


def test_batch_reads_all_with_metadata(spark, topic):
    rows = sorted((r.partition, r.offset, r.value, r.topic, r.timestamp.timestamp()) for r in spark.read.format("topic_files").option("path", str(topic)).load().collect())
    assert [(p, o, v) for p, o, v, _, _ in rows] == [(0, i, f"a{i}") for i in range(8)] + [(0, 8, None), (1, 0, "b0"), (1, 1, "b1")]
    assert {t for *_, t, _ in rows} == {"clicks"} and rows[3][4] == 1_704_067_200.003
    os.makedirs(topic / "none")
    assert spark.read.format("topic_files").option("path", str(topic / "none")).load().count() == 0


def _run(spark, topic, tmp_path, **options):
    """All that is there now, as one run of a query with its own checkpoint."""
    s = spark.readStream.format("topic_files").option("path", str(topic)).options(**options).load()
    batches = []

    def keep(df, batch_id):
        rows = [(r.partition, r.offset, r.value) for r in df.collect()]
        if "fail" in [v for *_, v in rows] and not (tmp_path / "failed").exists():
            (tmp_path / "failed").write_text("")
            raise RuntimeError("once")
        batches.append(rows)

    q = s.writeStream.foreachBatch(keep).option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return batches


def test_restart_neither_loses_nor_repeats(spark, topic, tmp_path):
    first = [x for b in _run(spark, topic, tmp_path) for x in b]
    assert len(first) == len(set(first)) == 11
    assert [x for b in _run(spark, topic, tmp_path) for x in b] == []
    put(topic, 0, 9, ["a9", "fail", "a11"])
    put(topic, 2, 0, ["c0"])
    with pytest.raises(Exception, match="once"):
        _run(spark, topic, tmp_path)
    again = sorted(x for b in _run(spark, topic, tmp_path) for x in b)
    assert again == [(0, 9, "a9"), (0, 10, "fail"), (0, 11, "a11"), (2, 0, "c0")]


def test_one_task_reads_one_file(spark, topic):
    put(topic, 0, 9, ["a9"])
    assert spark.read.format("topic_files").option("path", str(topic)).load().rdd.getNumPartitions() == 4


def test_latest_starts_at_the_end(spark, topic, tmp_path):
    assert [x for b in _run(spark, topic, tmp_path, start="latest") for x in b] == []
    put(topic, 1, 2, ["b2"])
    assert [x for b in _run(spark, topic, tmp_path, start="latest") for x in b] == [(1, 2, "b2")]
