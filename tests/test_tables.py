"""Key-value tables, sinks, sources, panes and reports."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import joins, skew, topk
from tidemark.operators import windows as T
from tidemark.schemas import KV
from tidemark.sources import kv, readers, sinks

T0 = "timestamp'2024-01-01 00:00:00'"


def at(minutes):
    return F.expr(f"{T0} + interval {minutes} minutes")


def content(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_strings_and_expiry(spark):
    none = spark.createDataFrame([], KV)
    a = kv.set_strings(none, spark.createDataFrame([("k", "1", 1), ("k", "2", 2), ("j", "3", 1)], "key string, value string, n int"), at(0), 600, "n")
    assert content(kv.scan(a, "%", at(5)), "key", "value") == [("j", "3"), ("k", "2")]
    assert kv.scan(a, "%", at(11)).count() == 0
    b = kv.set_strings(a, spark.createDataFrame([("k", "9", 1)], "key string, value string, n int"), at(9), 600, "n")
    assert content(kv.scan(b, "k%", at(11)), "key", "value") == [("k", "9")]


def test_hashes_lists_sets(spark):
    none = spark.createDataFrame([], KV)
    rows = spark.createDataFrame([("h", "a", "1", 1), ("h", "b", "2", 1)], "key string, field string, value string, n int")
    h = kv.set_fields(none, rows, at(0), None, "n")
    more = spark.createDataFrame([("h", "c", "3", 1)], "key string, field string, value string, n int")
    assert content(kv.set_fields(h, more, at(1), None, "n"), "field") == [("a",), ("b",), ("c",)]
    assert content(kv.set_fields(h, more, at(1), None, "n", replace=True), "field") == [("c",)]
    items = lambda *v: spark.createDataFrame([("l", x, i) for i, x in enumerate(v)], "key string, value string, n int")
    left = kv.push(kv.push(none, items("x", "y"), at(0), None, "n"), items("p", "q"), at(0), None, "n", left=True)
    assert [r.value for r in left.orderBy("seq").collect()] == ["q", "p", "x", "y"]
    assert content(kv.scan(left, "l", at(1), "list"), "value") == [("q",)]
    s = kv.add_members(kv.add_members(none, items("x", "x", "y"), at(0), None), items("y", "z"), at(0), None)
    assert content(s, "field") == [("x",), ("y",), ("z",)]
    assert content(kv.scan(s, "l", at(1), "set"), "value") == [("x",)]


def test_upserted_files_apply_a_batch_once(spark, tmp_path):
    change = lambda old, new: kv.set_strings(old, new, at(0), None, "n")
    write = sinks.upsert_files(spark, str(tmp_path / "kv"), change, KV)
    rows = lambda v: spark.createDataFrame([("k", v, 1)], "key string, value string, n int")
    seen = []
    both = sinks.fan_out([write, lambda b, i: seen.append(b.count())])
    both(rows("1"), 0)
    both(rows("2"), 1)
    both(rows("other"), 1)
    assert content(sinks.read_files(spark, str(tmp_path / "kv"), KV), "key", "value") == [("k", "2")] and seen == [1, 1, 1]


def test_upserts_rewrite_only_their_buckets(spark, tmp_path):
    import os

    path = str(tmp_path / "kv")
    change = lambda old, new: kv.set_strings(old, new, at(0), None, "n")
    write = sinks.upsert_files(spark, path, change, KV, buckets=8, keep=1)
    batch = lambda *r: spark.createDataFrame(list(r), "key string, value string, n int")
    write(batch(*[(f"k{i}", "1", 1) for i in range(40)]), 0)
    write(batch(("k3", "2", 1)), 1)
    write(batch(("k3", "3", 1), ("new", "1", 1)), 2)
    got = dict(content(sinks.read_files(spark, path, KV), "key", "value"))
    assert len(got) == 41 and got["k3"] == "3" and got["k4"] == "1"
    assert sum(n.startswith("_bucket") for n in os.listdir(f"{path}/data/3")) <= 2
    assert sorted(os.listdir(f"{path}/manifest")) == ["3"] and not os.path.exists(f"{path}/data/2")


def test_jdbc_merge_takes_credentials_and_several_statements(spark):
    url = "jdbc:derby:memory:guarded;create=true"
    who = {"user": "app", "password": "a;b{c}"}
    new = spark.createDataFrame([(1, "x;{y}")], "ID int, T string")
    new.write.format("jdbc").option("url", url).option("dbtable", "NOTES").options(**who).option("createTableColumnTypes", "T VARCHAR(20)").mode("overwrite").save()
    sinks.jdbc_upsert(spark.createDataFrame([(2, "z")], "ID int, T string"), url, "NOTES", "STAGED2", ["INSERT INTO {target} SELECT ID, CAST(SUBSTR(T, 1, 20) AS VARCHAR(20)) FROM {staging}", "UPDATE {target} SET T = 'a;{b}' WHERE ID = 1"], **who)
    got = dict(content(spark.read.format("jdbc").option("url", url).option("dbtable", "NOTES").options(**who).load(), "ID", "T"))
    assert got == {1: "a;{b}", 2: "z"}


def test_jdbc_round_trip(spark):
    url = "jdbc:derby:memory:tidemark;create=true"
    base = spark.range(20).select(F.col("id").cast("int").alias("ID"), (F.col("id") * 2).cast("int").alias("N"))
    base.write.format("jdbc").option("url", url).option("dbtable", "COUNTS").mode("overwrite").save()
    assert readers.jdbc_query(spark, url, "SELECT ID, N FROM COUNTS WHERE ID < 5").count() == 5
    assert readers.jdbc_query(spark, url, "SELECT ID, N FROM COUNTS", partition_column="ID", bounds=(0, 20), partitions=3).rdd.getNumPartitions() == 3
    new = spark.createDataFrame([(3, 100), (50, 7)], "ID int, N int")
    sinks.jdbc_upsert(new, url, "COUNTS", "STAGED", "MERGE INTO {target} t USING {staging} s ON t.ID = s.ID WHEN MATCHED THEN UPDATE SET N = s.N WHEN NOT MATCHED THEN INSERT (ID, N) VALUES (s.ID, s.N)")
    got = dict(content(readers.jdbc_query(spark, url, "SELECT ID, N FROM COUNTS"), "ID", "N"))
    assert got[3] == 100 and got[50] == 7 and len(got) == 21


def test_polled_dimension(spark):
    clock, reads = [0.0], []
    p = readers.Polled(lambda: reads.append(1) or spark.range(len(reads)), 60, lambda: clock[0])
    assert p.get().count() == 1 and p.get().count() == 1
    clock[0] = 61
    assert p.get().count() == 2


def test_membership_is_empty_while_the_set_is(spark):
    rows = spark.range(5)
    assert joins.members(rows, spark.range(0), "id").count() == 0
    assert joins.members(rows, spark.range(3).union(spark.range(3)), "id").count() == 3


ROWS = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 7200), st.integers(0, 50)), min_size=1, max_size=25)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=ROWS)
def test_panes_equal_windows(spark, rows):
    df = spark.createDataFrame([(k, v, t) for k, t, v in rows], "k int, v int, t int").withColumn("ts", F.timestamp_seconds("t"))
    panes = T.paned(df, ["k"], 3600, 600, {"n": T.count_all(), "s": T.sum_of("v"), "hi": T.max_of("v"), "lo": T.min_of("v"), "d": T.distinct_sketch("v")})
    direct = T.windowed(df, ["k"], "1 hour", "10 minutes", {"n": F.count("*"), "s": F.sum("v"), "hi": F.max("v"), "lo": F.min("v"), "d": F.count_distinct("v")})
    cols = ["k", "window_end", "n", "s", "hi", "lo", "d"]
    assert content(panes, *cols) == content(direct, *cols)


def test_sketches_are_close(spark):
    df = spark.range(20_000).select(F.lit(1).alias("k"), F.col("id"), F.timestamp_seconds(F.col("id") % 3000).alias("ts"))
    for r in T.paned(df, ["k"], 3600, 600, {"d": T.distinct_sketch("id"), "n": T.count_all()}).collect():
        assert abs(r.d - r.n) <= 3 * 0.0163 * r.n + 1


def test_lists_break_ties_by_id(spark):
    df = spark.createDataFrame([(1, 5, 2.0), (1, 3, 2.0), (1, 9, 7.0), (1, 9, 1.0), (1, 8, 0.5)], "u int, i int, s double")
    assert [(x.id, x.score) for x in topk.scored_list(df, ["u"], "i", "s", 3, "x").first().x] == [(9, 7.0), (3, 2.0), (5, 2.0)]
    new = spark.createDataFrame([(1, 2, 50), (1, 3, 30)], "left int, right int, score int")
    old = spark.createDataFrame([(1, 2, 90), (1, 4, 45), (1, 5, 10), (2, 9, 40)], "left int, right int, score int")
    assert content(topk.merge_top(new, old, "left", "right", "score", 2), "left", "right", "score", "rank") == [(1, 2, 50, 1), (1, 4, 45, 2), (2, 9, 40, 1)]


def test_skew_reports(spark):
    df = spark.range(6000).select(F.when(F.col("id") < 4000, 0).otherwise(F.col("id") % 50 + 1).alias("k"), F.timestamp_seconds(F.col("id") % 60).alias("ts"), "id")
    assert [r.k for r in skew.hot_keys(df, "k").collect()] == [0]
    assert [r.k for r in skew.window_shares(df, "k", share=0.6).collect()] == [0]
    assert skew.partition_skew(df.repartition(4)).first().skewed is False
    assert skew.partition_skew(df.repartition(4, "k")).first().skewed is True
    plain = {r.k: r.n for r in df.groupBy("k").agg(F.count("*").alias("n")).collect()}
    assert {r.k: r.n for r in skew.salted(df, ["k"], {"n": F.count("*")}, {"n": F.sum("n")}, 10, "id").collect()} == plain
