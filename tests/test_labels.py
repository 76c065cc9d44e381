"""Labels by share of standing time where tags tie."""

import duckdb
from pyspark.sql import functions as F

from tidemark.operators import labels
from tidemark.plans.feature_queries import SHARE_SQL
from tidemark.plans.registry import QUERIES


def test_of_equal_times_the_tag_of_smallest_rank_is_the_label(spark):
    rows = [(1, "mid", 1), (1, "high", 2), (2, "high", 1), (2, "mid", 2), (3, "explicit", 2), (3, "mid", 1), (4, "mid", 2), (4, "explicit", 1)]
    v = spark.createDataFrame(rows, "uid long, tag string, rank int").withColumns({"standing_time": F.lit(45.84), "interactions": F.array().cast("array<int>")})
    got = {r.uid: r.label for r in labels.share_label(v, 0.3, rank="rank").collect()}
    assert got == {1: "u_ylevel_mid", 2: "u_ylevel_high", 3: "u_ylevel_mid", 4: "u_ylevel_explicit"}


def test_share_labels_with_ties_equal_the_sql_in_row_order(spark, tmp_path):
    """Two views of equal times a user; on one thread DuckDB meets the tag seen last first, and keeps it."""
    rows = [(2 * u + i, 60 * (2 * u + i), u, "view", 90.0, f'{{"k": {(u * 7 + i * (1 + u % 4)) % 5}}}') for u in range(40) for i in range(2)]
    e = spark.createDataFrame(rows, "event_id long, s long, user_id long, event_type string, value double, props string")
    e = e.withColumn("value", F.when(F.col("event_id") % 4 == 0, F.col("value") * 32).otherwise(F.col("value")))
    e.select("event_id", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value", "props").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    con = duckdb.connect(config={"threads": 1})
    con.sql(f"create view events as from '{tmp_path}/events.parquet/*.parquet'")
    want = sorted(con.sql(SHARE_SQL).fetchall())
    assert sorted(map(tuple, QUERIES["share_labels"](spark, str(tmp_path)).collect())) == want and len(want) == 40
