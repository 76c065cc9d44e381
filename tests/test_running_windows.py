"""Windows by running sums: no row is copied into windows before it is grouped, and odd rows count as in plain windows."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import aggregates as A
from tidemark.operators import windows as T
from tidemark.plans.registry import QUERIES


@pytest.mark.parametrize("name", ["user_author_hour", "user_hour_counts", "user_anchor_quarter", "anchor_window_counts", "session_user_day", "user_live_hour", "capped_user_authors", "user_author_day"])
def test_nothing_is_grouped_after_rows_are_copied_into_windows(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    copied = next(i for i, line in enumerate(plan.splitlines()) if "Generate explode(sequence(" in line)
    assert not any("Aggregate" in line or "Repartition" in line for line in plan.splitlines()[:copied])


def _odd(spark):
    r = random.Random(3)
    pick = lambda *x: r.choice(x)
    rows = [(i, pick(1, 1, 2, None), pick("a", "b", "c", None), pick(0, 2, 5, None), pick(True, False, None), None if i % 50 == 0 else 1_700_000_000 + r.randrange(9000) // pick(1, 60) * pick(1, 60)) for i in range(400)]
    return spark.createDataFrame(rows, "event_id long, k long, v string, x long, hit boolean, s long").withColumn("ts", F.timestamp_seconds("s"))


@pytest.mark.parametrize("many", [False, True])
def test_nulls_count_as_in_plain_windows(spark, many):
    d = _odd(spark)
    conds = {"all": F.lit(True), "hits": F.col("hit"), "big": F.col("x") > 1}
    got = T.distinct_windows(d, ["k"], "10 minutes", "1 minute", "v", conds, sums={"total": F.col("x")}, many=many, spanned=True)
    aggs = {n: F.count_distinct(F.when(c, F.col("v"))) for n, c in conds.items()} | {"total": F.sum("x"), "first_ts": F.min("ts"), "last_ts": F.max("ts")}
    want = T.windowed(d, ["k"], "10 minutes", "1 minute", aggs)
    show = lambda df: sorted(map(str, df.select("k", "window_start", "window_end", *aggs).collect()))
    assert show(got) == show(want)


def test_whole_sums_by_panes(spark):
    d = _odd(spark)
    aggs = {"n": F.count("*"), "total": F.sum("x"), "hits": F.count_if("hit")}
    got = T.paned(d, ["k"], 600, 60, {n: T.Agg(a) for n, a in aggs.items()})
    want = T.windowed(d, ["k"], "10 minutes", "1 minute", aggs)
    show = lambda df: sorted(map(str, df.select("k", "window_end", *aggs).collect()))
    assert show(got) == show(want)


def test_capped_rows(spark):
    d = _odd(spark).filter("k is not null and ts is not null")
    conds = {"all": F.lit(True), "hits": F.col("hit")}
    got = T.distinct_windows(T.capped(d, ["k"], 5, 600, 60, ["ts", "event_id"]), ["k", "x"], "10 minutes", "1 minute", "v", conds)
    few = A.capped_windows(d, "10 minutes", "1 minute", 5, "k")
    want = few.groupBy("k", "x", "window_end").agg(*[F.count_distinct(F.when(c, F.col("v"))).alias(n) for n, c in conds.items()])
    show = lambda df: sorted(map(str, df.select("k", "x", "window_end", *conds).collect()))
    assert show(got) == show(want)


def _sketched(spark):
    return {"v": T.distinct_sketch("v"), "hits": T.distinct_sketch("v", F.col("hit")), "n": T.count_all(), "total": T.sum_of("x"), "most": T.max_of("x"), "least": T.min_of("x")}


@pytest.mark.parametrize("cap", [None, 5])
@pytest.mark.parametrize("size", [60, 600, 1800])
def test_windows_of_sketches_equal_plain_windows(spark, cap, size):
    """Sketches of few values are exact; capped rows enter windows late."""
    d = _odd(spark).filter("k is not null and ts is not null")
    rows = d if cap is None else T.capped(d, ["k"], cap, size, 60, ["ts", "event_id"])
    got = T.paned(rows, ["k"], size, 60, _sketched(spark))
    plain = T.assign(d, f"{size} seconds", "60 seconds")
    plain = plain if cap is None else T.first_events(plain, ["k", "window_end"], cap, ["ts", "event_id"])
    want = plain.groupBy("k", "window_end").agg(F.count_distinct("v").alias("v"), F.count_distinct(F.when(F.col("hit"), F.col("v"))).alias("hits"), F.count("*").alias("n"), F.sum("x").alias("total"), F.max("x").alias("most"), F.min("x").alias("least"))
    show = lambda df: sorted(map(str, df.select("k", "window_end", *_sketched(spark)).collect()))
    assert show(got) == show(want) and want.count() > 10


def test_sketches_are_not_copied_into_windows(spark, sf):
    """Nothing is sorted or grouped behind the step that writes windows out."""
    plan = QUERIES["item_window_sketches"](spark, sf)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    copied = [i for i, line in enumerate(plan) if "Generate explode" in line]
    assert len(copied) == 2 and not any("Aggregate" in line or "Repartition" in line for line in plan[: copied[0]])


@pytest.mark.parametrize("name", ["user_scored_lists", "user_action_lists", "capped_user_lists"])
def test_lists_are_made_once_for_windows_that_share_them(spark, sf, name):
    """Texts of lists are joined behind no step that writes windows out."""
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    windows = next(i for i, line in enumerate(plan) if "Generate explode(sequence(" in line)
    assert not any("array_join" in line or "Filter" in line for line in plan[:windows])
    assert any("array_join" in line for line in plan[windows:])


@pytest.mark.parametrize("cap", [None, 5])
@pytest.mark.parametrize("size", [60, 600])
def test_lists_equal_those_of_plain_windows(spark, cap, size):
    d = _odd(spark).filter("k is not null and ts is not null and x is not null").withColumn("id", F.col("event_id") % 9)
    rows = d if cap is None else T.capped(d, ["k"], cap, size, 60, ["ts", "event_id"])
    text = lambda items: F.array_join(F.transform(items, lambda x: F.concat_ws(":", x["id"].cast("string"), x["value"].cast("string"))), ",")
    got = T.list_windows(rows, ["k"], size, 60, "id", F.col("x"), 3, 3, show=text)
    plain = T.assign(d, f"{size} seconds", "60 seconds")
    plain = plain if cap is None else T.first_events(plain, ["k", "window_end"], cap, ["ts", "event_id"])
    best = plain.groupBy("k", "window_end", "id").agg(F.max("x").alias("x"))
    ordered = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("x")).alias("o"), "id"))), 1, 3)
    want = best.groupBy("k", "window_end").agg(ordered.alias("a")).select("k", "window_end", text(F.transform("a", lambda y: F.struct(y["id"].alias("id"), (-y["o"]).alias("value")))).alias("items"))
    show = lambda df: sorted(map(str, df.select("k", "window_end", "items").collect()))
    assert show(got) == show(want) and want.count() > 10
