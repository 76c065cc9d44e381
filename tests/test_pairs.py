"""Pair totals: one group a pair, not one a pair and window, with the same sums."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cf
from tidemark.plans.domain import events
from tidemark.plans.feature_queries import _history
from tidemark.plans.registry import QUERIES


@pytest.mark.parametrize("name", ["cf_index", "weighted_pairs"])
def test_pairs_are_not_grouped_by_window(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    grouped = [line.split("[", 1)[1].split("]")[0] for line in plan.splitlines() if "Aggregate [" in line]
    assert not any("left#" in g and "window" in g for g in grouped)


def test_totals_are_the_windows_summed(spark, sf):
    s, h = cf.session_scores(events(spark, sf)), _history(spark, sf)
    want = cf.pair_scores(s, h).groupBy("left", "right").agg(F.sum("score").alias("score"))
    assert sorted(cf.pair_totals(s, h).collect()) == sorted(want.collect())
