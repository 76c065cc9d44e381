"""Client events in one pass: the log is read once, with the rows of the families' own parsers."""

import pytest

from tidemark.operators import parse
from tidemark.plans.feature_queries import _client_log, _refusal_log
from tidemark.plans.registry import QUERIES


@pytest.mark.parametrize("name, reads", [("parsed_client_posts", 1), ("client_views", 2)])
def test_events_are_read_once_a_log(spark, sf, name, reads):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == reads


def test_one_pass_gives_what_the_families_give(spark, sf):
    log = _client_log(spark, sf).unionByName(parse.client_log(_refusal_log(spark, sf)))
    odd = [("postExposure", '{"userId":1,"posts":[{"post_id":"x","item_type":1},null,{"post_id":"7","item_type":1,"post_type":1,"exposed_pos":1}]}'), ("postShare", "{"), ("collect_page_click", '{"userId":1,"source":0,"action_type":1}'), ("imagePlay", '{"userId":null,"list":null}'), ("prompt_recommendation_click_no", '{"userId":"z","post_id":"4"}')]
    log = log.unionByName(spark.createDataFrame([(e, d, 0) for e, d in odd], "event string, data string, uid long").selectExpr("event", "data", "uid", "timestamp'2024-01-01' as ts"))
    want = parse.client_lists(log).unionByName(parse.client_singles(log)).unionByName(parse.client_collects(log)).unionByName(parse.refusals_as_posts(parse.prompt_no(log)))
    got = parse.client_posts(log, refusals=True)
    assert dict(got.dtypes) == dict(want.dtypes)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
