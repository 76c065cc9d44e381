"""Every registered query against the SQL that states its result, at the smallest scale."""

import pytest

from tidemark.plans.registry import QUERIES, SQL


def rows(frame):
    cols = sorted(frame.columns)
    return sorted(map(tuple, frame[cols].astype(str).values.tolist())), cols


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, sf, duck, name):
    got, want = QUERIES[name](spark, sf).toPandas(), duck.sql(SQL[name]).df()
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


#: Columns of one value by their meaning.
FIXED = {
    "exposure_device_rows": {"dest_index", "Lang"}, "item_feature_records": {"ttl_s"}, "user_author_records": {"ttl_s"}, "listed_anchors": {"flag"}, "prompt_refusals": {"rec_token"},
    "scalar_values": {"n_ids"}, "live_room_exposures": {"exposures"}, "window_key_shares": {"kind"}, "hot_keys": {"key", "n", "mean"},
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_column_is_constant(spark, name):
    """At the scale of the correctness check every column of every query takes several values."""
    import os

    sf = "/root/testdata/sf0.01"
    if not os.path.isdir(sf):
        pytest.skip("no test data")
    df = QUERIES[name](spark, sf)
    seen = df.selectExpr(*[f"min(cast(`{c}` as string)) != max(cast(`{c}` as string)) as `{c}`" for c in df.columns]).first()
    assert {c for c in df.columns if not seen[c]} <= FIXED.get(name, set())


def test_sketches_are_near_the_exact_counts(spark, sf):
    """Row by row within three standard errors of a sketch of 2 ** 12 registers (1.04 / 64 each) and one unit."""
    from tidemark.operators import aggregates as A
    from tidemark.operators import windows as T
    from tidemark.plans.domain import events

    names = list(A.item_conditions())
    got = QUERIES["item_window_sketches"](spark, sf).toPandas().set_index(["post_id", "window_end"]).sort_index()
    exact = T.distinct_windows(events(spark, sf), ["post_id"], "24 hours", "30 minutes", "rec_token", A.item_conditions()).selectExpr("post_id", "unix_seconds(window_end) as window_end", *[f"`{n}`" for n in names])
    exact = exact.toPandas().set_index(["post_id", "window_end"]).sort_index()
    assert got.index.equals(exact.index) and len(got) > 1000
    assert ((got[names] - exact[names]).abs() <= 3 * 1.04 / 64 * exact[names] + 1).all().all()
