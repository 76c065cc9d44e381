from datetime import datetime

from pyspark.sql import functions as F

from tidemark.functions import scalars as X


def one(spark, *cols):
    return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first())


def test_tags(spark):
    t = lambda s: F.lit(s)
    assert one(spark, *[X.sensitivity_tag(t(s)) for s in ("a#b,restricted#mid", "restricted#other", "a#b", None, "")]) == ("mid", "unk", "unk", "unk", "unk")
    assert one(spark, *[X.prioritized_tag(t(s)) for s in ("content#a, restricted#explicit", "x, content#b,content#c", "x", None)]) == ("restricted#explicit", "content#b", None, None)


def test_weights_and_their_inverse(spark):
    nets = [-2.0, -0.5, 0.0, 0.5, 2.0]
    back = one(spark, *[X.net_from_weight(X.net_weight(F.lit(n))) for n in nets])
    # a dislike's weight s(-net) above one half comes back as its mirror image
    assert [round(abs(b), 6) for b in back] == [abs(n) for n in nets]
    assert one(spark, X.net_from_weight(F.lit(2.0)), X.net_from_weight(F.lit(0.0))) == (3.0, -3.0)
    # logits beyond 3 stay; the limit holds within a hundredth of an end; other weights are balanced
    got = one(spark, *[X.net_from_weight(F.lit(w)) for w in (1.98, 1.995, 0.02, 0.995, 1.0, 2.5, -1.0)])
    assert [round(x, 4) for x in got] == [3.8918, 3.0, 3.8918, -3.0, 0.0, 0.0, 0.0]


def test_alignment(spark):
    at = lambda s: X.next_local_hour(F.lit(s).cast("timestamp"))
    got = one(spark, at("2024-01-18 02:00:00"), at("2024-01-18 14:30:00"), at("2024-01-18 14:29:59"))
    assert got == (datetime(2024, 1, 18, 14, 30), datetime(2024, 1, 19, 14, 30), datetime(2024, 1, 18, 14, 30))


def test_records_round_trip(spark):
    r = X.label_record(F.lit("u_ylevel_mid"), F.array(F.lit(9), F.lit(2)), F.lit(5))
    assert one(spark, r)[0] == "u_ylevel_mid|2,9|5"
    p = one(spark, X.parse_label_record(r))[0]
    assert (p.label, p.ids, p.ts) == ("u_ylevel_mid", [2, 9], 5)


def test_history_forms(spark):
    got = one(spark, *[X.history_ids(F.lit(s)) for s in ('[1,"2",0]', "3|1,4|2,x", "", None)])
    assert [list(g) for g in got] == [[1, 2], [3, 4], [], []]


def test_history_objects(spark):
    text = '[{"itemId":5,"ts":1000,"weight":1.5},{"item_id":"7"},{"itemId":5,"ts":2000},{"itemId":0},{"ts":3},{"itemId":9,"ts":-90000000}]'
    (got,) = one(spark, X.history_items(F.lit(text), F.lit(5000)))
    assert [(x.id, x.ts, x.weight) for x in got] == [(7, 5000, 1.0), (5, 2000, 1.0)]
    (ids,) = one(spark, X.history_ids(F.lit('[{"itemId":5},{"item_id":7},{"itemId":5}]')))
    assert ids == [5, 7]


def test_small_ones(spark):
    got = one(spark, X.step_decay(F.lit(100), F.lit(2)), X.cooldown_days(F.lit("block"), F.lit(9)), X.cooldown_days(F.lit("x"), F.lit(0)), X.half_life(F.lit(8.0), F.lit(12), 6), X.flow_value(X.flow_text("v5", a=F.lit(1), b=F.lit("z")), "b"))
    assert got == (96, 7, 3, 2.0, "z")
