"""Scalar functions over columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Weights of actions in an interest score.
ACTION_SCORES = {"click": 1, "long_view": 6, "like": 4, "follow": 8, "profile": 4, "favorite": 4, "comment": 4, "forward": 8, "share": 8, "download": 5}
#: Sensitivity levels and cooldown days by stage.
LEVELS = {"explicit": 3, "high": 2, "mid": 1}
COOLDOWN_DAYS, BLOCK_COOLDOWN_DAYS = (3, 7, 14), (1, 3, 7)


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _tags(tags) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(c(tags), F.lit("")), ","), lambda t: F.trim(t)), lambda t: t != "")


def sensitivity_tag(tags, levels: tuple[str, ...] = ("clean", "explicit", "mid", "high")) -> Column:
    """The value of the first ``restricted#value`` among comma-separated tags, if it is one of ``levels``, else ``unk``."""
    hit = F.get(F.filter(_tags(tags), lambda t: t.startswith("restricted#")), F.lit(0))
    value = F.element_at(F.split(hit, "#"), 2)
    return F.coalesce(F.when(value.isin(*levels), value), F.lit("unk"))


def prioritized_tag(tags) -> Column:
    """``restricted#explicit`` if present, else the first tag with ``content`` in it, else null."""
    t = _tags(tags)
    return F.coalesce(F.when(F.array_contains(t, "restricted#explicit"), F.lit("restricted#explicit")), F.get(F.filter(t, lambda x: x.contains("content")), F.lit(0)))


def tag_level(tag) -> Column:
    out = F.lit(0)
    for name, level in LEVELS.items():
        out = F.when(c(tag) == name, level).otherwise(out)
    return out


def label_text(tag) -> Column:
    return F.concat(F.lit("u_ylevel_"), c(tag))


def half_life(score, hours, half: float) -> Column:
    """score * 0.5 ** (hours / half)."""
    return c(score) * F.pow(F.lit(0.5), c(hours) / F.lit(float(half)))


def sigmoid(x) -> Column:
    return 1 / (1 + F.exp(-c(x)))


def net_weight(net, mode: str = "reference") -> Column:
    """Weight of a net score. ``reference``: 1 + s(net) above 0, s(-net) below (nearer to 1 the stronger the
    dislike), 1 at 0; ``monotone``: s(net)."""
    if mode == "monotone":
        return sigmoid(net)
    n = c(net)
    return F.when(n > 0, 1 + sigmoid(n)).when(n < 0, sigmoid(-n)).otherwise(F.lit(1.0))


def net_from_weight(weight, limit: float = 3.0, edge: float = 0.01) -> Column:
    """Inverse of the ``reference`` weight as it is read back: (1, 2] by the logit of weight - 1, [0, 1) by the negative
    logit of the weight; +-limit within ``edge`` of an end, 0 for any other weight."""
    w = c(weight)
    logit = lambda p: -F.log(1 / p - 1)
    inner = lambda p: (p > edge) & (p < 1 - edge)
    up = F.when(inner(w - 1), logit(w - 1)).otherwise(F.lit(float(limit)))
    down = F.when(inner(w), -logit(w)).otherwise(F.lit(-float(limit)))
    return F.when((w > 1) & (w <= 2), up).when((w >= 0) & (w < 1), down).otherwise(F.lit(0.0))


def step_decay(score, minutes, base: float = 0.96, step: float = 2.0) -> Column:
    """round(score * base ** (minutes / step)), halves up."""
    return F.floor(c(score) * F.pow(F.lit(base), c(minutes) / F.lit(step)) + 0.5).cast("long")


def stored_pair(text) -> tuple[Column, Column]:
    """score and minute of ``score:minute``."""
    t = c(text)
    return F.split_part(t, F.lit(":"), F.lit(1)).try_cast("long"), F.split_part(t, F.lit(":"), F.lit(2)).try_cast("long")


def action_score(flags: dict[str, Column], scores: dict[str, int] = ACTION_SCORES) -> Column:
    """Sum of the scores of the actions whose flag is true."""
    out = F.lit(0)
    for name, flag in flags.items():
        out = out + F.when(flag, scores[name]).otherwise(0)
    return out.cast("long")


def next_local_hour(ts, hour: int = 20, zone: str = "Asia/Kolkata") -> Column:
    """The next ``hour``:00 in ``zone``: of the same day if strictly before it, else of the next day."""
    local = F.from_utc_timestamp(c(ts), zone)
    day = F.date_trunc("day", local)
    at = day + F.expr(f"INTERVAL {hour} HOURS")
    return F.to_utc_timestamp(F.when(local < at, at).otherwise(at + F.expr("INTERVAL 1 DAY")), zone)


def cooldown_days(user_type, stage) -> Column:
    """Days of a cooling stage (1 to 3); block users have shorter ones."""
    s = F.least(F.greatest(c(stage), F.lit(1)), F.lit(3))
    pick = lambda days: F.element_at(F.array(*[F.lit(d) for d in days]), s.cast("int"))
    return F.when(c(user_type) == "block", pick(BLOCK_COOLDOWN_DAYS)).otherwise(pick(COOLDOWN_DAYS))


def stage_distribution(stage) -> Column:
    """How many mid and high items a stage allows, as text (fixed values)."""
    return F.when(c(stage) == "probing_mid", "mid2_high0").when(c(stage) == "probing_high", "mid1_high1").when(c(stage) == "stable", "mid0_high2").otherwise("mid1_high0")


def flow_text(version: str, **parts) -> Column:
    """``version;name=value;...``."""
    return F.concat_ws(";", F.lit(version), *[F.concat(F.lit(f"{k}="), F.coalesce(c(v).cast("string"), F.lit(""))) for k, v in parts.items()])


def flow_value(text, name: str) -> Column:
    return F.element_at(F.str_to_map(c(text), F.lit(";"), F.lit("=")), name)


def label_record(label, ids, ts) -> Column:
    """``label|sorted ids|timestamp``."""
    return F.concat_ws("|", c(label), F.array_join(F.transform(F.array_sort(c(ids)), lambda x: x.cast("string")), ","), c(ts).cast("string"))


def parse_label_record(text) -> Column:
    p = F.split(c(text), r"\|")
    ids = F.filter(F.transform(F.split(F.get(p, F.lit(1)), ","), lambda x: x.try_cast("long")), lambda x: x.isNotNull())
    return F.struct(F.get(p, F.lit(0)).alias("label"), ids.alias("ids"), F.get(p, F.lit(2)).try_cast("long").alias("ts"))


def timed_posts_text(items) -> Column:
    """``post|time,post|time`` from structs (post_id, time)."""
    return F.array_join(F.transform(c(items), lambda x: F.concat_ws("|", x["post_id"].cast("string"), x["time"].cast("string"))), ",")


def history_items(text, now_ms, max_hours: int = 24, k: int = 50) -> Column:
    """Array of (id, ts, weight) from a JSON array of objects (``itemId`` or ``item_id``, ``ts``, ``weight``) or from
    ``id|..,id|..``; bare ids in a JSON array count too. Missing times are ``now_ms``, missing weights 1. Items older
    than ``max_hours`` go, the rest come latest first, each id once, ``k`` at most."""
    t, now = F.trim(c(text)), c(now_ms).cast("long")
    item = lambda ident, ts, w: F.struct(ident.alias("id"), F.coalesce(ts, now).alias("ts"), F.coalesce(w, F.lit(1.0)).alias("weight"))
    field = lambda x, name: F.get_json_object(x, f"$.{name}")

    def read(x: Column) -> Column:
        ident = F.coalesce(F.when(x.startswith("{"), F.coalesce(field(x, "itemId"), field(x, "item_id"))).otherwise(x).try_cast("long"), F.lit(0).cast("long"))
        return item(ident, F.when(x.startswith("{"), field(x, "ts").try_cast("long")), F.when(x.startswith("{"), field(x, "weight").try_cast("double")))

    listed = F.transform(F.from_json(t, "array<string>"), read)
    none = F.lit(None)
    plain = F.transform(F.split(t, ","), lambda x: item(F.coalesce(F.trim(F.split_part(x, F.lit("|"), F.lit(1))).try_cast("long"), F.lit(0).cast("long")), none.cast("long"), none.cast("double")))
    got = F.coalesce(F.when(t.startswith("["), F.coalesce(listed, plain)).otherwise(plain), F.array().cast("array<struct<id:bigint,ts:bigint,weight:double>>"))
    fresh = F.filter(got, lambda x: (x["id"] > 0) & (now - x["ts"] <= max_hours * 3_600_000))
    # latest first; equal times keep their places
    placed = F.transform(fresh, lambda x, i: F.struct((-x["ts"]).alias("o"), i.alias("i"), x.alias("x")))
    in_order = F.transform(F.array_sort(placed), lambda z: z["x"])
    first = F.filter(in_order, lambda x, i: F.array_position(F.transform(in_order, lambda y: y["id"]), x["id"]) == i + 1)
    return F.slice(first, 1, k)


def history_ids(text) -> Column:
    """The ids of :func:`history_items`, their times not judged."""
    return F.transform(history_items(text, F.lit(0), max_hours=1 << 40), lambda x: x["id"])


def int32_only(ids) -> Column:
    """Ids within 32 bits (an optional guard for narrow stores)."""
    return F.filter(c(ids), lambda x: x.between(-(2**31), 2**31 - 1))


def feature_key(prefix: str, ident, suffix: str = "") -> Column:
    """``prefix{id}suffix``."""
    return F.concat(F.lit(prefix), c(ident).cast("string"), F.lit(suffix))
