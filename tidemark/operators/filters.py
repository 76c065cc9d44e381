"""Predicates on raw JSON text and on parsed rows. All are columns: the cheap ones run before any JSON is parsed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import c


def maybe_event_type(value, *types: int) -> Column:
    """Text holds ``"event_type":N`` for one of the types, N not followed by a digit; blanks after the colon are allowed."""
    return c(value).rlike(r'"event_type"\s*:\s*(' + "|".join(str(t) for t in types) + r")(?![0-9])")


def event_type(value) -> Column:
    """The event type of a JSON text, -1 if there is none."""
    return F.coalesce(F.get_json_object(c(value), "$.event_type").try_cast("int"), F.lit(-1))


def is_event_type(value, *types: int) -> Column:
    """Exact test, behind the cheap one."""
    return maybe_event_type(value, *types) & event_type(value).isin(*types)


def valid_ids(*cols: str) -> Column:
    """All are present and above 0."""
    out = F.lit(True)
    for x in cols:
        out = out & F.coalesce(c(x) > 0, F.lit(False))
    return out


def tag_is_fresh(access_level, access_time, as_of, hours: int = 24, low: int = 10, high: int = 30) -> Column:
    """Access level within [low, high] and set at most ``hours`` before ``as_of`` (epoch seconds)."""
    return c(access_level).between(low, high) & (c(as_of) - c(access_time) <= hours * 3600)


def post_is_fresh(created_at, deleted_at, as_of, days: int = 6) -> Column:
    """Not deleted and at most ``days`` old at ``as_of`` (epoch seconds)."""
    return (F.coalesce(c(deleted_at), F.lit(0)) <= 0) & (c(as_of) - c(created_at) <= days * 86400)


def is_client_post(item: Column | None = None) -> Column:
    """An item of a client event that counts: a post, image or video, in the second position, with a token."""
    f = (lambda n: item[n]) if item is not None else F.col
    return (f("item_type") == 1) & f("post_type").isin(1, 2) & (f("exposed_pos") == 2) & (F.coalesce(f("rec_token"), F.lit("")) != "")


def scene_of(event, scene="scene", from_scene="from_scene") -> Column:
    """The scene that counts: where a viewer came from for enter and exit, else the scene."""
    return F.when(c(event).isin("enter_liveroom", "exit_liveroom"), c(from_scene)).otherwise(c(scene))


def in_scene(event, scene="scene", from_scene="from_scene", scenes: tuple[int, ...] = (1, 3, 4, 5)) -> Column:
    return scene_of(event, scene, from_scene).isin(*scenes)


def not_empty(collection) -> Column:
    return F.coalesce(F.size(c(collection)) > 0, F.lit(False))


def at_least(df: DataFrame, score: str, least: float) -> DataFrame:
    return df.filter(F.col(score) >= least)
