"""Event-time windows, in batch and in streams.

:func:`windowed` assigns rows to Spark's own windows and works in both. :func:`paned` is for batches with long
windows and short slides: rows are aggregated to panes of one slide first, and only pane rows are copied into
the windows that cover them (a day that slides by 30 minutes covers 48 panes), with mergeable aggregates. Whole-number
sums and exact distinct counts aren't copied at all: :func:`running_windows` adds up what enters and leaves.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.scalars import c


@dataclass(frozen=True)
class Agg:
    """A mergeable aggregate: of rows, of partial results, and what it finally shows."""

    partial: Column
    merge: str = "sum"  # sum, max, min, hll
    finish: str | None = None  # None, hll, floor_mean

    def merged(self, name: str) -> Column:
        f = {"sum": F.sum, "max": F.max, "min": F.min, "hll": F.hll_union_agg}[self.merge]
        return f(name)

    def both(self, x: Column, y: Column) -> Column:
        """Two partial results as one; null is nothing."""
        one = {"sum": lambda: x + y, "max": lambda: F.greatest(x, y), "min": lambda: F.least(x, y), "hll": lambda: F.hll_union(x, y)}[self.merge]()
        return F.coalesce(one, x, y)


def count_if(cond: Column) -> Agg:
    return Agg(F.count_if(cond))


def count_all() -> Agg:
    return Agg(F.count("*"))


def sum_of(x) -> Agg:
    return Agg(F.sum(c(x)))


def max_of(x) -> Agg:
    return Agg(F.max(c(x)), "max")


def min_of(x) -> Agg:
    return Agg(F.min(c(x)), "min")


def distinct_sketch(x, cond: Column | None = None, log_k: int = 12) -> Agg:
    """Approximate distinct count that merges over panes."""
    return Agg(F.hll_sketch_agg(F.when(cond, c(x)) if cond is not None else c(x), log_k), "hll", "hll")


def with_watermark(df: DataFrame, delay: str, ts: str = "ts") -> DataFrame:
    """Rows later than ``delay`` behind the newest are dropped from streams; batches keep all."""
    return df.withWatermark(ts, delay) if df.isStreaming else df


def windowed(df: DataFrame, keys: list[str], size: str, slide: str | None, aggs: dict[str, Column], ts: str = "ts") -> DataFrame:
    """``keys``, window_start, window_end, aggregates. ``slide`` None: tumbling. No keys: over the whole stream."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    out = df.groupBy(*keys, w.alias("w")).agg(*[a.alias(n) for n, a in aggs.items()])
    return out.select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *aggs)


def panes_in(size_s: int, slide_s: int) -> int:
    if size_s % slide_s:
        raise ValueError("the slide must divide the size")
    return size_s // slide_s


def pane_of(ts, slide_s: int) -> Column:
    """Number of the pane, a stretch of one slide, that holds the time."""
    return F.floor(F.unix_micros(c(ts)) / F.lit(slide_s * 1_000_000)).cast("long")


def capped(df: DataFrame, keys: list[str], cap: int, size_s: int, slide_s: int, order: list[str], ts: str = "ts") -> DataFrame:
    """Rows with ``_pane`` and ``_from``: a row is among the first ``cap`` rows of its key (in ``order``, time first) in those
    of its windows that end at slide ``_from`` or later; rows that are in none go.

    A row is too late for a window exactly if the row ``cap`` places before it lies in the window too, so one running look back
    settles all windows of a row, and no row is copied. What exceeds ``cap`` in one pane goes before the shuffle, so that a
    very busy key sends ``cap`` rows a pane and task at most."""
    n = panes_in(size_s, slide_s)
    few = first_events(df.withColumn("_pane", pane_of(ts, slide_s)), [*keys, "_pane"], cap, order)
    before = F.lag("_pane", cap).over(W.partitionBy(*keys).orderBy(*order))
    first = F.greatest(F.col("_pane") + 1, F.coalesce(before + n + 1, F.col("_pane") + 1))
    return few.withColumn("_from", first).filter(F.col("_from") <= F.col("_pane") + n)


def with_panes(df: DataFrame, slide_s: int, ts: str = "ts") -> DataFrame:
    """Rows with ``_pane`` and ``_from``, the first of their windows; rows of :func:`capped` as they are."""
    if "_from" in df.columns:
        return df
    return df.withColumn("_pane", pane_of(ts, slide_s)).withColumn("_from", F.col("_pane") + 1)


def chunked(panes: DataFrame, n: int) -> DataFrame:
    """Pane rows (``_pane``, ``_from``) with ``_chunk``: the windows ending at panes c * n to c * n + n - 1 are chunk c, and a
    pane lies in windows of at most two chunks. So what a window needs is in its chunk, and rows are copied twice, not n
    times, before they are shuffled."""
    first, last = F.floor(F.col("_from") / F.lit(n)), F.floor((F.col("_pane") + n) / F.lit(n))
    return panes.withColumn("_chunk", F.explode(F.sequence(first.cast("long"), last.cast("long"))))


def chunk_ends(n: int) -> Column:
    """Ends of the pane's windows in its chunk, in slides."""
    low = F.greatest(F.col("_from"), F.col("_chunk") * n)
    return F.explode(F.sequence(low, F.least(F.col("_pane") + n, F.col("_chunk") * n + (n - 1))))


def pane_rows(df: DataFrame, keys: list[str], slide_s: int, aggs: dict[str, Agg], ts: str = "ts") -> DataFrame:
    """Partial aggregates of each key and pane. ``df`` may come from :func:`capped`."""
    return with_panes(df, slide_s, ts).groupBy(*keys, "_pane", "_from").agg(*[a.partial.alias(x) for x, a in aggs.items()])


def merged_panes(panes: DataFrame, keys: list[str], aggs: dict[str, Agg]) -> DataFrame:
    """Partial aggregates of several sources as one row a key and pane."""
    return panes.groupBy(*keys, "_pane", "_from").agg(*[a.merged(x).alias(x) for x, a in aggs.items()])


def merged_windows(panes: DataFrame, keys: list[str], size_s: int, slide_s: int, aggs: dict[str, Agg]) -> DataFrame:
    """``keys``, ``_end`` (in slides) and partial aggregates of the windows that pane rows lie in. Panes are shuffled by key and chunk;
    copies into windows are made and merged behind that shuffle; with sketches, which are large, none are (:func:`sketched_windows`)."""
    n = panes_in(size_s, slide_s)
    if n <= MOST_PANES and any(a.merge == "hll" for a in aggs.values()):
        return sketched_windows(panes, keys, n, aggs)
    spread = chunked(panes, n).repartition(*keys, "_chunk").withColumn("_end", chunk_ends(n))
    out = spread.groupBy(*keys, "_chunk", "_end").agg(*[a.merged(x).alias(x) for x, a in aggs.items()])
    return out.select(*keys, "_end", *aggs)


#: Windows of more panes than this don't hold a chunk's sketches in one row.
MOST_PANES = 256


def _running(rows: Column, aggs: dict[str, Agg]) -> Column:
    """Each of an array's rows (``_at``, partial aggregates) merged with those before it."""

    def more(done: Column, x: Column) -> Column:
        before = F.get(done, F.size(done) - 1)
        return F.concat(done, F.array(F.struct(x["_at"].alias("_at"), *[a.both(before[n], x[n]).alias(n) for n, a in aggs.items()])))

    return F.aggregate(rows, F.slice(rows, 1, 0), more)


def sketched_windows(panes: DataFrame, keys: list[str], n: int, aggs: dict[str, Agg]) -> DataFrame:
    """:func:`merged_windows` with three merges a pane instead of ``n``, and no copies of sketches to sort or spill.

    A window of chunk c covers the last panes before c * n and the first from there on. The former only leave in the course of the chunk
    and the latter only enter, so both are running merges, from the middle backwards and onwards, and a window merges one of each. Capped rows that
    do both in one chunk are merged window by window. A task holds the sketches of one key's 2 * ``n`` panes and their running merges."""
    row = F.struct("_pane", "_from", *aggs)
    per = chunked(panes, n).repartition(*keys, "_chunk").groupBy(*keys, "_chunk").agg(F.collect_list(row).alias("_all"))
    middle = F.col("_chunk") * n
    at = lambda x, by: F.struct(x[by].alias("_at"), *[x[a].alias(a) for a in aggs])
    leaving = F.transform(F.filter("_all", lambda x: x["_from"] <= middle), lambda x: at(x, "_pane"))
    entering = F.transform(F.filter("_all", lambda x: (x["_from"] > middle) & (x["_pane"] >= middle - 1)), lambda x: at(x, "_from"))
    inside = F.filter("_all", lambda x: (x["_from"] > middle) & (x["_pane"] < middle - 1))
    parts = F.struct(_running(F.sort_array(leaving, asc=False), aggs).alias("l"), _running(F.sort_array(entering), aggs).alias("e"), inside.alias("i"))
    last = lambda rows: F.get(rows, F.size(rows) - 1)

    def window(r: Column, end: Column) -> Column:
        both = F.struct(last(F.filter(r["l"], lambda x: x["_at"] >= end - n)).alias("l"), last(F.filter(r["e"], lambda x: x["_at"] <= end)).alias("e"), F.filter(r["i"], lambda x: (x["_from"] <= end) & (x["_pane"] >= end - n)).alias("i"))

        def merged(b: Column) -> Column:
            start = F.struct(*[a.both(b["l"][x], b["e"][x]).alias(x) for x, a in aggs.items()])
            found = F.aggregate(b["i"], start, lambda m, y: F.struct(*[a.both(m[x], y[x]).alias(x) for x, a in aggs.items()]))
            return F.when(b["l"].isNotNull() | b["e"].isNotNull() | (F.size(b["i"]) > 0), F.struct(end.alias("_end"), found.alias("_m")))

        return F.get(F.transform(F.array(both), merged), F.lit(0))

    ends = F.sequence(middle, middle + (n - 1))
    # a lambda each, so that nothing is computed twice
    windows = F.get(F.transform(F.array(parts), lambda r: F.array_compact(F.transform(ends, lambda end: window(r, end)))), F.lit(0))
    return per.select(*keys, F.explode(windows).alias("_w")).select(*keys, "_w._end", *[F.col("_w._m")[x].alias(x) for x in aggs])


def finished_windows(merged: DataFrame, keys: list[str], slide_s: int, aggs: dict[str, Agg]) -> DataFrame:
    """``keys``, window_end and what the aggregates finally show."""
    done = [(F.coalesce(F.hll_sketch_estimate(x), F.lit(0)) if a.finish == "hll" else F.col(x)).alias(x) for x, a in aggs.items()]
    return merged.select(*keys, F.timestamp_seconds(F.col("_end") * slide_s).alias("window_end"), *done)


def running_windows(steps: DataFrame, keys: list[str], names: dict[str, Column], spanned: bool = False) -> DataFrame:
    """``keys``, ``_end`` (in slides) and sums of ``names`` for the windows in which something lies. A step (keys, ``_at``, ``_step``) enters
    (1) from the windows ending at ``_at`` on, or leaves (-1); ``names`` say what it adds to a sum. The running total of the steps holds
    until the next one, so windows are written out in order and never held or grouped: memory is that of sorting the steps,
    whatever the number of windows. ``spanned``: also ``first_ts`` and ``last_ts``, from the steps' ``ts``."""
    steps = steps.repartition(*keys)
    w = W.partitionBy(*keys).orderBy("_at")
    extra = {}
    if spanned:  # the earliest to leave after a window's end, and the latest to enter
        back = W.partitionBy(*keys).orderBy(F.desc("_at")).rangeBetween(W.unboundedPreceding, -1)
        steps = steps.withColumn("_first", F.min(F.when(F.col("_step") < 0, F.col("ts"))).over(back))
        extra = {"first_ts": F.col("_first"), "last_ts": F.max(F.when(F.col("_step") > 0, F.col("ts"))).over(w)}
    # sorted before the sums' inputs are made, so that the sort holds narrow rows
    steps = steps.sortWithinPartitions(*keys, "_at")
    totals = steps.select(*keys, "_at", F.sum("_step").over(w).alias("_n"), F.lead("_at").over(w).alias("_next"), *[F.sum(x).over(w).alias(n) for n, x in names.items()], *[x.alias(n) for n, x in extra.items()])
    held = totals.filter((F.col("_n") > 0) & (F.col("_next") > F.col("_at")))
    return held.select(*keys, F.explode(F.sequence("_at", F.col("_next") - 1)).alias("_end"), *names, *extra)


def _whole(panes: DataFrame, aggs: dict[str, Agg]) -> bool:
    """All aggregates are sums of whole numbers, from which what leaves a window can be taken off exactly."""
    types = dict(panes.dtypes)
    return all(a.merge == "sum" and a.finish is None and types[n] in ("bigint", "int", "smallint", "tinyint") for n, a in aggs.items())


def summed_windows(panes: DataFrame, keys: list[str], size_s: int, slide_s: int, aggs: dict[str, Agg]) -> DataFrame:
    """:func:`merged_windows` of whole-number sums by :func:`running_windows`."""
    n = panes_in(size_s, slide_s)
    step = lambda at, sign: F.struct(at.alias("_at"), F.lit(sign).alias("_step"), *[(F.col(x) * sign).alias(x) for x in aggs])
    both = F.array(step(F.col("_from"), 1), step(F.col("_pane") + (n + 1), -1))
    steps = panes.filter(F.col("_pane").isNotNull()).select(*keys, F.explode(both).alias("_s")).select(*keys, "_s.*")
    # a sum over nulls alone is null, also after others have left
    known = {f"_known_{x}": F.when(F.col(x).isNotNull(), F.col("_step")).otherwise(0) for x in aggs if panes.schema[x].nullable}
    out = running_windows(steps, keys, {x: F.col(x) for x in aggs} | known)
    return out.select(*keys, "_end", *[(F.when(F.col(f"_known_{x}") > 0, F.col(x)) if f"_known_{x}" in known else F.col(x)).alias(x) for x in aggs])


def pane_windows(panes: DataFrame, keys: list[str], size_s: int, slide_s: int, aggs: dict[str, Agg]) -> DataFrame:
    """``keys``, window_end, aggregates of the windows that pane rows lie in."""
    merge = summed_windows if _whole(panes, aggs) else merged_windows
    return finished_windows(merge(panes, keys, size_s, slide_s, aggs), keys, slide_s, aggs)


def paned(df: DataFrame, keys: list[str], size_s: int, slide_s: int, aggs: dict[str, Agg], ts: str = "ts") -> DataFrame:
    """``keys``, window_end (timestamp), aggregates, as :func:`windowed` would give them. ``slide_s`` divides ``size_s``.
    ``df`` may come from :func:`capped`."""
    return pane_windows(pane_rows(df, keys, slide_s, aggs, ts), keys, size_s, slide_s, aggs)


def list_windows(df: DataFrame, keys: list[str], size_s: int, slide_s: int, ident: str, order: Column, k: Column | int, most: int, ts: str = "ts", show: Callable[[Column], Column] | None = None) -> DataFrame:
    """``keys``, window_end, items: for each sliding window the ``k`` (at most ``most``) ids of largest ``order``, ties to
    smaller ids, as an array of (id, value). ``order`` is a long or double, or a struct whose first field is one; an id
    counts with its largest. ``df`` may come from :func:`capped`. ``show``: what to make of the items; it is made once for all
    windows in a row that hold the same rows.

    An id is among a window's first k only if it is among the first k of one of its panes, so panes keep ``most`` rows of
    a key. A chunk of windows then holds at most 2 * ``most`` * panes rows of a key in one array. A list only changes at a window that
    a row enters or has left, so each such stretch takes its part of the sorted array, and its windows are written out in the last
    step: no row is copied into windows."""
    n = panes_in(size_s, slide_s)
    best = with_panes(df, slide_s, ts).groupBy(*keys, "_pane", "_from", F.col(ident).alias("id")).agg(F.max(order).alias("value"))
    rank = F.row_number().over(W.partitionBy(*keys, "_pane", "_from").orderBy(F.desc("value"), "id"))
    few = best.withColumn("_r", rank).filter(F.col("_r") <= most).drop("_r")
    entry = F.struct(F.col("value"), (-F.col("id")).alias("m"), F.col("_pane").alias("p"), F.col("_from").alias("f"))
    per = chunked(few, n).groupBy(*keys, "_chunk").agg(F.sort_array(F.collect_list(entry), asc=False).alias("_all"))
    low, high = F.col("_chunk") * n, F.col("_chunk") * n + n
    enter, leave = F.transform("_all", lambda x: F.greatest(x["f"], low)), F.transform("_all", lambda x: F.least(x["p"] + (n + 1), high))
    # a generator each, so that Spark doesn't write one expression into the next
    per = per.withColumn("_ats", F.explode(F.array(F.sort_array(F.array_union(enter, leave)))))
    per = per.select(*keys, "_all", "_ats", F.posexplode("_ats").alias("_i", "_at")).withColumn("_next", F.get("_ats", F.col("_i") + 1)).filter(F.col("_next").isNotNull()).drop("_ats", "_i")
    mine = F.filter("_all", lambda x: (x["p"] >= F.col("_at") - n) & (x["f"] <= F.col("_at")))
    per = per.select(*keys, "_at", "_next", F.explode(F.array(mine)).alias("_mine")).filter(F.size("_mine") > 0)
    per = per.withColumn("_ids", F.transform("_mine", lambda x: x["m"]))
    first = F.slice(F.array_distinct("_ids"), 1, k)
    items = F.transform(first, lambda m: F.struct((-m).alias("id"), F.element_at("_mine", F.array_position("_ids", m).cast("int"))["value"].alias("value")))
    per = per.select(*keys, "_at", "_next", F.explode(F.array(show(items) if show else items)).alias("items"))
    per = per.select(*keys, "items", F.explode(F.sequence("_at", F.col("_next") - 1)).alias("_end"))
    return per.select(*keys, F.timestamp_seconds(F.col("_end") * slide_s).alias("window_end"), "items")


def seconds(text: str) -> int:
    """Seconds of ``10 minutes`` and the like."""
    n, unit = text.split()
    return int(n) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


def _mask(value: str, conds: dict[str, Column]) -> Column:
    """The conditions that a row's value meets, as bits."""
    mask = F.lit(0).cast("long")
    for i, cond in enumerate(conds.values()):
        mask = mask + F.when(cond & F.col(value).isNotNull(), F.lit(1 << i).cast("long")).otherwise(0)
    return mask


def _bits(conds: dict[str, Column]) -> list[Column]:
    """How many masks have each bit."""
    return [F.sum(F.shiftright("_mask", i).bitwiseAND(F.lit(1).cast("long"))).alias(name) for i, name in enumerate(conds)]


def distinct_counts(df: DataFrame, keys: list[str], value: str, conds: dict[str, Column]) -> DataFrame:
    """``count_distinct(when(..))`` of one column under many conditions: a row for each value, not for each value and condition."""
    each = df.groupBy(*keys, F.col(value).alias("_v")).agg(F.bit_or(_mask(value, conds)).alias("_mask"))
    return each.groupBy(*keys).agg(*_bits(conds))


def distinct_windows(
    df: DataFrame, keys: list[str], size: str, slide: str, value: str, conds: dict[str, Column], ts: str = "ts", sums: dict[str, Column] | None = None, many: bool = False, spanned: bool = False
) -> DataFrame:
    """Exact distinct counts of one column under many conditions, as :func:`windowed` with ``count_distinct(when(..))``
    gives them, and ``sums`` of whole numbers. A row counts for a condition in those of its windows that no earlier row of the
    value with that condition lies in; these are a stretch of windows, which it enters and leaves (:func:`running_windows`).
    Conditions are bits of one mask, and no row is copied into windows. ``many``: keys with many values in a pane; their steps
    are summed by time before a key comes together. ``spanned``: also first_ts and last_ts. Batches only (:func:`distinct_stream` is the
    streams' twin); ``slide`` divides ``size``; ``df`` may come from :func:`capped`."""
    size_s, slide_s = seconds(size), seconds(slide)
    n, extra = panes_in(size_s, slide_s), sums or {}
    kept = [F.col(ts).alias("ts")] if spanned else []
    rows = with_panes(df, slide_s, ts).select(*keys, "_pane", "_from", F.col(value).alias("_v"), _mask(value, conds).alias("_mask"), *[x.cast("long").alias(name) for name, x in extra.items()], *kept)
    rows = rows.filter(F.col("_pane").isNotNull()).repartition(*keys, *(["_v"] if many else [])).sortWithinPartitions(*keys, "_v", "_pane", "_from")
    before = W.partitionBy(*keys, "_v").orderBy("_pane", "_from").rowsBetween(W.unboundedPreceding, -1)
    last = {i: f"_last{i}" for i in range(len(conds))}
    has = {i: F.col("_mask").bitwiseAND(F.lit(1 << i).cast("long")) != 0 for i in last}
    rows = rows.select("*", *[F.max(F.when(has[i], F.col("_pane"))).over(before).alias(last[i]) for i in last])
    # windows up to the last one of the row before are that row's
    start = {i: F.greatest(F.col("_from"), F.coalesce(F.col(last[i]) + (n + 1), F.col("_from"))) for i in last}
    union = lambda pick: sum((F.when(has[i] & pick(i), F.lit(1 << i).cast("long")).otherwise(0) for i in last), F.lit(0).cast("long"))
    rows = rows.withColumns({"_at_once": union(lambda i: start[i] == F.col("_from")), "_leave": union(lambda i: start[i] <= F.col("_pane") + n)})

    def step(at: Column, sign: int, mask: Column, row: int) -> Column:
        """``row``: 1 if the row itself comes or goes, 0 if a condition alone."""
        values = [(F.col(x) * (sign * row)).alias(x) for x in extra] + ([F.when(F.lit(row == 1), F.col("ts")).alias("ts")] if spanned else [])
        return F.struct(at.alias("_at"), F.lit(sign * row).alias("_step"), F.lit(sign).alias("_sign"), mask.alias("_mask"), *values)

    late = [F.when(has[i] & (start[i] > F.col("_from")) & (start[i] <= F.col("_pane") + n), step(start[i], 1, F.lit(1 << i).cast("long"), 0)) for i in last]
    each = F.array_compact(F.array(step(F.col("_from"), 1, F.col("_at_once"), 1), step(F.col("_pane") + (n + 1), -1, F.col("_leave"), 1), *late))
    steps = rows.select(*keys, F.explode(each).alias("_s")).select(*keys, "_s.*")
    names = {c: F.shiftright("_mask", i).bitwiseAND(F.lit(1).cast("long")) * F.col("_sign") for i, c in enumerate(conds)} | {x: F.col(x) for x in extra}
    names |= {f"_known_{x}": F.when(F.col(x).isNotNull(), F.col("_step")).otherwise(0) for x in extra}
    if many:
        times = [F.coalesce(F.max(F.when(F.col("_step") > 0, F.col("ts"))), F.min(F.when(F.col("_step") < 0, F.col("ts")))).alias("ts")] if spanned else []
        steps = steps.groupBy(*keys, "_at", *(["_sign"] if spanned else [])).agg(F.sum("_step").alias("_step"), *[F.sum(x).alias(c) for c, x in names.items()], *times)
        names = {c: F.col(c) for c in names}
    out = running_windows(steps, keys, names, spanned)
    end = F.timestamp_seconds(F.col("_end") * slide_s)
    shown = [F.when(F.col(f"_known_{x}") > 0, F.col(x)).alias(x) for x in extra]  # a sum over nulls alone is null
    return out.select(*keys, (end - F.make_dt_interval(secs=F.lit(size_s))).alias("window_start"), end.alias("window_end"), *conds, *shown, *(["first_ts", "last_ts"] if spanned else []))


def stream_windows(df: DataFrame, keys: list[str], size: str, slide: str, cap: int | None = None, cap_keys: list[str] | None = None, tie: str = "event_id", ts: str = "ts") -> DataFrame:
    """Rows of a stream with ``w``, once for each of their windows; with ``cap`` for those alone in which a row is among the first of
    its ``cap_keys`` to arrive, which a state in front of the aggregate counts. The stream has its watermark on ``ts``."""
    if cap is None:
        return df.withColumn("w", F.window(ts, size, slide))
    from tidemark.streaming.stateful import first_in_windows

    rows = first_in_windows(df, cap_keys or keys, cap, seconds(size), seconds(slide), tie, ts)
    return rows.withColumn("w", F.window("window_at", slide))


def distinct_stream(df: DataFrame, keys: list[str], slide: str, value: str, conds: dict[str, Column]) -> DataFrame:
    """:func:`distinct_windows` in a stream, exactly: rows of :func:`stream_windows` lose what repeats a window's value under a
    condition (a state that goes with the watermark), and what is left is counted. A window's rows without any condition keep
    its row."""
    marks = [F.when(cond & F.col(value).isNotNull(), F.lit(i)) for i, cond in enumerate(conds.values())]
    each = df.select(*keys, "w", F.col(value).alias("_v"), F.explode(F.array_compact(F.array(F.lit(-1), *marks))).alias("_c"))
    each = each.withColumn("_v", F.when(F.col("_c") >= 0, F.col("_v"))).dropDuplicates([*keys, "w", "_v", "_c"])
    out = each.groupBy(*keys, "w").agg(*[F.count_if(F.col("_c") == i).alias(n) for i, n in enumerate(conds)])
    return _window_columns(out, keys, list(conds))


def _window_columns(out: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    return out.select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *names)


def sessions(df: DataFrame, keys: list[str], gap: str, aggs: dict[str, Column], ts: str = "ts") -> DataFrame:
    """Session windows; events exactly one gap apart share a session. In streams, later windows take ``session_time``."""
    out = df.groupBy(*keys, F.session_window(ts, gap).alias("s")).agg(*[a.alias(n) for n, a in aggs.items()])
    extra = [F.window_time("s").alias("session_time")] if df.isStreaming else [(F.col("s.end") - F.expr("INTERVAL 1 MICROSECOND")).alias("session_time")]
    return out.select(*keys, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), *extra, *aggs)


def first_events(df: DataFrame, keys: list[str], n: int, order: list[str]) -> DataFrame:
    """The first ``n`` rows of each key in order: a cap against very busy keys, taken before the shuffle too."""
    r = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_r", r).filter(F.col("_r") <= n).drop("_r")


def assign(df: DataFrame, size: str, slide: str | None = None, ts: str = "ts") -> DataFrame:
    """A row for each window that holds the event, with window_end."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    return df.withColumn("_w", w).withColumn("window_end", F.col("_w.end")).drop("_w")
