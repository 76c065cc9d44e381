"""Mixing sources to target weights by entropy balancing. DataFrame functions only.

Each document gets a rate ``r`` (expected copies, 1 in the corpus as it is). Of all rates that meet the token
constraint of every source, sum(r * size) = target, with 0 <= r <= cap, the entropy-balanced ones are nearest
to 1 in relative entropy. They are exponentially tilted, r = min(cap, exp(lambda * x)) with x the size in
units of the source's token-weighted mean size, and lambda solves the convex dual, one equation a source.

Documents meet the solver as a histogram (source, size -> documents): Newton steps aggregate that table, all
sources at once, each step guarded by a bisection bracket. Lambdas stay in a table; the driver sees the
number of sources that haven't converged.

Rates become copies in two steps. Sizes are taken in cells (exact up to 256 words, then 128 to a doubling, so
a source has a few thousand cells at most); from large to small, each cell's copies are its expected copies
rounded up or down, whichever brings the source's words back to their running target. In a cell, copies are
dealt evenly over the documents in a hashed order; a cell of more than ``group_rows`` documents is dealt in
parts of about that many, each rounded from a hashed start, so that no group grows with its source. Nothing
is random: reruns agree.

Targets: sources share ``share`` of all sizes by weight; a target stops at ``cap`` times its source's size
and the excess is shared again by weight, until none is above (a water level, found by a few sums over sources).

Defined cases: a null or empty text has size 0 and takes nothing; a null source is a source, last in order;
rows with a null ``doc_id`` are dealt by their texts and repeated rows are mixed like others; a ``cap`` bounds rates, and a
document's copies stay at or below it rounded up; an empty table gives an empty result; other
columns are returned as they are by :func:`mix`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scratch import free, save, table, unboxed

def word_count(text: Column) -> Column:
    """Words of a text, null: 0. (Of the ways tried, splitting was the fastest by two times and more.)"""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """From ``source``, ``source_size`` (a row a source): target added. Weights go round in the sources' order
    by code point, null last."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    weighed = save(sizes.withColumn("weight", w), "mix-sources")
    limit = F.col("source_size") * F.lit(float(cap))
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        x = weighed.agg(
            F.sum(F.when(F.col("weight") * level >= limit, limit)).alias("full"), F.sum(F.when(F.col("weight") * level < limit, F.col("weight"))).alias("open"), F.sum((F.col("weight") * level >= limit).cast("int")).alias("n")
        ).first()
        if not x["open"] or x["n"] == capped:
            break
        level, capped = (share * total - (x["full"] or 0)) / x["open"], x["n"]
    return weighed.withColumn("target", F.least(limit, F.col("weight") * F.lit(level)) if capped >= 0 else limit)


def tilts(hist: DataFrame, targets: DataFrame, cap: float = 2.0, tol: float = 1e-7, max_steps: int = 60) -> DataFrame:
    """lambda by source. ``hist``: source, size, n; ``targets``: source, source_size, target."""
    mean = hist.groupBy("source").agg((F.sum(F.col("n") * F.col("size") * F.col("size")) / F.nullif(F.sum(F.col("n") * F.col("size")), F.lit(0))).alias("unit"))
    key = lambda a, b: a["source"].eqNullSafe(b["source"])
    state = targets.join(mean, key(targets, mean), "left").select(targets["source"], "source_size", "target", "unit")
    # a target at the cap or at nothing has its lambda at infinity: every rate is the cap or 0
    state = state.withColumn("lam", F.when(F.col("target") >= F.col("source_size") * cap, F.lit(float("inf"))).when(F.col("target") <= 0, F.lit(float("-inf"))).otherwise(F.log(F.col("target") / F.col("source_size"))))
    state = state.withColumn("lo", F.lit(float("-inf"))).withColumn("hi", F.lit(float("inf"))).withColumn("done", F.abs("lam") == float("inf"))
    state = save(state, "mix-state")
    for _ in range(max_steps):
        h = hist.withColumnRenamed("source", "_s")
        open_ = state.filter(~F.col("done"))
        x = F.col("size") / F.col("unit")
        r = F.exp(F.col("lam") * x)
        free_ = r < cap
        step = h.join(open_, h["_s"].eqNullSafe(open_["source"])).groupBy("_s").agg(
            F.sum(F.col("n") * F.col("size") * F.least(r, F.lit(float(cap)))).alias("got"), F.sum(F.when(free_, F.col("n") * F.col("size") * x * r).otherwise(0.0)).alias("slope")
        )
        s = state.join(step, state["source"].eqNullSafe(step["_s"]), "left")
        miss = F.col("got") - F.col("target")
        lo, hi = F.when(miss < 0, F.col("lam")).otherwise(F.col("lo")), F.when(miss > 0, F.col("lam")).otherwise(F.col("hi"))
        s = s.withColumn("lo2", F.when(F.col("got").isNull(), F.col("lo")).otherwise(lo)).withColumn("hi2", F.when(F.col("got").isNull(), F.col("hi")).otherwise(hi))
        newton = F.col("lam") - miss / F.nullif(F.col("slope"), F.lit(0.0))
        inside = F.coalesce((F.col("slope") > 0) & (newton > F.col("lo2")) & (newton < F.col("hi2")) & (F.abs(newton - F.col("lam")) < 4), F.lit(False))
        bounded = (F.col("lo2") > float("-inf")) & (F.col("hi2") < float("inf"))
        fallback = F.when(bounded, (F.col("lo2") + F.col("hi2")) / 2).when(miss < 0, F.col("lam") + 1.0 + F.abs("lam")).otherwise(F.col("lam") - 1.0 - F.abs("lam"))
        hit = F.abs(miss) <= tol * F.col("target")
        new = save(
            s.select(
                state["source"], "source_size", "target", "unit", F.when(F.col("done") | hit, F.col("lam")).otherwise(F.when(inside, newton).otherwise(fallback)).alias("lam"), F.col("lo2").alias("lo"), F.col("hi2").alias("hi"), (F.col("done") | hit).alias("done")
            ),
            "mix-state",
        )
        free(state)
        state = new
        if not state.filter(~F.col("done")).limit(1).count():
            return state
    raise RuntimeError(f"tilts: not converged after {max_steps} steps")


def _tilted(size: Column, cap: float) -> Column:
    lam = F.col("lam")
    rate = F.when(lam == float("inf"), F.lit(float(cap))).when(lam == float("-inf"), F.lit(0.0)).otherwise(F.least(F.lit(float(cap)), F.exp(lam * size / F.col("unit"))))
    return F.when(size == 0, 0.0).otherwise(rate)


_CELL = "_size - pmod(_size, shiftleft(1L, cast(greatest(length(bin(_size)) - 8, 0) as int)))"


def cell_copies(hist: DataFrame, state: DataFrame, cap: float) -> DataFrame:
    """For each source and cell: docs, and the copies they get together."""
    h = hist.select(F.col("source").alias("_s"), F.col("size").alias("_size"), "n").withColumn("cell", F.expr(_CELL))
    h = h.join(state, h["_s"].eqNullSafe(state["source"]))
    cells = h.withColumn("rate", _tilted(F.col("_size"), cap)).groupBy("source", "source_size", "target", "unit", "lam", "cell").agg(
        F.sum("n").alias("docs"), F.sum(F.col("n") * F.col("rate")).alias("copies"), F.sum(F.col("n") * F.col("rate") * F.col("_size")).alias("words"), (F.sum(F.col("n") * F.col("_size")) / F.sum("n")).alias("mean")
    )
    per = cells.groupBy("source", "source_size", "target", "unit", "lam").agg(F.sort_array(F.collect_list(F.struct("cell", "docs", "copies", "words", "mean")), asc=False).alias("cells"))
    start = F.struct(F.lit(0.0).alias("debt"), F.expr("cast(array() as array<bigint>)").alias("out"))

    def step(acc, c):
        due = acc["debt"] + c["words"]
        low = F.floor(c["copies"] + 1e-9)
        high = F.least(F.ceil(c["copies"] - 1e-9), F.floor(c["docs"] * F.lit(float(cap))))
        m = F.when(c["mean"] == 0, F.lit(0)).otherwise(F.greatest(low, F.least(high, F.round(due / c["mean"]).cast("long")))).cast("long")
        return F.struct((due - m * c["mean"]).alias("debt"), F.concat(acc["out"], F.array(m)).alias("out"))

    per = per.withColumn("ms", F.aggregate("cells", start, step, lambda acc: acc["out"]))
    z = F.explode(F.arrays_zip("cells", "ms")).alias("z")
    return per.select("source", "source_size", "target", "unit", "lam", z).select("source", "source_size", "target", "unit", "lam", F.col("z.cells.cell").alias("cell"), F.col("z.cells.docs").alias("docs"), F.col("z.ms").alias("m"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, group_rows: int = 1000, columns: list[str] | None = None) -> DataFrame:
    """All columns of ``docs`` (or only ``columns``, so that texts aren't shuffled) and _size, _source_size, _target, _rate, _copies. Every row comes back; a row with
    0 copies is left out of the mix."""
    # a generator, so that Spark counts a text's words once and doesn't write the count into every later expression
    columns = docs.columns if columns is None else columns
    sized = docs.select(F.struct(*[docs[c] for c in columns]).alias("_row"), docs["source"].alias("source"), docs["doc_id"].alias("_id"), F.when(docs["doc_id"].isNull(), F.xxhash64(docs["text"])).alias("_text_id"), F.explode(F.array(word_count(docs["text"]))).alias("_size"))
    hist = save(sized.groupBy("source", F.col("_size").alias("size")).agg(F.count("*").alias("n")), "mix-sizes")
    targets = source_targets(hist.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")), weights, share, cap)
    cells = cell_copies(hist, tilts(hist, targets, cap), cap).select(F.col("source").alias("_s"), F.col("cell").alias("_c"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target"), "unit", "lam", "docs", "m")
    cells = save(cells, "mix-cells")
    d = sized.withColumn("_cell", F.expr(_CELL))
    d = d.join(cells, d["source"].eqNullSafe(cells["_s"]) & (d["_cell"] == cells["_c"]))
    deals = F.ceil(F.col("docs") / group_rows)
    d = d.withColumn("_rate", _tilted(F.col("_size"), cap)).withColumn("_deal", F.pmod(F.xxhash64("_id", "_text_id", F.lit(7)), deals))
    at = F.when(deals > 1, F.pmod(F.xxhash64("source", "_cell", "_deal", F.lit(13)), F.col("docs"))).otherwise(F.lit(0))
    i = F.row_number().over(W.partitionBy("source", "_cell", "_deal").orderBy(F.xxhash64("_id", "_text_id", F.lit(11)), "_id", "_text_id", "_size")).cast("long")
    d = d.withColumn("_i", i).withColumn("_at", at)
    upto = lambda k: F.floor((k * F.col("m") + F.col("_at")) / F.col("docs"))
    d = d.withColumn("_copies", (upto(F.col("_i")) - upto(F.col("_i") - 1)).cast("long"))
    return unboxed(d, columns, "_size", "_source_size", "_target", "_rate", "_copies")


def repeat(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: each document as often as its copies say."""
    return mixed.filter(F.col("_copies") > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select(*columns)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mix(table(spark, sf_dir, "documents"), columns=["doc_id", "source"])
    return m.select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), (F.col("_copies") * F.col("_size")).alias("taken"), "source", F.col("_rate").alias("rate"))
