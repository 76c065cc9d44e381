"""Near-duplicate documents by HyperMinHash.

1. Each text becomes its set of word shingles (64-bit hashes), and the set 128 registers of leading-zero
   counts with 10 mantissa bits. Texts with equal sets are one *node* with a number of its own: copies cost one row
   each from here on.
2. Registers are banded (25 bands of 5: a pair at similarity 0.8 shares a band with probability 0.9999).
   In each bucket of several nodes every node is paired with one hub, not with all others; estimates,
   corrected for chance collisions, pass pairs within four standard errors of the threshold. Where a bucket still
   holds several families, those outside its largest meet all its members: as pairs in small buckets, in blocks
   of registers in large ones, which return only what joins families. So no candidate pair is skipped.
3. Passed pairs join nodes into families, whose links are confirmed on full shingle sets, block by block. A family of
   up to BLOCK nodes is compared whole. In a larger one, blocks are compared within themselves first, then the HUBS nodes of
   most links with all others, and then only nodes outside the largest cluster so found meet the nodes of other clusters.
   So a group of n near copies of one text moves each set a few times, not n / BLOCK times, and no pair of different
   clusters is left out. A task returns a spanning forest of its links and each member's cluster.
4. A family of one block is settled by its task; in larger ones, links join clusters to components. The smallest doc_id of a
   component's nodes names it.

Between the steps only ids, registers and sets of family members move; texts are read twice (the second time
for one row of each family member, which a bitmap of bounded size picks out before the shuffle).

Defined cases: a null or blank text has an empty set, is linked with nothing and kept; fewer words than
``width`` make one shingle; rows with a null doc_id are kept and take no part; rows that share a doc_id are one
node if their sets are equal, and otherwise nodes of their own that the shared id doesn't link; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .components import components
from .scratch import free, released, save, table
from .shingles import U, band_keys, estimate, registers, shingle_sets

BANDS, ROWS, BLOCK, HUBS = 25, 5, 96, 4
PAIRED, REGISTER_BLOCK = 64, 512
#: Words of 64 bits in the bitmap of the rows whose texts are read again.
SIEVE_WORDS = 1 << 18


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, text_id (a hash of the text), n_shingles, set_key (128-bit hash of the set), sig (registers), bands (64-bit
    keys)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, len(big), 1024):
                b = big.slice(at, 1024)
                n, key, sig, bands = [], [], [], []
                for s in shingle_sets(b.column(2).cast(pa.binary()).to_pylist(), width):
                    n.append(len(s))
                    key.append(xxhash.xxh3_128_digest(s.tobytes()))
                    reg = registers(s)
                    sig.append(reg.tobytes())
                    bands.append(band_keys(reg, BANDS, ROWS) if len(s) else [])
                made = [pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(sig, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *made], names=["doc_id", "text_id", "n_shingles", "set_key", "sig", "bands"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_id"), "text")
    return rows.mapInArrow(released(sign), "doc_id long, text_id long, n_shingles long, set_key binary, sig binary, bands array<long>")


def full_sets(docs: DataFrame, width: int) -> DataFrame:
    """node, set (sorted uint64 hashes) of rows node, text."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, len(big), 512):
                b = big.slice(at, 512)
                out = [s.tobytes() for s in shingle_sets(b.column(1).cast(pa.binary()).to_pylist(), width)]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["node", "set"])

    return docs.select("node", "text").mapInArrow(released(sets), "node long, set binary")


def _near(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray, threshold: float) -> np.ndarray:
    """Which estimates aren't four standard errors below the threshold."""
    j, some = estimate(ra, rb, na, nb)
    return j >= threshold - 4 * np.sqrt(threshold * (1 - threshold) / np.maximum(some, 1)) - 1e-9


def likely(pairs: DataFrame, threshold: float, *ends: str) -> DataFrame:
    """Of pairs (na, nb, sig_a, sig_b, and two columns ``ends``), those that may reach the threshold: sizes allow it, and the
    estimate isn't four standard errors below. Returned as (a, b)."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            na, nb = (b.column(i).to_numpy() for i in (2, 3))
            ra, rb = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint16).reshape(len(b), -1) for i in (4, 5))
            yield b.select([0, 1]).rename_columns(["a", "b"]).filter(pa.array(_near(ra, rb, na, nb, threshold)))

    close = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * F.lit(round(threshold * 100))
    return pairs.filter(close).select(*ends, "na", "nb", "sig_a", "sig_b").mapInArrow(released(judge), "a long, b long")


def with_registers(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    one = nodes.select(F.col("node").alias("a"), F.col("n_shingles").alias("na"), F.col("sig").alias("sig_a"))
    two = nodes.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb"), F.col("sig").alias("sig_b"))
    return pairs.join(one, "a").join(two, "b")


def star_pairs(entries: DataFrame) -> DataFrame:
    """Each member of a bucket (bucket, node) with its hub, the member of least salted hash."""
    salted = F.xxhash64("node", "bucket")
    hubs = entries.groupBy("bucket").agg(F.count("*").alias("n"), F.min(F.struct(salted.alias("h"), F.col("node").alias("hub"))).alias("least"))
    # a table of its own, so that Spark can split the join at a very large bucket
    hubs = save(hubs.filter(F.col("n") > 1).select("bucket", F.col("least.hub").alias("hub"), "n"), "near-hubs")
    return entries.join(hubs, "bucket").filter(F.col("node") != F.col("hub"))


def mixed_buckets(entries: DataFrame, families: DataFrame) -> DataFrame:
    """bucket, node, family, main, members, light of the buckets whose members lie in several families; main is the
    bucket's largest family, light members are those outside it."""
    f = entries.join(families.select(F.col("id").alias("node"), F.col("component").alias("family")), "node", "left").withColumn("family", F.coalesce("family", "node"))
    sizes = f.groupBy("bucket", "family").agg(F.count("*").alias("k"))
    top = sizes.groupBy("bucket").agg(F.count("*").alias("families"), F.sum("k").alias("members"), F.max(F.struct("k", "family")).alias("top")).filter(F.col("families") > 1)
    top = top.select("bucket", F.col("top.family").alias("main"), "members", (F.col("members") - F.col("top.k")).alias("lights"))
    return f.join(top, "bucket").withColumn("light", F.col("family") != F.col("main"))


def rest_pairs(mixed: DataFrame) -> DataFrame:
    """Pairs (a, b) of different families (fa, fb) in buckets of at most PAIRED members: some dozens a member."""
    small = mixed.filter(F.col("members") <= PAIRED)
    light = small.filter("light").select("bucket", F.col("node").alias("x"), F.col("family").alias("fx"))
    other = small.select("bucket", F.col("node").alias("y"), F.col("family").alias("fy"), (~F.col("light")).alias("heavy"))
    pairs = light.join(other, "bucket").filter((F.col("fx") != F.col("fy")) & (F.col("heavy") | (F.col("x") < F.col("y"))))
    least = F.least(F.struct("x", "fx"), F.struct(F.col("y").alias("x"), F.col("fy").alias("fx")))
    most = F.greatest(F.struct("x", "fx"), F.struct(F.col("y").alias("x"), F.col("fy").alias("fx")))
    return pairs.select(least["x"].alias("a"), most["x"].alias("b"), least["fx"].alias("fa"), most["fx"].alias("fb")).distinct()


def rest_blocks(mixed: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """The same for larger buckets, without a row a pair: each block of light members meets each block of all
    members in a group of its own, and returns pairs of families (a, b) that span those it joins."""
    sig = nodes.select(F.col("node").alias("_n"), "n_shingles", "sig")
    m = mixed.filter(F.col("members") > PAIRED).join(sig, F.col("node") == F.col("_n"))
    parts = lambda n: F.ceil(F.col(n) / REGISTER_BLOCK).cast("int")
    m = m.withColumn("nj", parts("members")).withColumn("ni", parts("lights"))
    mine = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    cols = ["bucket", "i", "j", "side", "family", "n_shingles", "sig"]
    right = m.withColumn("j", mine("nj")).withColumn("i", every("ni")).withColumn("side", F.lit(1)).select(*cols)
    left = m.filter("light").withColumn("i", mine("ni")).withColumn("j", every("nj")).withColumn("side", F.lit(0)).select(*cols)

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        l, r = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
        reg = [np.frombuffer(b"".join(x["sig"]), np.uint16).reshape(len(x), -1) for x in (l, r)]
        n_l, n_r, fam_l, fam_r = (x[c].to_numpy() for c in ("n_shingles", "family") for x in (l, r))
        parent: dict = {}

        def find(x):
            while parent.setdefault(x, x) != x:
                x = parent[x]
            return x

        out = []
        for i in range(len(l)):
            ok = (fam_r != fam_l[i]) & (np.minimum(n_r, n_l[i]) * 100 >= np.maximum(n_r, n_l[i]) * round(threshold * 100))
            at = np.flatnonzero(ok)
            if len(at):
                for k in at[_near(np.broadcast_to(reg[0][i], (len(at), reg[0].shape[1])), reg[1][at], np.full(len(at), n_l[i]), n_r[at], threshold)]:
                    a, b = find(fam_l[i]), find(fam_r[k])
                    if a != b:
                        parent[a] = b
                        out.append((fam_l[i], fam_r[k]))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return left.unionByName(right).groupBy("bucket", "i", "j").applyInPandas(compare, "a long, b long")


def _forest(sets: list[np.ndarray], cluster: np.ndarray, left: np.ndarray, percent: int) -> tuple[list[tuple[int, int]], list[int]]:
    """A spanning forest, over clusters, of the links among ``sets`` that join clusters, of all pairs if ``left`` is all true,
    else of left with right; and each set's cluster after them."""
    n = len(sets)
    size = np.array([len(s) for s in sets])
    values, where = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n), size)
    shared = np.bincount(where, minlength=len(values)) > 1
    keep = shared[where]
    col = (np.cumsum(shared) - 1)[where[keep]]
    row = owner[keep]
    inter = np.zeros((n, n), np.float32)
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    for at in range(0, int(shared.sum()), 8192):
        s, e = np.searchsorted(col, (at, at + 8192))
        m = np.zeros((n, 8192), np.float32)
        m[row[s:e], col[s:e] - at] = 1
        inter += m @ m.T
    inter = np.rint(inter).astype(np.int64)
    union = size[:, None] + size[None] - inter
    hit = (100 * inter >= percent * union) & (cluster[:, None] != cluster[None])
    if not left.all():
        hit &= left[:, None] != left[None]
    parent: dict = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(np.triu(hit, 1))):
        a, b = find(int(cluster[i])), find(int(cluster[j]))
        if a != b:
            parent[a] = b
            out.append((int(cluster[i]), int(cluster[j])))
    # a cluster is named alike in all tasks that see one of the left
    names: dict = {}
    for c, l in sorted(zip(cluster.tolist(), left.tolist()), key=lambda x: (not x[1], x[0])):
        names.setdefault(find(c), c)
    return out, [names[find(c)] for c in cluster.tolist()]


def _compared(rows: DataFrame, percent: int) -> DataFrame:
    """Links between clusters (a, b) in each group (family, i, j) of rows (side, id, cluster, set), from all pairs if one side
    alone is there, else from side 0 with side 1; and, marked by ``link`` false, each id of side 1 with its cluster after them."""

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        left = (pdf["side"] == 0).to_numpy()
        ids, cluster = pdf["id"].to_numpy(), pdf["cluster"].to_numpy()
        links = []
        if len(pdf) > 1:
            links, cluster = _forest([np.frombuffer(s, U) for s in pdf["set"]], cluster, left, percent)
        known = [(i, int(c)) for i, c, l in zip(ids.tolist(), cluster, left) if not l or left.all()]
        both = [(*x, True) for x in links] + [(*x, False) for x in known]
        return pd.DataFrame(both, columns=["a", "b", "link"]).astype({"a": "int64", "b": "int64", "link": bool})

    return rows.select("family", "i", "j", "side", "id", "cluster", "set").groupBy("family", "i", "j").applyInPandas(compare, "a long, b long, link boolean")


def _blocks(n) -> Column:
    return F.ceil(n / BLOCK).cast("int")


def _every(n) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(n) - 1))


def confirmed(families: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """id, component of the members (id, component) of families, by the links between them whose full sets reach the
    threshold. A family of one block is settled by its task; clusters of larger ones are joined by what the later rounds
    find."""
    percent = round(threshold * 100)
    size = families.groupBy("component").agg(F.count("*").alias("n")).withColumn("blocks", _blocks(F.col("n")))
    members = families.join(size, "component").select("id", F.col("component").alias("family"), "blocks").withColumn("mine", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    members = save(members.join(sets, F.col("id") == F.col("node")).drop("node"), "near-members")
    first = save(_compared(members.withColumns({"i": F.col("mine"), "j": F.col("mine"), "side": F.lit(0), "cluster": F.col("id")}), percent), "near-links")
    found = first.filter("not link").select(F.col("a").alias("id"), F.col("b").alias("component"))
    links = first.filter("link").select("a", "b")
    large = members.filter(F.col("blocks") > 1)
    if not large.limit(1).count():
        free(members)
        return found
    ids = large.select("id", "family", "blocks", "mine")
    cluster = lambda known: known.filter("not link").select(F.col("a").alias("_i"), F.col("b").alias("cluster"))
    # the members of most links with all others
    ends = links.select(F.col("a").alias("id")).unionByName(links.select(F.col("b").alias("id"))).groupBy("id").agg(F.count("*").alias("links"))
    order = W.partitionBy("family").orderBy(F.desc("links"), "id")
    hubs = ids.join(ends, "id").withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= HUBS).select("id").withColumn("side", F.lit(0))
    m = large.join(cluster(first), F.col("id") == F.col("_i")).join(hubs.withColumnRenamed("id", "_h"), F.col("id") == F.col("_h"), "left").withColumn("hub", F.col("_h").isNotNull())
    cols = ["family", "i", "j", "side", "id", "cluster", "set"]
    met = m.filter("hub").withColumn("j", _every("blocks")).withColumns({"i": F.lit(-1), "side": F.lit(0)}).select(*cols)
    met = met.unionByName(m.filter("not hub").withColumns({"i": F.lit(-1), "j": F.col("mine"), "side": F.lit(1)}).select(*cols))
    second = save(_compared(met, percent), "near-links")
    # members outside the largest cluster with those of other clusters; what a task found out about a cluster holds for all
    # of it, and what it can't know costs comparisons alone
    m = save(ids.join(cluster(second.unionByName(first.join(second.filter("not link").select("a"), "a", "left_anti"))), F.col("id") == F.col("_i")).select("id", "family", "cluster"), "near-clusters")
    top = m.groupBy("family", "cluster").agg(F.count("*").alias("k")).groupBy("family").agg(F.sum("k").alias("n"), F.max(F.struct("k", "cluster")).alias("top"), F.count("*").alias("clusters"))
    top = top.filter(F.col("clusters") > 1).select("family", F.col("top.cluster").alias("main"), _blocks(F.col("n")).alias("nj"), _blocks(F.col("n") - F.col("top.k")).alias("ni"))
    mixed = m.join(top, "family").withColumn("light", F.col("cluster") != F.col("main"))
    part = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    light = mixed.filter("light").withColumns({"i": part("ni"), "side": F.lit(0)}).withColumn("j", _every("nj"))
    every = mixed.withColumns({"j": part("nj"), "side": F.lit(1)}).withColumn("i", _every("ni"))
    rows = light.select(*cols[:-1]).unionByName(every.select(*cols[:-1])).withColumnRenamed("id", "_id").join(large.select("id", "set"), F.col("_id") == F.col("id"))
    third = _compared(rows, percent)
    found = save(relabelled(found, components(second.unionByName(third).filter("link").select("a", "b"))), "near-found")
    free(first, second, m, members)
    return found


def relabelled(part: DataFrame, joined: DataFrame) -> DataFrame:
    """part (id, component), its components replaced by the components of ``joined`` where that names them as ids."""
    new = joined.select(F.col("id").alias("_old"), F.col("component").alias("_new"))
    return part.join(new, F.col("component") == F.col("_old"), "left").select("id", F.coalesce("_new", "component").alias("component"))


def sieved(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of texts (doc_id, text_id) that may be in wanted (_d, _t), by a bitmap of hashes that never grows beyond
    SIEVE_WORDS rows of two numbers, and so may be broadcast. It loses none of wanted; the more it holds, the more others pass,
    which the join behind it drops."""
    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(c, F.lit(64)).cast("int"))
    word = lambda c: F.pmod(F.shiftright(c, 6), F.lit(SIEVE_WORDS))
    key = F.xxhash64("_d", "_t")
    marks = wanted.groupBy(word(key).alias("_word")).agg(F.bit_or(bit(key)).alias("_bits"))
    own = F.xxhash64("doc_id", "text_id")
    return texts.join(F.broadcast(marks), word(own) == F.col("_word")).filter(F.col("_bits").bitwiseAND(bit(own)) != 0).drop("_word", "_bits")


def near_duplicates(docs: DataFrame, width: int = 5, threshold: float = 0.8) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, text_id (``xxhash64(text)``) of every row of ``docs``."""
    signed = save(signatures(docs, width), "near-sig")
    named = signed.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    # numbers are given once, in a table: what is worked out again gets the same
    groups = save(named.groupBy("set_key").agg(F.min("doc_id").alias("low"), F.min_by("text_id", "doc_id").alias("of")).withColumn("node", F.monotonically_increasing_id()), "near-groups")
    g = groups.withColumnRenamed("set_key", "_k")
    one = named.join(g, (F.col("set_key") == F.col("_k")) & (F.col("doc_id") == F.col("low")) & (F.col("text_id") == F.col("of")))
    nodes = save(one.select("node", "set_key", "n_shingles", "sig", "bands").dropDuplicates(["set_key"]), "near-nodes")
    entries = nodes.select("node", F.explode("bands").alias("bucket"))
    stars = save(star_pairs(entries), "near-stars")
    pairs = stars.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    edges = save(likely(with_registers(pairs, nodes), threshold, "a", "b"), "near-edges")
    families = save(components(edges), "near-families")
    # buckets of two were settled by their star
    large = stars.filter(F.col("n") > 2)
    members = large.select("bucket", "node").unionByName(large.select("bucket", F.col("hub").alias("node")).distinct())
    mixed = save(mixed_buckets(members, families), "near-mixed")
    more = likely(with_registers(rest_pairs(mixed), nodes), threshold, "fa", "fb")
    # families joined by what is left; a node outside all of them is its own
    joined = save(components(more.unionByName(rest_blocks(mixed, nodes, threshold))), "near-joined")
    alone = joined.join(families.select("id"), "id", "left_anti")
    old, families = families, save(relabelled(families, joined).unionByName(alone), "near-families")
    free(old, stars, mixed, edges, joined)
    texts = docs.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_id"), "text")
    # a table of its own, so that Spark knows its size
    wanted = save(families.select("id").join(groups, F.col("id") == F.col("node")).select("node", F.col("low").alias("_d"), F.col("of").alias("_t")), "near-wanted")
    texts = sieved(texts, wanted).join(wanted, (F.col("doc_id") == F.col("_d")) & (F.col("text_id") == F.col("_t"))).dropDuplicates(["node"])
    settled = confirmed(families, full_sets(texts, width), threshold)
    found = settled.select("id", F.col("component").alias("_c"))
    part = groups.join(found, F.col("node") == F.col("id"), "left").select("set_key", "low", F.coalesce("_c", "node").alias("_c"))
    least = part.groupBy("_c").agg(F.min("low").alias("_low")).withColumnRenamed("_c", "_cc")
    part = part.join(least, F.col("_c") == F.col("_cc")).select(F.col("set_key").alias("_k"), F.col("_low").alias("_component"))
    rows = signed.select("doc_id", "text_id", "n_shingles", "set_key")
    out = rows.join(part, (F.col("set_key") == F.col("_k")) & (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), "left")
    component = F.coalesce("_component", "doc_id")
    kept = F.coalesce(component == F.col("doc_id"), F.lit(True))
    out = save(out.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"), "text_id"), "near-out")
    free(signed, groups, nodes, families, wanted, settled)
    return out


def deduplicate(docs: DataFrame, width: int = 5, threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that are kept: of each component that with its smallest doc_id."""
    gone = near_duplicates(docs, width, threshold).filter(~F.col("kept")).select(F.col("doc_id").alias("_gone"), F.col("text_id").alias("_text")).distinct()
    return docs.join(gone, (docs["doc_id"].cast("long") == F.col("_gone")) & (F.xxhash64(docs["text"]) == F.col("_text")), "left_anti").select(*docs.columns)


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=4, threshold=0.8).drop("text_id")


OP3_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]) END) AS s FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id
  JOIN sizes sx ON sx.doc_id = x.doc_id JOIN sizes sy ON sy.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, sx.n, sy.n HAVING 100 * count(*) >= 80 * (sx.n + sy.n - count(*))
), reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.low, d.doc_id)) AS component_id, d.doc_id = least(d.doc_id, coalesce(m.low, d.doc_id)) AS kept
FROM documents d LEFT JOIN sizes z ON z.doc_id = d.doc_id LEFT JOIN (SELECT a, min(b) AS low FROM reach GROUP BY a) m ON m.a = d.doc_id
"""
