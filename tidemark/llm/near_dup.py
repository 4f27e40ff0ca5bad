"""Near-duplicate groups by a signature-coordinate inverted join of MinHash values.

Every document's set of distinct 5-word shingles gives ``COORDINATES`` MinHash
values.  Equal sets become one representative.  A representative is posted
under its (coordinate, value) pairs; pairs of representatives that collide on
at least ``matches`` coordinates are candidates, and a link is a candidate whose
full sets pass the similarity.  Both are arguments (``Limits``); ``CONTRACT`` is
what ``op4_near_dup`` is held to.

* Pairs held by one representative only cannot collide and go; a
  representative with fewer than ``matches`` shared ones goes as a whole.
* Prefix: in the order of rarity, two representatives that share ``matches`` of
  their pairs also share one among all but the last ``matches - 1`` of each, so
  only those are posted and frequent values are not.
* Skip: two representatives already in one group, or whose set sizes exclude
  the similarity, are not merged.

Posts of one value are not multiplied with each other.  First each value gets a
bounded number of pivots (the smallest hash in each of ``SLOTS``), every post
meets the pivots, and each representative's best candidate is confirmed; a large
group of near copies is mostly one group after that.  Values whose posts lie in
one group are then finished.  The posts of the others are dealt in blocks of
bounded bytes, each pair of blocks to one task, which counts collisions between
different groups (a pair only under its first common value), confirms them on
the full sets, and returns links that join groups, never more than its posts.

At the similarity 0.85 a pair has fewer than 43 of 64 equal coordinates with a
probability of about 1e-4, at 0.87 of 1e-5, less above; at 0.80 fewer than 37 with
one of 1.4e-5.  That is the only way to miss a link.

A row goes by a key of its own, two hashes of id and whole text (``KEY``); the
smallest ``doc_id`` of a group only names it.

Edge cases: null, empty or blank texts have an empty set and are linked with
nothing; rows with equal ``doc_id`` and text are one document, with different
texts they are several; a row without ``doc_id`` is linked like others and names
no group that has an id; an empty table gives no rows; other columns are ignored
or passed on.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _text as T

SHINGLE_WORDS = 5
COORDINATES = 64
SLOTS = 4
BLOCK_BYTES = 8 << 20
KEY = ["__k1", "__k2"]


class Limits(NamedTuple):
    similarity: int  # per cent of the full sets
    matches: int     # equal coordinates that make a candidate


CONTRACT = Limits(85, 43)

_RNG = np.random.default_rng(77)
_A = _RNG.integers(0, 2**64, COORDINATES, dtype=np.uint64) | np.uint64(1)
_B = _RNG.integers(0, 2**64, COORDINATES, dtype=np.uint64)


def signature(s: np.ndarray) -> np.ndarray:
    """MinHash values (32 bits each) of a set of hashes."""
    least = np.full(COORDINATES, 2**64 - 1, dtype=np.uint64)
    for at in range(0, len(s), 2048):
        least = np.minimum(least, (s[at:at + 2048, None] * _A + _B).min(axis=0))
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The documents and their ``KEY``."""
    return docs.withColumns({"__k1": F.xxhash64(id_col, text_col), "__k2": F.xxhash64(F.lit(1), id_col, text_col)})


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``id``, its ``KEY``, ``n`` (size of its shingle set), ``f1`` and
    ``f2`` (fingerprints of the set) and ``sig`` (null for an empty set)."""
    schema = T.schema([T.field(docs, id_col, "id")], "__k1 bigint, __k2 bigint, n bigint, f1 bigint, f2 bigint, sig array<int>")
    rows = keyed(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id", "text")

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = T.shingle_sets(T.raw(batch.column(3)), SHINGLE_WORDS)
        f1 = np.array([np.bitwise_xor.reduce(T.mix(s)) if len(s) else 0 for s in sets], dtype=np.uint64)
        f2 = np.array([T.mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array([len(s) for s in sets], pa.int64()), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)),
             pa.array([signature(s) if len(s) else None for s in sets], pa.list_(pa.int32()))], names=schema.names)

    return T.map_groups(rows.select("id", *KEY, "text"), fn, schema)


def shingle_table(docs: DataFrame) -> DataFrame:
    """Per row (``rep``, ``text``): ``rep`` and ``shingles``, its whole set of hashes."""
    schema = "rep bigint, shingles array<bigint>"

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = T.shingle_sets(T.raw(batch.column(1)), SHINGLE_WORDS)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["rep", "shingles"])

    return T.map_groups(docs.select("rep", "text"), fn, schema)


def posts(reps: DataFrame, limits: Limits = CONTRACT) -> DataFrame:
    """Per representative that can have a link: ``rep``, ``n``, its shared
    (coordinate, value) pairs as numbers, rarest first, in ``pairs``."""
    pairs = reps.select("rep", "n", F.posexplode("sig").alias("k", "v")).select(
        "rep", "n", (F.shiftleft(F.col("k").cast("bigint"), 32) + F.col("v").cast("bigint") + F.lit(1 << 31)).alias("pair"))
    shared = pairs.groupBy("pair").agg(F.count("*").alias("df")).where("df > 1")
    ranked = pairs.join(shared, "pair").groupBy("rep", "n").agg(
        F.sort_array(F.collect_list(F.struct("df", "pair"))).alias("ranked"))  # at most one for each coordinate
    return ranked.where(F.size("ranked") >= limits.matches).select("rep", "n", F.col("ranked.pair").alias("pairs"))


def _similar_sizes(a: Column, b: Column, limits: Limits) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * limits.similarity


def _posted(post: DataFrame, limits: Limits) -> DataFrame:
    """The posts under the prefix: ``rep``, ``n``, ``pair``."""
    return post.select("rep", "n", F.explode(F.slice("pairs", F.lit(1), F.size("pairs") - (limits.matches - 1))).alias("pair"))


def candidates(post: DataFrame, limits: Limits = CONTRACT) -> DataFrame:
    """Distinct (``a``, ``b``, ``same``) of the posts with the pivots of their values."""
    posted, h = _posted(post, limits), F.xxhash64("rep")
    pivots = (posted.withColumn("slot", F.pmod(h, F.lit(SLOTS)))
              .groupBy("pair", "slot").agg(F.min(F.struct(h.alias("h"), "rep", "n")).alias("p"))
              .select("pair", F.col("p.rep").alias("p_rep"), F.col("p.n").alias("p_n")))
    met = posted.join(pivots, "pair").where((F.col("rep") != F.col("p_rep")) & _similar_sizes(F.col("n"), F.col("p_n"), limits))
    met = met.select(F.least("rep", "p_rep").alias("a"), F.greatest("rep", "p_rep").alias("b")).distinct()
    left = post.select(F.col("rep").alias("a"), F.col("pairs").alias("pa"))
    right = post.select(F.col("rep").alias("b"), F.col("pairs").alias("pb"))
    same = F.size(F.array_intersect("pa", "pb"))
    return met.join(left, "a").join(right, "b").select("a", "b", same.alias("same")).where(F.col("same") >= limits.matches)


def remaining_links(post: DataFrame, groups: DataFrame, sets: DataFrame, limits: Limits = CONTRACT) -> DataFrame:
    """Confirmed (``a``, ``b``) that join the groups of the posts of one value;
    ``groups`` has ``rep`` and ``grp`` of every representative in ``post``."""
    posted = _posted(post, limits).join(groups, "rep")
    weight = F.col("n") * 8 + 1024
    open_ = (posted.groupBy("pair").agg(F.min("grp").alias("lo"), F.max("grp").alias("hi"), F.sum(weight).alias("bytes"))
             .where("lo != hi").select("pair", F.ceil(F.col("bytes") / BLOCK_BYTES).alias("blocks")))
    mine = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    dealt = posted.select("rep", "pair").join(open_, "pair").select(
        "rep", "pair", mine.alias("block"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "rep", "pair", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    rows = dealt.join(post.select("rep", "pairs").join(groups, "rep").join(sets, "rep"), "rep")
    schema = "a bigint, b bigint, w int"

    def link(table: pa.Table) -> pa.Table:
        a, b = _block_links(table, limits)
        rep = table.column("rep")
        return pa.table([rep.take(pa.array(a, pa.int64())), rep.take(pa.array(b, pa.int64())), pa.array([1] * len(a), pa.int32())], names=["a", "b", "w"])

    return rows.groupBy("pair", "i", "j").applyInArrow(link, schema).select("a", "b").distinct()


def _block_links(table: pa.Table, limits: Limits) -> tuple[list[int], list[int]]:
    """Rows of one value in two blocks (or one): links that join their groups."""
    rank = table.column("pairs").to_pylist()
    value = table.column("pair")[0].as_py()
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    block = table.column("block").to_numpy()
    n = table.num_rows
    held = np.full((n, COORDINATES), -1, dtype=np.int64)
    before = np.zeros((n, COORDINATES), dtype=bool)
    for r, pairs in enumerate(rank):
        p = np.array(pairs, dtype=np.int64)
        held[r, p >> 32] = p
        before[r, p[:pairs.index(value)] >> 32] = True
    sets = table.column("shingles").combine_chunks()
    at, flat = sets.offsets.to_numpy(), sets.values.to_numpy()
    size = np.diff(at)
    group = np.unique(np.array(table.column("grp").to_pylist()), return_inverse=True)[1]
    out_a, out_b = [], []
    others = np.flatnonzero(block == j)
    for x in np.flatnonzero(block == i).tolist():
        ys = others[others > x] if i == j else others
        ys = ys[group[ys] != group[x]]
        small, large = np.minimum(size[ys], size[x]), np.maximum(size[ys], size[x])
        ys = ys[small * 100 >= large * limits.similarity]
        equal = (held[ys] == held[x]) & (held[x] >= 0)
        ys = ys[(equal.sum(axis=1) >= limits.matches) & ~(equal & before[x]).any(axis=1)]
        for y in ys.tolist():
            if group[x] == group[y]:
                continue
            both = len(np.intersect1d(flat[at[x]:at[x + 1]], flat[at[y]:at[y + 1]], assume_unique=True))
            if both * 100 >= (size[x] + size[y] - both) * limits.similarity:
                group[group == group[y]] = group[x]
                out_a.append(x)
                out_b.append(y)
    return out_a, out_b


def confirmed(pairs: DataFrame, sets: DataFrame, limits: Limits = CONTRACT) -> DataFrame:
    """The (``a``, ``b``) whose full sets have the similarity."""
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.select("a", "b").join(left, "a").join(right, "b")
            .select("a", "b", both.alias("both"), (F.size("sa") + F.size("sb") - both).alias("either"))
            .where(F.col("both") * 100 >= F.col("either") * limits.similarity).select("a", "b"))


def components(links: DataFrame) -> DataFrame:
    """(``node``, ``grp``): the smallest node that each linked node reaches, by
    alternating large-star and small-star steps until the links are stars."""
    e = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    e = T.kept(e, "links")
    before = None
    while True:
        both = e.union(e.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").union(least)
        e = T.kept(small.distinct(), "links")
        after = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == before:
            break
        before = after
    return e.select(F.col("u").alias("node"), F.col("v").alias("grp")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("grp")).distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limits: Limits = CONTRACT) -> DataFrame:
    """Per document: ``id_col``, ``n_shingles``, ``component_id``, ``kept``."""
    return _decided(docs, id_col, text_col, limits).select(F.col("id").alias(id_col), "n_shingles", "component_id", "kept")


def _decided(docs: DataFrame, id_col: str, text_col: str, limits: Limits) -> DataFrame:
    """Per document: ``id``, its ``KEY``, ``n_shingles``, ``component_id``, ``kept``."""
    feats = T.kept(features(docs, id_col, text_col), "features")
    top = F.struct(F.isnull("id").alias("none"), "id", *KEY)  # the smallest of a group names it and stays
    reps = feats.where("n > 0").groupBy("f1", "f2", "n").agg(F.min(top).alias("top"), F.first("sig").alias("sig"))
    reps = T.kept(reps.withColumn("rep", F.monotonically_increasing_id()), "representatives")
    post = T.kept(posts(reps, limits), "posts")
    named = reps.select("f1", "f2", "n", "rep", "top")
    if not post.isEmpty():
        groups = T.kept(_groups(docs, reps, post, id_col, text_col, limits), "groups")
        best = groups.join(named.select("rep", "top"), "rep").groupBy("grp").agg(F.min("top").alias("best"))
        named = named.join(groups.join(best, "grp").select("rep", "best"), "rep", "left").withColumn("top", F.coalesce("best", "top"))
    out = feats.drop("sig").join(named.select("f1", "f2", "n", "top"), ["f1", "f2", "n"], "left")
    some = F.col("n") > 0
    same = (F.col("__k1") == F.col("top.__k1")) & (F.col("__k2") == F.col("top.__k2"))
    return out.select("id", *KEY, F.col("n").alias("n_shingles"), F.when(some, F.col("top.id")).otherwise(F.col("id")).alias("component_id"),
                      F.when(some, same).otherwise(True).alias("kept"))


def _groups(docs: DataFrame, reps: DataFrame, post: DataFrame, id_col: str, text_col: str, limits: Limits) -> DataFrame:
    wanted = reps.join(post.select("rep"), "rep", "left_semi").select("rep", *(F.col(f"top.{k}").alias(k) for k in KEY))
    rows = keyed(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id", "text").drop("id")
    sets = T.kept(shingle_table(T.join_ids(rows, wanted, KEY, "inner")), "sets")
    if sets.count() > post.count():  # repeated rows
        sets = T.kept(sets.dropDuplicates(["rep"]), "sets")
    found = candidates(post, limits)
    best = found.groupBy("b").agg(F.max(F.struct("same", (-F.col("a")).alias("na"))).alias("x")).select((-F.col("x.na")).alias("a"), "b")
    links = T.kept(confirmed(best, sets, limits), "confirmed")
    groups = T.kept(_grouped(post, components(links)), "groups")
    more = T.kept(remaining_links(post, groups, sets, limits), "remaining")
    if more.isEmpty():
        return groups
    return _grouped(post, components(links.union(more)))


def _grouped(post: DataFrame, groups: DataFrame) -> DataFrame:
    """``rep`` and ``grp`` of every representative in ``post``."""
    g = groups.withColumnRenamed("node", "rep")
    return post.select("rep").distinct().join(g, "rep", "left").withColumn("grp", F.coalesce("grp", "rep"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limits: Limits = CONTRACT) -> DataFrame:
    """The documents, one of each group (the smallest id; of its repeated rows one)."""
    decided = T.kept(_decided(docs, id_col, text_col, limits).where("kept").groupBy(*KEY).agg(F.count("*").alias("__rows")), "decided")
    rows = keyed(docs, id_col, text_col)
    repeated = decided.where("__rows > 1").select(*KEY)
    if repeated.isEmpty():
        return T.join_ids(rows, decided.select(*KEY), KEY).drop(*KEY)
    twice = T.join_ids(rows, repeated, KEY).dropDuplicates(KEY)
    return T.join_ids(rows, decided.where("__rows = 1").select(*KEY), KEY).unionByName(twice).drop(*KEY)
