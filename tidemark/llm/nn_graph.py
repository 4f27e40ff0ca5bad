"""Approximate nearest neighbours by largest inner product: NN-descent and greedy graph search.

Equal vectors are one node with its smallest ids.  Nodes are dealt at random to
shards of bounded size; each shard is a graph of its own, and a query asks every
shard, as a search over sharded graphs does.

*Building.*  Nodes sorted by random-hyperplane codes, in several independent orders,
lie beside similar ones; runs of each order give the first neighbour lists.  Then
NN-descent, as Spark joins: neighbour lists and their reversals make the general
list of a node (``GENERAL`` of each kind, the newest first, then by hash: the
sampling of the published method), lists join lists into the neighbours of
neighbours, and these meet the vectors of their shard to be scored.  A round ends
it in which fewer than ``UPDATES`` of all list entries change.

*Searching.*  The graph is walked with its edges in both directions.  A query starts
from the nodes beside its own code in each of the orders and from nodes spread over
the shard, and opens the best unopened nodes of its beam until none is left.
The best are scored once more in double precision and expanded to the ids of their
vectors.

Inner products are reduced to distances between nodes by one more coordinate
``sqrt(R - |x|^2)``, R the largest squared norm of the shard; queries have 0 there.

Edge cases: rows without id, with a null or zero vector or with a null or non-finite
component take no part; vectors are compared with vectors of their length only;
ties go to the smaller id; repeated ids are candidates each, and a query is never
answered with its own id; a query row that occurs twice is answered once for each;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import _text as T

K = 20
#: Entries of a node's list; entries of each kind that a round joins; rounds at most.
DEGREE, GENERAL, ROUNDS, UPDATES = 24, 6, 8, 0.1
#: Orders by code, bits of a code, nodes of a run that are compared.
ORDERS, BITS, RUN = 6, 63, 96
SHARD_ROWS, QUERY_ROWS = 1 << 14, 1 << 15
#: Beam of a search, nodes opened at a time, queries walked together; starts beside the
#: query's code on each side in every order, and starts spread over the shard.
BEAM, OPENED, TOGETHER, BESIDE, SPREAD = 160, 8, 64, 6, 32


def vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id`` and ``v`` (doubles) of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & ~bad & F.exists(v, lambda x: x != 0)).select(
        F.col(id_col).cast("bigint").alias("id"), v.alias("v"))


def nodes(rows: DataFrame, ids: int) -> tuple[DataFrame, DataFrame]:
    """One row (``node``, ``v``) for each vector, and its ``ids`` smallest ids (``node``,
    ``id``); ``node`` is the smallest.  Spark cuts each vector's rows to that number
    before it moves them."""
    order = Window.partitionBy("v").orderBy("id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = T.kept(rows.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= ids)
                    .withColumn("node", F.first("id").over(order)), "members")
    return ranked.where("nth = 1").select("node", "v"), ranked.select("node", "id")


# -- kernels over one shard -----------------------------------------------------------

@lru_cache(maxsize=8)
def _planes(width: int) -> np.ndarray:
    return np.random.default_rng(width).normal(size=(width, ORDERS * BITS)).astype(np.float32)


def codes(x: np.ndarray) -> np.ndarray:
    """Per vector and order the sides of ``BITS`` random hyperplanes as an integer."""
    side = (x.astype(np.float32) @ _planes(x.shape[1]) > 0).reshape(len(x), ORDERS, BITS)
    return side.astype(np.int64) @ (np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def lifted(x: np.ndarray) -> np.ndarray:
    """Vectors with one more coordinate, all of one norm."""
    y = x / max(1e-300, float(np.abs(x).max(initial=0)))
    norm = (y * y).sum(axis=1)
    return np.column_stack([y, np.sqrt(np.maximum(norm.max(initial=0) - norm, 0))]).astype(np.float32)


def merged(nbrs: np.ndarray, sims: np.ndarray, new: np.ndarray, more: np.ndarray, more_sims: np.ndarray, degree: int):
    """Lists (rows of -1-padded node numbers) merged with further candidates: the
    ``degree`` best distinct ones, with a mark of those that came in."""
    ids, s = np.concatenate([nbrs, more], axis=1), np.concatenate([sims, more_sims], axis=1)
    fresh = np.concatenate([new, np.ones(more.shape, dtype=bool)], axis=1)
    s = np.where(ids < 0, -np.inf, s)
    order = np.argsort(ids, axis=1, kind="stable")  # of equal ids the listed one first
    ids, s, fresh = (np.take_along_axis(a, order, 1) for a in (ids, s, fresh))
    s[:, 1:][ids[:, 1:] == ids[:, :-1]] = -np.inf
    order = np.argsort(-s, axis=1, kind="stable")[:, :degree]
    ids, s, fresh = (np.take_along_axis(a, order, 1) for a in (ids, s, fresh))
    none = np.isneginf(s)
    return np.where(none, -1, ids), s, fresh & ~none


def first_lists(x: np.ndarray, degree: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lists from runs of every order."""
    n, y, c = len(x), lifted(x), codes(x)
    nbrs = np.full((n, degree), -1, dtype=np.int64)
    sims, new = np.full((n, degree), -np.inf, dtype=np.float32), np.zeros((n, degree), dtype=bool)
    for o in range(ORDERS):
        order = np.argsort(c[:, o], kind="stable")
        starts = range(0, n, RUN) if o % 2 == 0 else range(-RUN // 2, n, RUN)
        for a in starts:
            at = order[max(0, a):a + RUN]
            if len(at) < 2:
                continue
            s = y[at] @ y[at].T
            np.fill_diagonal(s, -np.inf)
            best = np.argsort(-s, axis=1)[:, :min(degree, len(at) - 1)]
            nbrs[at], sims[at], new[at] = merged(nbrs[at], sims[at], new[at], at[best], np.take_along_axis(s, best, 1), degree)
    return nbrs, sims, new


class Graph:
    """One shard ready to be searched: vectors, and lists with their reversals."""

    def __init__(self, x: np.ndarray, nbrs: np.ndarray) -> None:
        self.x, self.y = x, x.astype(np.float32)
        n, d = nbrs.shape
        a, b = np.repeat(np.arange(n), d), nbrs.ravel()
        a, b = np.concatenate([a, b])[np.tile(b >= 0, 2)], np.concatenate([b, a])[np.tile(b >= 0, 2)]
        order = np.argsort(a, kind="stable")  # own entries come before reversed ones
        a, b = a[order], b[order]
        place = np.arange(len(a)) - np.searchsorted(a, a)
        fits = place < 2 * d
        self.edges = np.full((n, 2 * d), -1, dtype=np.int64)
        self.edges[a[fits], place[fits]] = b[fits]
        c = codes(x)
        self.orders = [(o := np.argsort(c[:, j], kind="stable"), c[o, j]) for j in range(ORDERS)]
        self.spread = np.unique(np.linspace(0, n - 1, min(n, SPREAD)).astype(np.int64))

    def starts(self, q: np.ndarray) -> np.ndarray:
        c, n = codes(q), len(self.x)
        out = [np.broadcast_to(self.spread, (len(q), len(self.spread)))]
        for j, (order, sorted_codes) in enumerate(self.orders):
            at = np.searchsorted(sorted_codes, c[:, j])[:, None] + np.arange(-BESIDE, BESIDE)
            out.append(order[np.clip(at, 0, n - 1)])
        return np.concatenate(out, axis=1)

    def search(self, q: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the ``beam`` best nodes found for each query, -1 where there are fewer."""
        m, rows = len(q), np.arange(len(q))[:, None]
        p = (q / np.abs(q).max(axis=1, keepdims=True)).astype(np.float32)
        seen = np.zeros((m, len(self.x) + 1), dtype=bool)  # the last place is for -1
        ids, s = np.full((m, beam), -1, dtype=np.int64), np.full((m, beam), -np.inf, dtype=np.float32)
        opened = np.zeros((m, beam), dtype=bool)
        more = self.starts(q)
        while True:
            more = np.sort(more, axis=1)
            more[:, 1:][more[:, 1:] == more[:, :-1]] = -1
            more[seen[rows, more]] = -1
            seen[rows, more] = True
            i, j = np.nonzero(more >= 0)
            score = np.full(more.shape, -np.inf, dtype=np.float32)
            score[i, j] = np.einsum("ij,ij->i", self.y[more[i, j]], p[i])
            ids, s = np.concatenate([ids, more], axis=1), np.concatenate([s, score], axis=1)
            opened = np.concatenate([opened, np.zeros(more.shape, dtype=bool)], axis=1)
            order = np.argpartition(-s, beam - 1, axis=1)[:, :beam]
            ids, s, opened = (np.take_along_axis(a, order, 1) for a in (ids, s, opened))
            waiting = np.where(opened | np.isneginf(s), -np.inf, s)
            if np.isneginf(waiting).all():
                return np.where(np.isneginf(s), -1, ids), s
            nxt = np.argpartition(-waiting, min(OPENED, beam) - 1, axis=1)[:, :OPENED]
            usable = ~np.isneginf(np.take_along_axis(waiting, nxt, 1))
            np.put_along_axis(opened, nxt, np.take_along_axis(opened, nxt, 1) | usable, 1)
            at = np.where(usable, np.take_along_axis(ids, nxt, 1), -1)
            more = np.where(at[:, :, None] >= 0, self.edges[at], -1).reshape(m, at.shape[1] * self.edges.shape[1])

    def nearest(self, q: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each query the places and double-precision scores of all found that are
        not below the ``k``-th best (ties beyond it, and equal vectors' own ids, need them)."""
        beam = max(BEAM, 4 * k)
        for a in range(0, len(q), TOGETHER):
            places, s = self.search(q[a:a + TOGETHER], beam)
            for one, at, approx in zip(q[a:a + TOGETHER], places, s, strict=True):
                at = at[at >= 0]
                exact = (self.x[at] * one).sum(axis=1)
                if len(at) > k:
                    keep = exact >= np.partition(exact, len(exact) - k)[len(exact) - k]
                    at, exact = at[keep], exact[keep]
                yield at, exact


# -- the graph as a table ---------------------------------------------------------------

GRAPH = "width int, shard int, node bigint, v array<double>, nbrs array<bigint>, sims array<float>, fresh array<boolean>"
_SHARD = ["width", "shard"]


def _lists(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)[:]


def _square(column: pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as a matrix."""
    at, flat = _lists(column)
    return flat[at[0]:at[-1]].reshape(len(at) - 1, -1)


def _padded(column: pa.ChunkedArray, fill: float, kind: type) -> np.ndarray:
    at, flat = _lists(column)
    size = np.diff(at)
    out = np.full((len(size), int(size.max(initial=0))), fill, dtype=kind)
    mask = np.arange(out.shape[1]) < size[:, None]
    out[mask] = flat[at[0]:at[-1]]
    return out


def _graph_table(t: pa.Table, node: np.ndarray, nbrs: np.ndarray, sims: np.ndarray, fresh: np.ndarray) -> pa.Table:
    """The shard's rows with its lists (places become nodes)."""
    keep = nbrs >= 0
    at = pa.array(np.concatenate([[0], np.cumsum(keep.sum(axis=1))]), pa.int32())
    make = lambda values, kind: pa.ListArray.from_arrays(at, pa.array(values, kind))
    return pa.table([t.column("width"), t.column("shard"), t.column("node"), t.column("v"), make(node[nbrs[keep]], pa.int64()),
                     make(sims[keep], pa.float32()), make(fresh[keep], pa.bool_())],
                    names=["width", "shard", "node", "v", "nbrs", "sims", "fresh"])


def _begin(t: pa.Table) -> pa.Table:
    return _graph_table(t, t.column("node").to_numpy(), *first_lists(_square(t.column("v")), DEGREE))


def _score(graph: pa.Table, found: pa.Table) -> pa.Table:
    """The lists of a shard after its neighbours of neighbours are scored."""
    order = np.argsort(graph.column("node").to_numpy())
    t = graph.take(order)
    node, y = t.column("node").to_numpy(), lifted(_square(t.column("v")))
    nbrs, sims, fresh = (_padded(t.column(c), f, k) for c, f, k in (("nbrs", -1, np.int64), ("sims", -np.inf, np.float32), ("fresh", False, bool)))
    pad = DEGREE - nbrs.shape[1]
    nbrs, sims = (np.pad(a, ((0, 0), (0, pad)), constant_values=f) for a, f in ((nbrs, -1), (sims, -np.inf)))
    nbrs, fresh = np.where(nbrs >= 0, np.searchsorted(node, nbrs), -1), np.zeros((len(node), DEGREE), dtype=bool)
    at = np.searchsorted(node, found.column("of_node").to_numpy())
    offsets, flat = _lists(found.column("found"))
    flat = np.searchsorted(node, flat)
    for a in range(0, len(at), 1024):
        sub, o = at[a:a + 1024], offsets[a:a + 1025]
        size = np.diff(o)
        more = np.full((len(sub), int(size.max(initial=0))), -1, dtype=np.int64)
        more[np.arange(more.shape[1]) < size[:, None]] = flat[o[0]:o[-1]]
        i, j = np.nonzero((more >= 0) & (more != sub[:, None]))
        s = np.full(more.shape, -np.inf, dtype=np.float32)
        s[i, j] = np.einsum("ij,ij->i", y[more[i, j]], y[sub[i]])
        more[np.isneginf(s)] = -1
        nbrs[sub], sims[sub], fresh[sub] = merged(nbrs[sub], sims[sub], fresh[sub], more, s, DEGREE)
    return _graph_table(t, node, nbrs, sims, fresh)


def _neighbours_of_neighbours(graph: DataFrame) -> DataFrame:
    """``found`` per node: all nodes in the general lists of the nodes in its general
    list; pairs both of whose edges are old have met before and are left out."""
    edges = graph.select("width", "shard", "node", F.explode(F.arrays_zip("nbrs", "fresh")).alias("e")).select(
        "width", "shard", "node", F.col("e.nbrs").alias("nbr"), F.col("e.fresh").alias("fresh"))
    back = edges.select("width", "shard", F.col("nbr").alias("node"), F.col("node").alias("nbr"), "fresh")

    def some(side: DataFrame) -> DataFrame:
        order = Window.partitionBy(*_SHARD, "node").orderBy(F.desc("fresh"), F.xxhash64("node", "nbr"))
        return side.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= GENERAL).drop("nth")

    both = some(edges).unionByName(some(back)).groupBy(*_SHARD, "node", "nbr").agg(F.max("fresh").alias("fresh"))
    lists = both.groupBy(*_SHARD, "node").agg(F.collect_list("nbr").alias("all"), F.array_compact(F.collect_list(F.when(F.col("fresh"), F.col("nbr")))).alias("young"))
    step = both.join(lists.withColumnRenamed("node", "nbr"), [*_SHARD, "nbr"])
    reached = step.select(*_SHARD, "node", F.when(F.col("fresh"), F.col("all")).otherwise(F.col("young")).alias("found"))
    return reached.groupBy(*_SHARD, "node").agg(F.array_distinct(F.flatten(F.collect_list("found"))).alias("found"))


def build(points: DataFrame) -> DataFrame:
    """The neighbour graph (``GRAPH``) of ``node`` and ``v``, by shards."""
    spark = points.sparkSession
    T.bounded_batches(spark)
    shards = max(math.ceil(points.count() / SHARD_ROWS), min(8, spark.sparkContext.defaultParallelism))
    dealt = points.select(F.size("v").alias("width"), F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int").alias("shard"), "node", "v")
    graph = T.kept(dealt.groupBy(*_SHARD).applyInArrow(_begin, GRAPH), "graph")
    for _ in range(ROUNDS):
        found = _neighbours_of_neighbours(graph).toDF("of_width", "of_shard", "of_node", "found")
        graph = T.kept(graph.groupBy(*_SHARD).cogroup(found.groupBy("of_width", "of_shard")).applyInArrow(_score, GRAPH), "graph")
        changed, entries = graph.select(F.sum(F.size(F.filter("fresh", lambda x: x))), F.sum(F.size("nbrs"))).first()
        if (changed or 0) <= UPDATES * (entries or 0):
            break
    return graph


def search(graph: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``row``, ``query_id``, ``node``, ``score``: what the shards find for every query (``row``, ``id``, ``v``)."""
    spark = graph.sparkSession
    T.bounded_batches(spark)
    blocks = max(1, math.ceil(queries.count() / QUERY_ROWS))
    shards = graph.select(*_SHARD).distinct().toDF("width", "of_shard")  # one row a shard
    asked = (queries.select("row", F.col("id").alias("query_id"), "v", F.size("v").alias("width"), F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"))
             .join(shards, "width"))
    given = graph.select(*_SHARD, "node", "v", "nbrs", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))

    def run(data: pa.Table, qs: pa.Table) -> pa.Table:
        names = ["row", "query_id", "node", "score"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        if not data.num_rows or not qs.num_rows:
            return pa.table([pa.array([], t) for t in kinds], names=names)
        t = data.take(np.argsort(data.column("node").to_numpy()))
        node, nbrs = t.column("node").to_numpy(), _padded(t.column("nbrs"), -1, np.int64)
        g = Graph(_square(t.column("v")), np.where(nbrs >= 0, np.searchsorted(node, nbrs), -1))
        at, score, size = [], [], []
        for places, exact in g.nearest(_square(qs.column("v")), k):
            at.append(node[places])
            score.append(exact)
            size.append(len(places))
        spread = lambda c: np.repeat(qs.column(c).to_numpy(), size)
        return pa.table([pa.array(x, kind) for x, kind in zip((spread("row"), spread("query_id"), np.concatenate(at), np.concatenate(score)), kinds, strict=True)], names=names)

    return given.groupBy(*_SHARD, "block").cogroup(asked.groupBy("width", "of_shard", "block")).applyInArrow(run, "row bigint, query_id bigint, node bigint, score double")


def neighbours(rows: DataFrame, is_query, k: int = K) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: for every row of ``vectors`` that
    satisfies ``is_query`` the ``k`` nearest found among all others."""
    rows = T.kept(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    points, members = nodes(rows.select("id", "v"), k + 1)
    found = search(build(points), rows.where(is_query), k + 1)
    order = Window.partitionBy("row").orderBy(F.desc("score"), "node")
    best = found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k + 1)
    one = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return (best.join(members.withColumnRenamed("id", "vec_id"), "node").where(F.col("vec_id") != F.col("query_id"))
            .withColumn("rank", F.row_number().over(one)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
