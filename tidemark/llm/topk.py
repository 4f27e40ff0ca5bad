"""Exact top-k search by inner product over M-trees.

Vectors are integers.  With R the largest squared norm, every vector gets one
more coordinate ``sqrt(R - |x|^2)`` and a query 0; the squared distance between
them is then ``|q|^2 + R - 2 q.x``, so the nearest vectors are those of the
largest inner product, and distance is a metric that an M-tree can index.

The rows are dealt to blocks of bounded size at random.  A task builds the
M-tree of its block: paged nodes, each with a routing vector, a covering radius
and the distances of its entries to the routing vector.  Blocks of queries meet
blocks of rows; each query walks a tree best first and skips nodes by covering
radius and entries by ``|d(q, parent) - d(x, parent)|`` before any distance is
computed.  Per query and block at most k rows go on to the final ranking.

Equal vectors are one entry of a tree with their k + 1 smallest ids, which are
the only ones that can be among the k best.

Edge cases: rows without id or with a null vector, a null or non-finite component
take no part; vectors are compared with vectors of their length only; ties go to
the smaller id; repeated ids count as one candidate each, but a query is never answered
with its own id; a query row that occurs twice is answered once for each; an empty
table gives no rows; scores that exceed 64 bits raise an error; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import _text as T

K = 20
SCALE = 64
PAGE = 512
FANOUT = 16
BLOCK_ROWS = 1 << 15
#: Each block of rows travels to every block of queries, so those are large.
QUERY_ROWS = 1 << 14


class MTree:
    """Over the distinct rows of ``x`` (integers); ``ids`` ascending per row."""

    def __init__(self, x: np.ndarray, ids: list[np.ndarray]) -> None:
        self.x, self.ids = x, ids
        self.largest = float(np.abs(x).max(initial=0.0))
        self.exact = self.largest ** 2 * x.shape[1] < 2**51  # floating point holds the products
        y = x.astype(np.float64 if self.exact else object)
        self.norm = (y * y).sum(axis=1)
        self.bound = float(self.norm.max(initial=0))
        p = np.column_stack([x.astype(np.float64), np.sqrt(np.maximum(self.bound - self.norm.astype(np.float64), 0))])
        self.p = p
        self.root = self._node(np.arange(len(x)), None) if len(x) else None

    def _node(self, rows: np.ndarray, parent: np.ndarray | None) -> dict:
        """A leaf page of at most PAGE rows, or an inner node of at most FANOUT children."""
        centre = self.p[rows[len(rows) // 2]] if parent is None else parent
        far = np.sqrt(((self.p[rows] - centre) ** 2).sum(axis=1))
        node = {"centre": centre, "radius": float(far.max())}
        if len(rows) <= PAGE:
            order = np.argsort(far, kind="stable")
            rows = rows[order]
            values = self.x[rows].astype(np.float64 if self.exact else object)  # the page's own copy
            return node | {"rows": rows, "far": far[order], "values": values}
        pick = rows[np.unique(np.linspace(0, len(rows) - 1, min(FANOUT, math.ceil(len(rows) / PAGE))).astype(int))]
        c = self.p[pick]
        d = (c ** 2).sum(axis=1) - 2 * self.p[rows] @ c.T
        nearest = d.argmin(axis=1)
        sizes = np.bincount(nearest, minlength=len(pick))
        if sizes.max() == len(rows):  # nothing was divided: halve by place
            nearest = (np.arange(len(rows)) * 2 // len(rows))
        children = [self._node(rows[nearest == k], self.p[rows[nearest == k][0]] if sizes.max() == len(rows) else c[k])
                    for k in range(len(pick)) if (nearest == k).any()]
        centres = np.array([x["centre"] for x in children])
        return node | {"children": children, "centres": centres, "radii": np.array([x["radius"] for x in children]),
                       "far": np.sqrt(((centres - centre) ** 2).sum(axis=1))}

    def _floats(self, q: np.ndarray) -> bool:
        return self.exact and float(np.abs(q).max(initial=0.0)) * self.largest * len(q) < 2**52

    def search(self, q: np.ndarray, own: int | None, k: int) -> list[tuple[int, int]]:
        """The k best (score, id), ties to the smaller id, without id ``own``."""
        if self.root is None:
            return []
        point = np.append(q.astype(np.float64), 0.0)
        slack = 1e-6 * (1 + math.sqrt(self.bound) + float(np.linalg.norm(point)))
        asked = q.astype(np.float64) if self._floats(q) else q.astype(object)
        best: list[tuple[int, int]] = []  # heap of (score, -id)
        limit = math.inf  # distance of the k-th best
        d0 = float(np.linalg.norm(self.root["centre"] - point))
        todo = [(max(0.0, d0 - self.root["radius"]), 0, d0, self.root)]
        n = 0
        while todo:
            low, _, d, node = heapq.heappop(todo)
            if low > limit:
                break
            if "rows" in node:
                near = np.flatnonzero(np.abs(node["far"] - d) <= limit + slack)
                if not len(near):
                    continue
                s = (node["values"] @ asked) if 2 * len(near) > len(node["far"]) else node["values"][near] @ asked
                s = s[near] if len(s) > len(near) else s
                # More than k + 1 entries of a page (one may be the query) are never needed, but for ties.
                least = max(np.partition(s, -k - 1)[-k - 1] if len(s) > k else -math.inf, best[0][0] if len(best) == k else -math.inf)
                hit = np.flatnonzero(s >= least)
                for v, row in zip(s[hit].tolist(), node["rows"][near[hit]].tolist(), strict=True):
                    for i in self.ids[row]:
                        if i == own:
                            continue
                        if len(best) < k:
                            heapq.heappush(best, (int(v), -i))
                        elif (v, -i) > best[0]:
                            heapq.heapreplace(best, (int(v), -i))
                if len(best) == k:
                    limit = math.sqrt(max(0.0, float(point @ point) + self.bound - 2 * best[0][0])) + slack
                continue
            hope = np.flatnonzero(np.abs(node["far"] - d) - node["radii"] <= limit)
            if len(hope):
                far = np.sqrt(((node["centres"][hope] - point) ** 2).sum(axis=1))
                for j, f in zip(hope.tolist(), far.tolist(), strict=True):
                    lower = max(0.0, f - node["radii"][j] - slack)
                    if lower <= limit:
                        n += 1
                        heapq.heappush(todo, (lower, n, f, node["children"][j]))
        return sorted(((s, -i) for s, i in best), key=lambda t: (-t[0], t[1]))


def integers(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``id`` and ``v`` (array of bigint: floor of ``scale`` times each component)
    of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & ~bad).select(
        F.col(id_col).cast("bigint").alias("id"), F.transform(v, lambda x: F.floor(x * scale).cast("bigint")).alias("v"))


def top_k(rows: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``; ``rows`` and ``queries`` have
    ``id`` and ``v``.  Query blocks and row blocks are as many as their sizes ask for."""
    rows, queries = T.kept(rows, "vectors"), T.kept(queries.select("id", "v").withColumn("q", F.monotonically_increasing_id()), "queries")
    n_rows, n_queries = (max(1, math.ceil(df.count() / size)) for df, size in ((rows, BLOCK_ROWS), (queries, QUERY_ROWS)))
    n_rows = max(n_rows, min(8, rows.sparkSession.sparkContext.defaultParallelism))
    block = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.select("id", "v", block(n_rows).alias("b")).select("id", "v", "b", every(n_queries).alias("c"))
    right = queries.select("q", "id", "v", block(n_queries).alias("c")).select("q", "id", "v", every(n_rows).alias("b"), "c")

    def search(data: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, int]] = []
        widths = np.diff(asked.column("v").combine_chunks().offsets.to_numpy())
        for width in np.unique(widths):
            tree = _tree(data, int(width), k)  # once for all queries of the block
            for one in asked.take(np.flatnonzero(widths == width)).to_batches(max_chunksize=1024):
                for q, i, v in zip(one.column("q").to_pylist(), one.column("id").to_pylist(), one.column("v").to_pylist(), strict=True):
                    out += [(q, i, j, int(s)) for s, j in tree.search(np.array(v or [0], dtype=np.int64), i, k)]
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else ([], [], [], []))], names=["q", "query_id", "vec_id", "score"])

    T.bounded_batches(rows.sparkSession)
    found = left.groupBy("b", "c").cogroup(right.groupBy("b", "c")).applyInArrow(search, "q bigint, query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _tree(data: pa.Table, width: int, k: int) -> MTree:
    column = data.column("v").combine_chunks()
    at, flat = column.offsets.to_numpy(), column.values.to_numpy()
    ids = data.column("id").to_numpy()
    right = np.flatnonzero(np.diff(at) == width)
    x = flat[at[right][:, None] + np.arange(width)] if width else np.zeros((len(right), 1), np.int64)
    order = np.lexsort((ids[right], *x.T[::-1]))
    x, ids = x[order], ids[right][order]
    if not len(x):
        return MTree(x, [])
    first = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]).any(axis=1)]))
    return MTree(x[first], [m[:k + 1].tolist() for m in np.split(ids, first[1:])])
