"""Hard-negative mining by angular triangle filtering.

A few reference directions are chosen once.  Every row stores its norm and its
angle to each of them.  Angles obey the triangle inequality, so the angles of an
anchor and a row to one direction r bound the angle between the two:

    |angle(a, r) - angle(x, r)| <= angle(a, x) <= angle(a, r) + angle(x, r)

(and at most ``2 pi`` less that sum).  The tightest bounds over all directions are
an interval of the cosine; times both norms, and widened by what rounding can
change, it is a window that surely holds the integer score.  Only rows whose
window overlaps the scores asked for get their integer product computed: for
positives the scores above the k-th best lower end, for negatives the union of
``[80 % of a positive's score, that score]``.

Rows meet anchors in blocks, both of bounded size, dealt at random.  A task sends
on at most k rows per anchor (or per anchor and positive); the final ranking sees
only those.

Edge cases: rows without id, without label, with a null vector or with a null or
non-finite component take no part; vectors are compared with vectors of their
length only; a zero vector scores 0 with every other; ties go to the smaller id;
a row is never its own partner, another row with the same id may be, and two
anchor rows with one id each give their results; a negative positive score leaves
no room for negatives; an empty table gives no rows; scores that exceed 64 bits
raise an error; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import _text as T

SCALE = 256
PARTNERS = 5
LOWEST_PERCENT = 80
#: Reference directions, and the rows of the sample from which they are chosen.
DIRECTIONS, SAMPLE_ROWS = 16, 512
BLOCK_ROWS, ANCHOR_ROWS = 1 << 15, 1 << 12
#: Rows scored at once while the windows fill.
CHUNK = 256
#: Stored angles are 32-bit; the arc cosine near 1 loses half of the digits of a product.
ANGLE_SLACK = 2e-6


def prepared(vectors: DataFrame, label: Column | str = "label", id_col: str = "vec_id", vector_col: str = "embedding",
             scale: int = SCALE) -> DataFrame:
    """``id``, ``label`` and ``v`` (floor of ``scale`` times each component) of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    label = F.col(label) if isinstance(label, str) else label
    return vectors.where(F.col(id_col).isNotNull() & label.isNotNull() & F.col(vector_col).isNotNull() & ~bad).select(
        F.col(id_col).cast("bigint").alias("id"), label.cast("bigint").alias("label"),
        F.transform(v, lambda x: F.floor(x * scale).cast("bigint")).alias("v"))


# -- directions and stored angles -----------------------------------------------------

def directions(rows: DataFrame, count: int = DIRECTIONS, sample: int = SAMPLE_ROWS) -> dict[int, np.ndarray]:
    """Unit vectors by vector length: of the ``sample`` rows with the smallest hash of
    their id, greedily those that are farthest from the ones taken."""
    by: dict[int, list] = {}
    for r in rows.select("id", "v").orderBy(F.xxhash64("id"), "id").limit(sample).collect():
        by.setdefault(len(r.v), []).append(r.v)
    out = {}
    for width, vs in by.items():
        x = np.array(vs, dtype=np.float64)
        norm = np.sqrt((x * x).sum(axis=1))
        x = x[norm > 0] / norm[norm > 0, None]
        if not width or not len(x):
            continue
        taken, nearest = [0], x @ x[0]
        while len(taken) < min(count, len(x)):
            taken.append(int(nearest.argmin()))
            nearest = np.maximum(nearest, x @ x[taken[-1]])
        out[width] = x[taken]
    return out


def unit_directions(width: int, known: dict[int, np.ndarray], count: int = DIRECTIONS) -> np.ndarray:
    """The chosen directions, or for a length that the sample does not show, seeded ones."""
    if width not in known:
        x = np.random.default_rng(width).normal(size=(count, width))
        known[width] = x / np.sqrt((x * x).sum(axis=1))[:, None] if width else x
    return known[width]


def with_angles(rows: DataFrame, known: dict[int, np.ndarray]) -> DataFrame:
    """Adds ``row`` (a key of the row), ``norm`` and ``angles`` to every row; written once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            norms, angles = [], []
            for v in b.column("v").to_pylist():
                x = np.array(v, dtype=np.float64)
                n = math.sqrt(float(x @ x))
                c = unit_directions(len(x), known) @ x / n if n else np.zeros(len(unit_directions(len(x), known)))
                norms.append(n)
                angles.append(np.arccos(np.clip(c, -1, 1)).astype(np.float32))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(norms, pa.float64()), pa.array(angles, pa.list_(pa.float32()))],
                                             names=[*b.schema.names, "norm", "angles"])

    T.bounded_batches(rows.sparkSession)
    keyed = rows.withColumn("row", F.monotonically_increasing_id())
    return T.kept(keyed.mapInArrow(run, "id bigint, label bigint, v array<bigint>, row bigint, norm double, angles array<float>"), "angles")


def score_windows(norm: float, angles: np.ndarray, norms: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest integer score that each other row can have with this one."""
    least = np.abs(others - angles).max(axis=1, initial=0.0)
    both = others + angles
    most = np.minimum(both, 2 * math.pi - both).min(axis=1, initial=math.pi)
    size = norm * norms
    pad = 1 + 1e-9 * size
    return (np.floor(size * np.cos(np.minimum(most + ANGLE_SLACK, math.pi)) - pad),
            np.ceil(size * np.cos(np.maximum(least - ANGLE_SLACK, 0.0)) + pad))


def _order(t: tuple[int, int]) -> tuple[int, int]:
    return -t[0], t[1]


# -- one block of rows ------------------------------------------------------------------

class Block:
    """The rows of one vector length in a task, by label."""

    def __init__(self, t: pa.Table, keep: np.ndarray, width: int) -> None:
        label = t.column("label").to_numpy()[keep]
        order = keep[np.argsort(label, kind="stable")]
        self.label = np.sort(label, kind="stable")
        self.id, self.row, self.norm = (t.column(c).to_numpy()[order] for c in ("id", "row", "norm"))
        self.x = _matrix(t.column("v"), order, width, np.int64)
        self.angles = _matrix(t.column("angles"), order, None, np.float64)
        self.largest = float(np.abs(self.x).max(initial=0))

    def scores(self, at: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Exact integer products of rows ``at`` with ``q``; floating point where it holds them."""
        small = float(np.abs(q).max(initial=0)) * self.largest * max(1, len(q)) < 2**52
        if small:
            return (self.x[at].astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
        return self.x[at].astype(object) @ q.astype(object)

    def of_label(self, label: int) -> tuple[int, int]:
        return int(np.searchsorted(self.label, label)), int(np.searchsorted(self.label, label, "right"))

    def best(self, at: np.ndarray, score: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The k first (score, id) by score descending, id ascending."""
        if len(at) > 8 * k:  # ties with the k-th score stay in
            kth = np.partition(score, len(score) - k)[len(score) - k]
            at, score = at[score >= kth], score[score >= kth]
        return sorted(zip(score.tolist(), self.id[at].tolist(), strict=True), key=_order)[:k]

    def positives(self, a: dict, k: int) -> list[tuple[int, int]]:
        """The anchor's k best other rows of its label."""
        lo, hi = self.of_label(a["label"])
        at = np.arange(lo, hi)
        at = at[self.row[lo:hi] != a["row"]]
        low, high = score_windows(a["norm"], a["angles"], self.norm[at], self.angles[at])
        least = np.partition(low, len(low) - k)[len(low) - k] if len(low) >= k else -math.inf
        at, high = at[high >= least], high[high >= least]
        order = np.argsort(-high, kind="stable")
        found: list[tuple[int, int]] = []
        for i in range(0, len(order), CHUNK):
            part = order[i:i + CHUNK]
            if len(found) == k and high[part[0]] < found[-1][0]:
                break
            part = part[high[part] >= found[-1][0]] if len(found) == k else part
            new = self.best(at[part], self.scores(at[part], a["v"]), k)
            found = sorted([*found, *new], key=_order)[:k]
        return found

    def negatives(self, a: dict, asked: dict[int, int], k: int) -> dict[int, list[tuple[int, int]]]:
        """For every score of ``asked`` (highest score: lowest one) the k best rows of another label in between."""
        lo, hi = self.of_label(a["label"])
        at = np.concatenate([np.arange(lo), np.arange(hi, len(self.id))])
        low, high = score_windows(a["norm"], a["angles"], self.norm[at], self.angles[at])
        overlaps = np.zeros(len(at), dtype=bool)
        for top, bottom in asked.items():
            overlaps |= (low <= top) & (high >= bottom)
        at, high = at[overlaps], high[overlaps]
        order = np.argsort(-high, kind="stable")
        found: dict[int, list] = {top: [] for top in asked}
        for i in range(0, len(order), CHUNK):
            part = order[i:i + CHUNK]
            wanted = min(f[-1][0] if len(f) == k else asked[top] for top, f in found.items())
            if high[part[0]] < wanted:
                break
            rows = at[part[high[part] >= wanted]]
            score = self.scores(rows, a["v"])
            for top, bottom in asked.items():
                fits = (score <= top) & (score >= bottom)
                if fits.any():
                    found[top] = sorted([*found[top], *self.best(rows[fits], score[fits], k)], key=_order)[:k]
        return found


def _matrix(column: pa.ChunkedArray, rows: np.ndarray, width: int | None, kind: type) -> np.ndarray:
    """The lists of ``rows``, all of one length, as a matrix."""
    column = column.combine_chunks()
    at = column.offsets.to_numpy()
    width = (int(at[rows[0] + 1] - at[rows[0]]) if len(rows) else 0) if width is None else width
    return column.values.to_numpy(zero_copy_only=False)[at[rows][:, None] + np.arange(width)].astype(kind)


def _lengths(t: pa.Table) -> np.ndarray:
    return np.diff(t.column("v").combine_chunks().offsets.to_numpy())


def _in_blocks(rows: DataFrame, anchors: DataFrame, work: Callable[[Block, dict], list[tuple]], names: list[str]) -> DataFrame:
    """``work`` for every anchor and every block of rows of its length; bigint columns ``names``."""
    spark = rows.sparkSession
    n_rows = max(math.ceil(rows.count() / BLOCK_ROWS), min(8, spark.sparkContext.defaultParallelism))
    n_anchors = max(1, math.ceil(anchors.count() / ANCHOR_ROWS))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    block = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    left = rows.select("*", block(n_rows).alias("b")).select("*", every(n_anchors).alias("c"))
    right = anchors.select("*", block(n_anchors).alias("c")).select("*", every(n_rows).alias("b"))

    def run(data: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple] = []
        have, want = _lengths(data), _lengths(asked)
        for width in np.unique(want):
            keep = np.flatnonzero(have == width)
            if not len(keep):
                continue
            b = Block(data, keep, int(width))
            for a in asked.take(np.flatnonzero(want == width)).to_pylist():
                a["v"], a["angles"] = np.array(a["v"], dtype=np.int64), np.array(a["angles"], dtype=np.float64)
                out += work(b, a)
        cols = zip(*out, strict=True) if out else [[] for _ in names]
        return pa.table([pa.array([int(x) for x in c], pa.int64()) for c in cols], names=names)

    T.bounded_batches(spark)
    return left.groupBy("b", "c").cogroup(right.groupBy("b", "c")).applyInArrow(run, ", ".join(f"{n} bigint" for n in names))


def _first(df: DataFrame, by: list[str], score: str, other: str, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc(score), other)
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor: Column, k: int = PARTNERS, lowest_percent: int = LOWEST_PERCENT) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    ``rows`` as from ``prepared``; ``is_anchor`` is a condition on them.  An anchor's
    positives are the ``k`` best other rows of its label; for each, the ``k`` best rows of
    another label whose score is at most the positive's and at least ``lowest_percent``
    of it."""
    rows = T.kept(rows, "vectors")
    rows = with_angles(rows, directions(rows))
    anchors = T.kept(rows.where(is_anchor), "anchors")
    found = _in_blocks(rows, anchors, lambda b, a: [(a["row"], a["id"], i, s) for s, i in b.positives(a, k)],
                       ["anchor", "anchor_id", "positive_id", "positive_score"])
    positives = T.kept(_first(found, ["anchor"], "positive_score", "positive_id", k).withColumnRenamed("rank", "nth"), "positives")
    scores = positives.groupBy(F.col("anchor").alias("row")).agg(F.array_sort(F.collect_set("positive_score")).alias("tops"))

    def between(b: Block, a: dict) -> list[tuple]:
        asked = {p: -(-lowest_percent * p // 100) for p in a["tops"] if p >= 0}
        found = b.negatives(a, asked, k) if asked else {}
        return [(a["row"], top, i, s) for top, f in found.items() for s, i in f]

    near = _in_blocks(rows, anchors.join(scores, "row"), between, ["anchor", "positive_score", "negative_id", "negative_score"])
    near = _first(near, ["anchor", "positive_score"], "negative_score", "negative_id", k)
    return positives.join(near, ["anchor", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
