"""Hard negatives and approximate neighbours against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tidemark.llm import hard_negatives, nn_graph

SCHEMA = "vec_id bigint, embedding array<double>, label int, row string, shard int, v int"
NAN, INF = float("nan"), float("inf")


def _table(spark, rows):
    return spark.createDataFrame([(i, v, lab, "x", 1, 2) for i, v, lab in rows], SCHEMA)


def _ints(v):
    return [int(np.floor(256 * x)) for x in v]


def _taken(rows):
    return [(i, _ints(v), lab) for i, v, lab in rows
            if i is not None and v is not None and lab is not None and all(x is not None and np.isfinite(x) for x in v)]


def _plain_mine(rows, anchor, k=5):
    rows, out = _taken(rows), []
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    for n, (i, v, lab) in enumerate(rows):
        if not anchor(i):
            continue
        scored = sorted(((-dot(v, w), j, lab == other) for m, (j, w, other) in enumerate(rows) if m != n and len(w) == len(v)))
        for s, j, _ in [t for t in scored if t[2]][:k]:
            fits = [t for t in scored if not t[2] and -80 * s <= -100 * t[0] <= -100 * s]
            out += [(i, j, r, m, -s, -u) for r, (u, m, _) in enumerate(fits[:k], 1)]
    return sorted(out)


def _mined(rows, **kw):
    out = hard_negatives.mine(hard_negatives.prepared(rows), F.col("id") % 10 == 0, **kw)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in out.collect())


def _clustered(n, width, seed, centres=6):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, width))
    return [(i, (c[i % centres] + rng.normal(size=width) * 0.7 * (1 + i % 3)).tolist(), int(rng.integers(3))) for i in range(n)]


@pytest.mark.parametrize("blocks", [(1 << 15, 1 << 12), (40, 7)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", blocks[0])
    monkeypatch.setattr(hard_negatives, "ANCHOR_ROWS", blocks[1])
    rows = _clustered(300, 7, 3) + [(1000 + i, [1.0] * 7, i % 2) for i in range(30)]  # a hot vector: ties
    got = _mined(_table(spark, rows))
    assert got and got == _plain_mine(rows, lambda i: i % 10 == 0)


def test_hard_negatives_odd_rows(spark):
    rows = _clustered(60, 3, 5) + [
        (60, [0.0] * 3, 1), (70, None, 1), (71, [NAN, 0.0, 1.0], 1), (72, [INF, 0.0, 1.0], 1), (73, [None, 1.0, 1.0], 1), (80, [1.0] * 3, None),
        (None, [1.0] * 3, 1), (90, [1.0, 2.0], 1), (91, [1.0, 2.0], 1), (92, [1.0, 1.9], 2), (100, [], 1), (101, [], 2), (102, [], 1),
        (0, [0.5] * 3, 2), (0, [0.5] * 3, 2), (10, [-1.0, 0.0, 0.0], 0)]
    got = _mined(_table(spark, rows))
    assert got == _plain_mine(rows, lambda i: i % 10 == 0)
    assert {(90, 91, 1, 92)} <= {g[:4] for g in got} and any(g[0] == 100 for g in got)
    assert _mined(_table(spark, rows).limit(0)) == []


def test_score_windows_hold_the_scores():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.integers(-3000, 3000, (200, 9)), rng.integers(-2, 3, (50, 9)), np.zeros((1, 9)), np.full((3, 9), 2**20)]).astype(np.int64)
    d = hard_negatives.unit_directions(9, {})
    norm = np.sqrt((x.astype(float) ** 2).sum(axis=1))
    angles = np.arccos(np.clip((x @ d.T) / np.maximum(norm, 1e-300)[:, None], -1, 1)).astype(np.float32).astype(float)
    s = x @ x.T
    for i in range(len(x)):
        low, high = hard_negatives.score_windows(norm[i], angles[i], norm, angles)
        assert (low <= s[i]).all() and (s[i] <= high).all()


def test_products_beyond_floating_point(spark):
    big = 1e9
    rows = [(0, [big, 1.0], 1), (1, [big, 1.5], 1), (2, [big, 1.25], 2), (3, [big * 0.9, 0.5], 2), (4, [big, 0.5], 1)]
    rows = [(i, [x / 256 for x in v], lab) for i, v, lab in rows]
    assert _mined(_table(spark, rows)) == _plain_mine(rows, lambda i: i % 10 == 0)


# -- neighbour graph ---------------------------------------------------------------------

def _plain_nearest(rows, k):
    ok = [(i, v) for i, v, _ in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for i, v in ok:
        if i % 20 == 0:
            s = sorted((-float(np.dot(v, w)), j) for j, w in ok if j != i and len(w) == len(v))
            out.append((i, s[:k]))
    return out


def _recall(rows, found, k):
    by, hit, total = {}, 0, 0
    for r in found:
        by.setdefault(r.query_id, []).append(r)
    for i, best in _plain_nearest(rows, k):
        got = sorted(by.get(i, []), key=lambda r: r["rank"])
        assert [r["rank"] for r in got] == list(range(1, len(got) + 1))
        assert [(-r.score, r.vec_id) for r in got] == sorted((-r.score, r.vec_id) for r in got)
        assert all(r.vec_id != i for r in got) and len(got) == len(best)
        hit += sum(any(r.vec_id == j for r in got) for _, j in best)
        total += len(best)
    return hit / max(1, total)


def test_neighbours_recall(spark, monkeypatch):
    monkeypatch.setattr(nn_graph, "SHARD_ROWS", 1000)
    monkeypatch.setattr(nn_graph, "QUERY_ROWS", 30)
    rows = _clustered(2000, 24, 9, centres=40)
    found = nn_graph.neighbours(nn_graph.vectors(_table(spark, rows)), F.col("id") % 20 == 0).collect()
    assert _recall(rows, found, 20) >= 0.95
    vec = {i: np.array(v) for i, v, _ in rows}
    assert all(abs(r.score - float(vec[r.query_id] @ vec[r.vec_id])) < 1e-9 for r in found)


def test_descent_improves_the_lists(spark):
    x = np.random.default_rng(2).normal(size=(1500, 32))
    points = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "node bigint, v array<double>")
    y = nn_graph.lifted(x)
    where, sims = {}, 0.0
    graph = nn_graph.build(points).collect()
    for r in graph:
        where.setdefault(r.shard, []).append(r.node)
    first, last = [], []
    for shard, members in where.items():
        members = np.array(sorted(members))
        s = y[members] @ y[members].T
        np.fill_diagonal(s, -np.inf)
        true = np.argsort(-s, axis=1)[:, :10]
        start = nn_graph.first_lists(x[members], nn_graph.DEGREE)[0]
        nbrs = {r.node: set(r.nbrs) for r in graph if r.shard == shard}
        for n, best in enumerate(true):
            first.append(len(set(best) & set(start[n])) / 10)
            last.append(len(set(members[best]) & nbrs[members[n]]) / 10)
    assert np.mean(last) > 0.9 and np.mean(last) > np.mean(first)


def test_copies_and_islands(spark, monkeypatch):
    """A vector that a third of the rows hold, and a tight group far from all others."""
    rng = random.Random(4)
    far = [50.0] + [0.0] * 7
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)], 0) for i in range(400)]
    rows += [(1000 + i, [1.0] * 8, 0) for i in range(300)]
    rows += [(2000 + i, [x + rng.gauss(0, 0.01) for x in far], 0) for i in range(60)]
    found = nn_graph.neighbours(nn_graph.vectors(_table(spark, rows)), F.col("id") % 20 == 0).collect()
    assert _recall(rows, found, 20) >= 0.95
    assert [r.vec_id for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == 1000] is not None


def test_neighbours_odd_rows(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [NAN, 0.0], 1), (2, [None, 1.0], 1), (3, None, 1), (4, [INF, 0.0], 1), (None, [1.0, 1.0], 1),
            (5, [1.0, 0.0], 1), (6, [1.0, 0.0], 1), (7, [1.0], 1), (20, [], 1), (40, [0.0, 0.0], 1), (60, [2.0], 1), (8, [-1.0, 0.5], 1), (8, [-1.0, 0.5], 1)]
    found = nn_graph.neighbours(nn_graph.vectors(_table(spark, rows)), F.col("id") % 20 == 0, 4).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found) == [
        (0, 1, 5, 1.0), (0, 2, 6, 1.0), (0, 3, 8, -1.0), (0, 4, 8, -1.0), (60, 1, 7, 2.0)]
    again = nn_graph.neighbours(nn_graph.vectors(_table(spark, [(0, [1.0], 1), (0, [1.0], 1), (1, [2.0], 1)])), F.col("id") == 0, 4).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in again] == [(0, 1, 1), (0, 1, 1)]
    assert nn_graph.neighbours(nn_graph.vectors(_table(spark, rows).limit(0)), F.col("id") % 20 == 0).count() == 0
