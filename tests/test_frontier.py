"""Commit frontier: tracker cases, random completion orders vs a step model."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import frontier as fr
from tracker_model import run as step_run

# case id -> (start_committed, fetched offsets, [(time, offset)] completions)
CASES = {
    0: (100, [101, 102, 103], [(1, 101), (2, 102), (3, 103)]),          # sequential
    1: (200, [201, 202, 203], [(1, 202), (2, 203)]),                    # out of order
    2: (300, [301, 302, 303, 304], [(1, 302), (2, 303), (3, 304), (4, 301)]),  # late unlock
    3: (400, [401, 402, 403], [(1, 401), (2, 403)]),                    # pending
    4: (100, [101], [(1, 101), (2, 101)]),                              # done again after commit
    5: (100, [], [(1, 101)]),                                           # done, never in flight
    6: (100, [101, 102], [(1, 102), (2, 102)]),                         # double done above frontier
}


def _frames(spark, cases):
    rec, base, comp = [], [], []
    for p, (start, fetched, done) in cases.items():
        base.append((p, start))
        rec += [(p, o) for o in fetched]
        comp += [(p, o, t) for t, o in done]
    records = spark.createDataFrame(rec or [(0, 0)], "partition int, offset bigint")
    if not rec:
        records = records.limit(0)
    base_df = spark.createDataFrame(base, "partition int, base bigint")
    comps = spark.createDataFrame(comp, "partition int, offset bigint, done_ms bigint")
    first = comps.groupBy("partition", "offset").agg(F.min("done_ms").alias("done_ms"))
    outcomes = records.join(first, ["partition", "offset"], "left")
    return records, base_df, comps, outcomes


def _expected(cases):
    out = {}
    for p, (start, fetched, done) in cases.items():
        adv, classes, t = step_run(start, fetched, done)
        out[p] = (adv, classes, t)
    return out


@pytest.mark.parametrize("bucket", [2, 4096])
def test_tracker_cases(spark, bucket):
    records, base, comps, outcomes = _frames(spark, CASES)
    exp = _expected(CASES)
    snap = {r.partition: r.last_committed for r in fr.frontier_snapshot(outcomes, base).collect()}
    tl = fr.frontier_timeline(outcomes, base, bucket).collect()
    for p, (adv, classes, t) in exp.items():
        assert snap[p] == t.last, p
        got = sorted((r.commit_ms, r.committed_through) for r in tl if r.partition == p)
        assert got == sorted(adv), p
    assert snap[0] == 103 and snap[1] == 200 and snap[2] == 304 and snap[3] == 401
    late = [r for r in tl if r.partition == 2]
    assert len(late) == 1 and late[0].released == 4


def test_tracker_snapshot_lists(spark):
    records, base, comps, outcomes = _frames(spark, CASES)
    snap = fr.frontier_snapshot(outcomes, base)
    rows = [tuple(r) for r in fr.tracker_snapshot(outcomes, snap, 2).collect()]
    listed = {p: sorted((s, k, o) for q, _, _, _, _, s, k, o in rows if q == p and s) for p in (0, 1, 3)}
    assert listed == {0: [], 1: [("completed", 1, 202), ("completed", 2, 203), ("in_flight", 1, 201)],
                      3: [("completed", 1, 403), ("in_flight", 1, 402)]}
    assert [r[2:] for r in rows if r[0] == 0] == [(0, 0, 0, None, None, None)]


def test_a_hole_is_the_blocker(spark):
    out = spark.createDataFrame([(0, 0, 10), (0, 1, 11), (0, 3, 12), (0, 4, 13)], "partition int, offset bigint, done_ms bigint")
    got = [tuple(r)[:4] for r in fr.blocked_by_gap(out, None, 2).collect()]
    assert got == [(0, 2, None, 2)]


def test_same_ms_double_unseen_partition_and_repeated_commits(spark):
    rec = spark.createDataFrame([(0, 0), (0, 1)], "partition int, offset bigint")
    base = spark.createDataFrame([(0, -1)], "partition int, base bigint")
    comps = spark.createDataFrame([(0, 1, 5), (0, 1, 5), (9, 3, 5)], "partition int, offset bigint, done_ms bigint")
    got = sorted(r["class"] for r in fr.completion_classes(comps, rec, base, 2).collect())
    assert got == ["error_double", "error_not_in_flight", "ok"]
    assert [(r.partition, r.offset) for r in fr.untracked_completions(comps, rec, base).collect()] == [(9, 3)]
    twice = spark.createDataFrame([(0, 0), (0, -1)], "partition int, committed_through bigint")
    assert [(r.partition, r.offset) for r in fr.above_committed(rec, twice).collect()] == [(0, 1)]


def test_a_completion_before_its_fetch_is_not_in_flight(spark):
    """Fetches, completions and commits in one time order; the offset can still be completed later."""
    rec = spark.createDataFrame([(0, 0, 10), (0, 1, 20), (0, 2, 30)], "partition int, offset bigint, fetched_ms bigint")
    comps = spark.createDataFrame([(0, 0, 10), (0, 1, 19), (0, 1, 25), (0, 1, 26), (0, 2, 5), (0, 2, 6)],
                                  "partition int, offset bigint, done_ms bigint")
    got = sorted((r.offset, r.done_ms, r["class"]) for r in fr.completion_classes(comps, rec, None, 2).collect())
    assert got == [(0, 10, "ok"), (1, 19, "error_not_in_flight"), (1, 25, "ok"), (1, 26, "noop_committed"),
                   (2, 5, "error_not_in_flight"), (2, 6, "error_not_in_flight")]


@pytest.mark.parametrize("bucket", [2, 4096])
def test_dense_contiguity(spark, bucket):
    """Offsets 1, 4 and 5 do not exist; 8 is not done."""
    rows = [(0, 0, 10), (0, 2, 9), (0, 3, 15), (0, 6, 12), (0, 7, 20), (0, 8, None), (0, 9, 1), (1, 5, None), (2, 3, 4), (2, 9, 3)]
    out = spark.createDataFrame(rows, "partition int, offset bigint, done_ms bigint")
    tl = sorted((r.partition, r.commit_ms, r.committed_through, r.released) for r in fr.frontier_timeline(out, None, bucket, dense=True).collect())
    assert tl == [(0, 10, 2, 2), (0, 15, 6, 2), (0, 20, 7, 1), (2, 4, 9, 2)]
    snap = {r.partition: (r.base, r.last_committed) for r in fr.frontier_snapshot(out, dense=True).collect()}
    assert snap == {0: (-1, 7), 1: (4, 4), 2: (2, 9)}
    assert {r.partition: r.last_committed for r in fr.frontier_snapshot(out).collect()} == {0: 0, 1: 4, 2: 3}


def test_completion_classes_cases(spark):
    records, base, comps, outcomes = _frames(spark, CASES)
    got = sorted((r.partition, r.offset, r.done_ms, r["class"])
                 for r in fr.completion_classes(comps, records, base, 2).collect())
    exp = sorted((p, o, t, c) for p, (_, cl, _) in _expected(CASES).items() for (o, t, c) in cl)
    assert got == exp
    classes = {(p, t): c for p, _, t, c in got}
    assert classes[(4, 2)] == "noop_committed"
    assert classes[(5, 1)] == "error_not_in_flight"
    assert classes[(6, 2)] == "error_double"


def _random_cases(seed, n_parts=24):
    rnd = random.Random(seed)
    cases = {}
    for p in range(n_parts):
        start = rnd.choice([-1, 0, 7, 100])
        n = rnd.randint(0, 40)
        offs = list(range(start + 1, start + 1 + n))
        fetched = [o for o in offs if rnd.random() > 0.04]          # holes
        fetched += [start, start - 1] if rnd.random() < 0.3 else []  # at/below the frontier
        done = [o for o in fetched if rnd.random() > 0.08]           # some never finish
        done += [start + n + 3] if rnd.random() < 0.2 else []        # untracked
        done += rnd.sample(done, k=min(len(done), rnd.randint(0, 3)))  # duplicates
        times = rnd.sample(range(1, 10_000), len(done))               # unique times
        cases[p] = (start, fetched, list(zip(times, done)))
    return cases


@pytest.mark.parametrize("seed,bucket", [(1, 3), (2, 5), (3, 8), (4, 64)])
def test_random_orders_match_step_model(spark, seed, bucket):
    cases = _random_cases(seed)
    records, base, comps, outcomes = _frames(spark, cases)
    exp = _expected(cases)
    snap = {r.partition: r.last_committed for r in fr.frontier_snapshot(outcomes, base).collect()}
    tl = fr.frontier_timeline(outcomes, base, bucket).collect()
    cls = fr.completion_classes(comps, records, base, bucket).collect()
    for p, (adv, classes, t) in exp.items():
        assert snap[p] == t.last, (seed, p)
        assert sorted((r.commit_ms, r.committed_through) for r in tl if r.partition == p) == sorted(adv), (seed, p)
        got = sorted((r.offset, r.done_ms, r["class"]) for r in cls if r.partition == p)
        assert got == sorted(classes), (seed, p)


def test_pending_and_blocked(spark):
    records, base, comps, outcomes = _frames(spark, CASES)
    snap = fr.frontier_snapshot(outcomes, base)
    pend = {r.partition: (r.in_flight, r.completed) for r in fr.pending_count(outcomes, snap).collect()}
    assert pend[1] == (1, 2) and pend[3] == (1, 1) and pend[0] == (0, 0)
    blocked = {(r.partition, r.blocker_offset): r for r in fr.blocked_by_gap(outcomes, base, 2).collect()}
    # late unlock: 302..304 waited for 301, which finished at t=4
    b = blocked[(2, 301)]
    assert (b.blocked, b.commit_ms, b.max_blocked_ms, b.total_blocked_ms) == (3, 4, 3, 3 + 2 + 1)
    # out of order: 202, 203 wait for 201, never committed
    assert blocked[(1, 201)].blocked == 2 and blocked[(1, 201)].commit_ms is None


def test_commit_lookups(spark):
    records = spark.createDataFrame([(0, 0, "key-0", "v0"), (0, 1, "key-1", "v1"), (0, 2, "key-2", "v2")],
                                    "partition int, offset bigint, key string, value string")
    commits = spark.createDataFrame([(0, 2, 5, True), (0, 99, 6, True)],
                                    "partition int, committed_through bigint, commit_ms bigint, ok boolean")
    hit = fr.commit_record_lookup(commits, records).collect()
    assert [(r.committed_through, r.key) for r in hit] == [(2, "key-2")]
    unknown = fr.unknown_commits(commits, records).collect()
    assert [r.committed_through for r in unknown] == [99]
    cache = fr.commit_cache(records.withColumn("fetched_ms", F.lit(1)),
                            fr.final_commit(commits.where("committed_through = 2"))).collect()
    assert cache == []
    cache = fr.commit_cache(records.withColumn("fetched_ms", F.lit(1)),
                            fr.final_commit(commits.where("committed_through = 99").limit(0))).collect()
    assert cache[0].cached == 3 and cache[0].lowest_cached == 0


@pytest.mark.parametrize("seed", [11, 12])
def test_three_level_carry_matches_step_model(spark, seed):
    from tidemark.operators import prefix

    cases = _random_cases(seed)
    records, base, comps, outcomes = _frames(spark, cases)
    exp = _expected(cases)
    prefix.CARRY_BUCKET_SIZE = 2
    try:
        tl = fr.frontier_timeline(outcomes, base, 2).collect()
    finally:
        prefix.CARRY_BUCKET_SIZE = None
    for p, (adv, _, _) in exp.items():
        assert sorted((r.commit_ms, r.committed_through) for r in tl if r.partition == p) == sorted(adv), (seed, p)


@pytest.mark.parametrize("seed,bits", [(21, 8), (22, 32), (23, 32768)])
def test_contiguous_frontier_with_duplicates(spark, monkeypatch, seed, bits):
    monkeypatch.setattr(fr, "BITMAP_BITS", bits)
    rnd = random.Random(seed)
    good, bases, exp = [], [], {}
    for p in range(12):
        base = rnd.choice([-1, 4, 50])
        offs = sorted({o for o in range(base - 3, base + 60) if rnd.random() > 0.06})
        rows = offs + rnd.sample(offs, k=min(len(offs), 10))  # duplicates
        good += [(p, o) for o in rows]
        bases.append((p, base))
        f = base
        while f + 1 in set(offs):
            f += 1
        exp[p] = f
    g = spark.createDataFrame(good, "partition int, offset bigint")
    b = spark.createDataFrame(bases, "partition int, base bigint")
    got = {r.partition: r.frontier for r in fr.contiguous_frontier(g, b).collect()}
    assert got == exp


@pytest.mark.parametrize("bits", [8, 16, 32768])
def test_contiguous_frontier_with_its_own_base(spark, monkeypatch, bits):
    """The base is the lowest offset less one, also of rows that are not done; whole
    buckets, a missing bucket, a hole, nothing done at all."""
    monkeypatch.setattr(fr, "BITMAP_BITS", bits)
    rows = [(0, o, True) for o in range(5, 64)] + [(1, o, True) for o in range(32)] + [(1, o, True) for o in range(48, 60)]
    rows += [(2, 9, False), (2, 10, True)] + [(3, o, o != 21) for o in range(16, 40)] + [(4, o, o != 17) for o in range(3, 30) if o != 12]
    rows += [(5, 31, True), (6, 40, False)]
    df = spark.createDataFrame(rows, "partition int, offset bigint, ok boolean")
    got = {r.partition: (r.base, r.frontier) for r in fr.contiguous_frontier(df, done=F.col("ok")).collect()}
    assert got == {0: (4, 63), 1: (-1, 31), 2: (8, 8), 3: (15, 20), 4: (2, 11), 5: (30, 31), 6: (39, 39)}


def test_first_k_random(spark):
    from tidemark.operators.prefix import first_k

    rnd = random.Random(5)
    rows = [(p, o) for p in range(6) for o in rnd.sample(range(500), rnd.randint(0, 60))]
    df = spark.createDataFrame(rows, "p int, o bigint")
    for k in (1, 7, 100):
        got = sorted((r.p, r.o) for r in first_k(df, ["p"], "o", F.floor(F.col("o") / 8), k).collect())
        exp = sorted((p, o) for p in range(6) for o in sorted(o for q, o in rows if q == p)[:k])
        assert got == exp, k
