"""The two-level (and three-level) running aggregate against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import prefix


def _python(rows, how, inclusive):
    out, state = {}, {}
    for g, o, v in sorted(rows):
        prev = state.get(g)
        if inclusive:
            cur = v if prev is None else (prev + v if how == "sum" else (max(prev, v) if how == "max" else min(prev, v)))
            out[(g, o)] = cur
            state[g] = cur
        else:
            out[(g, o)] = prev if prev is not None else (0 if how == "sum" else None)
            state[g] = v if prev is None else (prev + v if how == "sum" else (max(prev, v) if how == "max" else min(prev, v)))
    return out


@pytest.mark.parametrize("how", ["sum", "max", "min"])
@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("bucket,carry", [(3, None), (64, None), (2, 3)])
def test_running_aggs_random(spark, how, inclusive, bucket, carry):
    rnd = random.Random(hash((how, inclusive, bucket, carry)) % 1000)
    rows = [(g, o, rnd.randint(-50, 50)) for g in range(4) for o in rnd.sample(range(200), rnd.randint(1, 70))]
    df = spark.createDataFrame(rows, "g int, o bigint, v bigint")
    saved = prefix.CARRY_BUCKET_SIZE
    prefix.CARRY_BUCKET_SIZE = carry
    try:
        res = prefix.running_agg(df, ["g"], ["o"], F.floor(F.col("o") / bucket), "v", "r", how, inclusive).collect()
    finally:
        prefix.CARRY_BUCKET_SIZE = saved
    got = {(r.g, r.o): r.r for r in res}
    assert got == _python(rows, how, inclusive)


def test_kth_smallest_and_gauge_random(spark):
    from tidemark.operators import lifecycle as lc

    rnd = random.Random(3)
    vals = [rnd.randint(0, 10_000) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in vals], "t bigint")
    for k in (1, 17, 150, 300):
        assert lc.kth_smallest(df, "t", k, 97).collect()[0].value == sorted(vals)[k - 1]
    assert lc.kth_smallest(df, "t", 301, 97).count() == 0
    iv = [(s, s + rnd.randint(0, 300)) for s in (rnd.randint(0, 5000) for _ in range(80))]
    ivdf = spark.createDataFrame(iv, "s bigint, e bigint")
    delta = {}
    for s, e in iv:
        delta[s] = delta.get(s, 0) + 1
        delta[e] = delta.get(e, 0) - 1
    exp, run = [], 0
    for t in sorted(delta):
        run += delta[t]
        exp.append((t, delta[t], run))
    got = [(r.ts_ms, r.delta, r.active) for r in lc.active_jobs(ivdf, "s", "e", 250).orderBy("ts_ms").collect()]
    assert got == exp
