"""Scalar functions: key hash, retry decision, backoff, attempt expansion."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions.keys import fnv1a32, key_partition
from tidemark.functions.retry import backoff_delay, retry_decision, total_wait
from tidemark.operators import attempts as att
from tidemark.params import DeliveryParams, RetryPolicy


def _py_fnv(b: bytes) -> int:
    h = 2166136261
    for x in b:
        h = ((h ^ x) * 16777619) & 0xFFFFFFFF
    return h


def test_key_partition_matches_logged_pairs(spark):
    df = spark.createDataFrame([(f"key-{i}",) for i in range(10)], "key string")
    rows = df.select("key", fnv1a32("key").alias("h"), key_partition("key", 3).alias("p")).collect()
    got = {r.key: r.p for r in rows}
    assert [got[f"key-{i}"] for i in range(10)] == [0, 1, 2, 0, 2, 0, 1, 2, 1, 2]
    assert {r.key: r.h for r in rows}["key-0"] == 1491088857


def test_fnv_utf8_and_edge_keys(spark):
    keys = ["", "a", "ключ-7", "clé", "x" * 50, "日本"]
    df = spark.createDataFrame([(k,) for k in keys] + [(None,)], "key string")
    got = {r.key: r.h for r in df.select("key", fnv1a32("key").alias("h")).collect()}
    for k in keys:
        assert got[k] == _py_fnv(k.encode()), k
    assert got[None] is None


# (max_retries, base, max) -> {attempt: delay or None (no retry)}
RETRY_CASES = [
    ((0, 100, 1000), {0: None, 1: None, 2: None, 99: None}),
    ((3, 100, 1000), {0: None, 1: 100, 3: 400, 4: None}),
    ((4, 50, 1000), {1: 50, 2: 100, 3: 200, 4: 400}),
    ((5, 150, 500), {1: 150, 2: 300, 3: 500, 4: 500, 5: 500}),
    ((-5, -100, -1000), {1: None}),
    ((200, 100, 1000), {100: 1000, 200: 1000}),
]


@pytest.mark.parametrize("cfg,expected", RETRY_CASES)
def test_retry_schedule(spark, cfg, expected):
    pol = RetryPolicy(*cfg)
    for a, d in expected.items():
        assert pol.decide(a) == ((False, 0) if d is None else (True, d))
    df = spark.createDataFrame([(a,) for a in expected], "attempt int")
    rows = df.select("attempt", retry_decision("attempt", pol).alias("d")).collect()
    for r in rows:
        d = expected[r.attempt]
        assert (r.d.retry, r.d.delay_ms) == ((False, 0) if d is None else (True, d))


def test_normalisation_and_validation():
    assert RetryPolicy(-5, -100, -1000).normalised() == RetryPolicy(0, 0, 0)
    assert RetryPolicy(3, 500, 100).normalised().max_ms == 500
    with pytest.raises(ValueError):
        DeliveryParams(partitions=0)
    with pytest.raises(ValueError):
        DeliveryParams(retry=RetryPolicy(3, 500, 100))
    with pytest.raises(ValueError):
        DeliveryParams(drain_timeout_ms=-1)


def test_backoff_and_wait_columns(spark):
    pol = RetryPolicy(5, 150, 500)
    df = spark.createDataFrame([(a,) for a in range(0, 8)], "a int")
    rows = df.select("a", backoff_delay("a", pol).alias("d"), total_wait("a", pol).alias("w")).collect()
    d = {r.a: r.d for r in rows}
    w = {r.a: r.w for r in rows}
    assert [d[a] for a in range(1, 8)] == [150, 300, 500, 500, 500, 500, 500]
    assert d[0] == 0
    assert [w[m] for m in range(0, 6)] == [0, 150, 450, 950, 1450, 1950]


def test_attempt_expansion_outcomes(spark):
    pol = RetryPolicy(3, 100, 1000)
    recs = spark.createDataFrame(
        [(0, 0, "key-0", 1000, 10, 1), (0, 1, "key-1", 1000, 10, 99), (0, 2, "key-2", 1000, 0, 0)],
        "partition int, offset bigint, key string, fetched_ms bigint, latency_ms bigint, failures int")
    out = {r.offset: r for r in att.outcomes(recs, pol).collect()}
    # one failure, 3 retries: 2 tries, done after 2 x 10 ms work + 100 ms wait
    assert (out[0].attempts, out[0].status, out[0].done_ms) == (2, "done", 1000 + 20 + 100)
    # always failing, 3 retries: 4 tries, exhausted, never done
    assert (out[1].attempts, out[1].status, out[1].done_ms, out[1].end_ms) == (4, "exhausted", None,
                                                                             1000 + 40 + 700)
    rows = att.expand_attempts(recs, pol).where("offset = 1").orderBy("attempt").collect()
    assert [(r.start_ms, r.ok, r.retry, r.delay_ms) for r in rows] == [
        (1000, False, True, 100), (1110, False, True, 200), (1320, False, True, 400), (1730, False, False, 0)]
    # always failing with 2 retries: 3 tries
    o2 = att.outcomes(recs.where("offset = 1"), RetryPolicy(2, 100, 200)).collect()[0]
    assert (o2.attempts, o2.status) == (3, "exhausted")


def test_override_and_failure_counter(spark):
    recs = spark.createDataFrame([("key-0", 7), ("key-3", 7), ("key-9", 7)], "key string, k int")
    ov = att.key_overrides(spark, {"key-0": 900, "key-3": 50})
    got = {r.key: r.latency_ms for r in att.apply_override(recs, ov, "key", F.col("k") * 1000, "latency_ms").collect()}
    assert got == {"key-0": 900, "key-3": 50, "key-9": 7000}
    tries = spark.createDataFrame(
        [(0, 0, "a", 1, False), (0, 0, "a", 2, True), (0, 3, "a", 1, False), (0, 3, "a", 2, False),
         (0, 1, "b", 1, False), (0, 7, "a", 1, True)],
        "partition int, offset bigint, key string, attempt int, ok boolean")
    for bucket in (1, 2, 100):
        rows = att.failed_attempt_counter(tries, bucket).collect()
        got = {(r.key, r.offset, r.attempt): r.failures_so_far for r in rows}
        assert got == {("a", 0, 1): 1, ("a", 0, 2): 1, ("a", 3, 1): 2, ("a", 3, 2): 3, ("a", 7, 1): 3,
                       ("b", 1, 1): 1}
