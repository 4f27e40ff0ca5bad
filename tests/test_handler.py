"""User handlers in tasks, and the per-key failure budget."""

import os
import tempfile
from threading import Event

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators import attempts as att
from tidemark.operators.handler import ATTEMPT_SCHEMA, Tries, handle_records, handler_outcomes, one_try
from tidemark.params import RetryPolicy
from tidemark.streaming import pipeline as sp
from tidemark.streaming.handler import RetryProcessor, streaming_attempts


def _records(spark, n=12):
    return spark.createDataFrame([(0, i, f"key-{i % 3}", f"message-{i}: x", i) for i in range(n)],
                                 "partition int, offset bigint, key string, value string, fetched_ms bigint")


def test_handler_retries_failed_rows_only(spark):
    def handler(pdf):
        # offsets divisible by 4 fail twice, offset 5 always fails
        return ~(((pdf["offset"] % 4 == 0) & (pdf["attempt"] <= 2)) | (pdf["offset"] == 5))

    rows = handle_records(_records(spark), handler, RetryPolicy(3, 100, 1000)).collect()
    by = {}
    for r in rows:
        by.setdefault(r.offset, []).append((r.attempt, r.ok, r.retry, r.delay_ms))
    assert sorted(by[0]) == [(1, False, True, 100), (2, False, True, 200), (3, True, False, 0)]
    assert sorted(by[1]) == [(1, True, False, 0)]
    assert [a for a, *_ in sorted(by[5])] == [1, 2, 3, 4] and sorted(by[5])[-1][2] is False
    outs = {r.offset: r.status for r in handler_outcomes(handle_records(
        _records(spark), handler, RetryPolicy(3, 100, 1000))).collect()}
    assert outs[5] == "exhausted" and outs[0] == "done"


def test_a_raising_handler_fails_the_try_and_not_the_job(spark):
    """Errors, starts and ends of every try; rows beside a raising one are processed."""
    class Broken(Exception):
        took_ms = 7

    def handler(pdf):
        if (pdf["offset"] == 5).any():
            raise Broken("no such tea")
        ok = ~((pdf["offset"] == 2) & (pdf["attempt"] == 1))
        return pd.DataFrame({"ok": ok, "error": np.where(ok, None, "busy"), "took_ms": 3})

    rows = handle_records(_records(spark), handler, RetryPolicy(2, 100, 1000))
    got = {}
    for r in rows.orderBy("offset", "attempt").collect():
        got.setdefault(r.offset, []).append((r.attempt, r.start_ms, r.end_ms, r.ok, r.error, r.retry, r.delay_ms))
    assert got[5] == [(1, 5, 12, False, "Broken: no such tea", True, 100), (2, 112, 119, False, "Broken: no such tea", True, 200),
                      (3, 319, 326, False, "Broken: no such tea", False, 0)]
    assert got[2] == [(1, 2, 5, False, "busy", True, 100), (2, 105, 108, True, None, False, 0)]
    assert all(got[o] == [(1, o, o + 3, True, None, False, 0)] for o in range(12) if o not in (2, 5))
    out = {r.offset: (r.attempts, r.status, r.done_ms, r.end_ms, r.error) for r in handler_outcomes(rows).collect()}
    assert out[5] == (3, "exhausted", None, 326, "Broken: no such tea") and out[2] == (2, "done", 108, 108, None)


def test_an_answer_of_another_length_is_an_error():
    with pytest.raises(ValueError, match="1 of 2 rows"):
        one_try(lambda pdf: pd.Series([True]), pd.DataFrame({"a": [1, 2]}))


def _streamed(spark, handler, records, policy, run):
    """Attempts of a streamed run over three files; ``run`` gets the query."""
    d = tempfile.mkdtemp(prefix="tidemark-handler-", dir="/tmp")
    records.repartition(3).write.parquet(f"{d}/log")
    stream = sp.read_log_stream(spark, f"{d}/log", max_files_per_trigger=1)
    tries = sp.finished(streaming_attempts(stream, handler, policy, key_buckets=2))
    return run(sp.file_sink(tries, f"{d}/attempts", f"{d}/ckpt")), f"{d}/attempts"


def _flaky():
    def handler(pdf):  # goes to the workers by value: they do not see this module
        if (pdf["offset"] == 5).any():
            raise RuntimeError("never")
        return ~((pdf["offset"] % 4 == 0) & (pdf["attempt"] <= 2))

    return handler


def test_streamed_retries_equal_batch_retries(spark):
    """Retries wait on timers; a record that always fails has all its tries and no more."""
    policy = RetryPolicy(3, 100, 1000)
    status, path = _streamed(spark, _flaky(), _records(spark), policy, lambda q: sp.run_until(q, 12, timeout_s=300))
    assert status == "caught_up"
    cols = ["partition", "offset", "key", "attempt", "start_ms", "end_ms", "ok", "error", "retry", "delay_ms"]
    streamed = sorted(map(str, spark.read.schema(ATTEMPT_SCHEMA).parquet(path).select(cols).collect()))
    assert streamed == sorted(map(str, handle_records(_records(spark), _flaky(), policy).select(cols).collect()))
    assert len([f for f in os.listdir(f"{path}/_spark_metadata") if f.isdigit()]) > 1  # batches


def test_a_live_query_stops_on_a_signal_or_at_the_deadline(spark):
    """One record waits for a minute: the rest is finished, the run is cut off."""
    policy = RetryPolicy(1, 60_000, 60_000)
    stop = Event()
    stop.set()
    status, _ = _streamed(spark, _flaky(), _records(spark, 6), policy, lambda q: sp.run_until(q, 6, interrupt=stop))
    assert status == "interrupted"
    status, path = _streamed(spark, _flaky(), _records(spark, 6), policy, lambda q: sp.run_until(q, 6, timeout_s=45))
    assert status == "timeout"
    waiting = {r.offset for r in spark.read.schema(ATTEMPT_SCHEMA).parquet(path).where("retry").collect()}
    assert waiting == {0, 4, 5}


def _step_budget(keys, budget, n):
    """Per-key shared failure counter, records handled in offset order."""
    used, out = {}, []
    for k in keys:
        fails = 0
        for _ in range(n + 1):
            if used.get(k, 0) < budget.get(k, 0):
                used[k] = used.get(k, 0) + 1
                fails += 1
            else:
                break
        out.append(fails)
    return out


def test_key_budget_matches_step_model(spark):
    keys = [f"k{i % 4}" for i in range(40)]
    budget = {"k0": 5, "k1": 13, "k2": 1}
    for n in (0, 2, 3):
        exp = _step_budget(keys, budget, n)
        df = spark.createDataFrame([(0, i, k) for i, k in enumerate(keys)], "partition int, offset bigint, key string")
        bt = spark.createDataFrame(list(budget.items()), "key string, budget int")
        rows = att.key_budget_failures(df.join(F.broadcast(bt), "key", "left"), "budget",
                                       RetryPolicy(n, 100, 1000), 3).collect()
        got = [r.failures for r in sorted(rows, key=lambda r: r.offset)]
        assert got == exp, n


def test_raising_rows_are_not_searched_for_again():
    """Handler calls: no call for a second half that must raise, retries know who raised."""
    calls = []

    def handler(pdf):
        calls.append(len(pdf))
        if (pdf["offset"] % 8 == 7).any():
            raise RuntimeError("no")
        return pd.Series(pdf["offset"] % 8 != 3)

    rows = pd.DataFrame({"partition": 0, "offset": range(64), "key": "k", "attempt": np.int32(1), "clock_ms": 0})
    tries, seen, pending = Tries(handler, RetryPolicy(2, 100, 1000)), [], rows
    while len(pending):
        tried, again = tries.run(pending)
        seen.append(list(zip(tried["offset"], tried["ok"], tried["error"], strict=True)))
        pending = again.drop(columns="wait_ms")
    bad = [(o, False, "RuntimeError: no") for o in range(7, 64, 8)]
    assert sorted(x for x in seen[0] if x[2] == "RuntimeError: no") == bad and len(seen[0]) == 64
    for later in seen[1:]:
        assert sorted(later) == sorted(bad + [(o, False, "failed") for o in range(3, 64, 8)])
    assert len(seen) == 3 and len(calls) <= 15 + 8 * 4 + 2 * (2 + 8)  # 8 of the halves to halve, then 2 + 8 calls a try


def test_rows_that_raised_are_retried_together():
    """A fault of the whole batch that has passed costs one call, not one a row."""
    calls = []

    def handler(pdf):
        calls.append(len(pdf))
        if (pdf["attempt"] == 1).any():
            raise RuntimeError("down")
        return np.ones(len(pdf), dtype=bool)

    rows = pd.DataFrame({"partition": 0, "offset": range(32), "key": "k", "attempt": np.int32(1), "clock_ms": 0})
    tries = Tries(handler, RetryPolicy(2, 100, 1000))
    _, again = tries.run(rows)
    calls.clear()
    tried, again = tries.run(again.drop(columns="wait_ms"))
    assert calls == [32] and tried["ok"].all() and list(tried["offset"]) == list(range(32)) and not len(again)


def test_waiting_records_go_to_the_state_in_blocks(spark):
    """Calls to the state follow the blocks, not the records; what is read back has its types."""
    class Store(dict):
        calls = 0

        def iterator(self):
            return iter(list(self.items()))

        def updateValue(self, k, v):
            Store.calls += 1
            self[k] = v

        def removeKey(self, k):
            Store.calls += 1
            del self[k]

        def containsKey(self, k):
            Store.calls += 1
            return k in self

    class Handle:
        timers = []

        def getMapState(self, *a):
            return Store()

        def registerTimer(self, at):
            Handle.timers.append(at)

    class Now:
        def __init__(self, at):
            self.at = at

        getCurrentProcessingTimeInMs = getExpiryTimeInMs = lambda self: self.at

    seen = []

    def handler(pdf):
        seen.append((len(pdf), dict(pdf.dtypes)))
        return pdf["attempt"] > 1 + pdf["offset"] % 2

    n = 10_000
    record = StructType.fromDDL("partition int, offset bigint, key string, fetched_ms bigint")
    rows = pd.DataFrame({"partition": np.int32(0), "offset": np.arange(n), "key": [None if i % 3 else "k" for i in range(n)], "fetched_ms": np.arange(n)})
    p = RetryProcessor(Tries(handler, RetryPolicy(2, 100, 1000)), record)
    p.init(Handle())
    out = [*p.handleInputRows((0, 0), iter([rows, rows.head(5)]), Now(0))]  # the second are redeliveries of waiting ones
    assert [len(x) for x in out] == [n] and Store.calls == 3
    assert [*p.handleExpiredTimer((0, 0), Now(99), Now(99))] == []
    second = [*p.handleExpiredTimer((0, 0), Now(100), Now(100))]
    assert second[0]["ok"].sum() == n // 2 and second[0]["key"].isna().sum() == rows["key"].isna().sum()
    third = [*p.handleExpiredTimer((0, 0), Now(300), Now(300))]
    assert sorted(third[0]["offset"]) == list(range(1, n, 2)) and third[0]["ok"].all() and not p.waiting
    assert Store.calls <= 20 and len(seen) == 3 and all(t == seen[0][1] for _, t in seen) and set(Handle.timers) == {100, 300}
