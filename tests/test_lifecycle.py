"""Shutdown drain, replay, no-loss, resume, commit failures, catch-up, gauge."""

from pyspark.sql import functions as F

from tidemark.operators import frontier as fr
from tidemark.operators import lifecycle as lc
from tidemark.operators.prefix import first_k


def _run(spark):
    # (offset, fetched, end, status); stop at 100, drain 50
    rows = [(0, 0, 40, "done"), (1, 10, 120, "done"), (2, 20, 90, "exhausted"), (3, 30, 200, "done"),
            (4, 100, 110, "done"), (5, 60, 70, "done")]
    recs = spark.createDataFrame([(0, o, f"key-{o}", "v", f) for o, f, _, _ in rows],
                                 "partition int, offset bigint, key string, value string, fetched_ms bigint")
    outs = spark.createDataFrame([(0, o, f"key-{o}", s, e if s == "done" else None, e) for o, _, e, s in rows],
                                 "partition int, offset bigint, key string, status string, done_ms bigint, end_ms bigint")
    return recs, outs


def test_drain_split_and_replay(spark):
    recs, outs = _run(spark)
    split = lc.drain_split(outs, recs, 100, 50)
    got = {r.offset: (r.split, r.final_status) for r in split.collect()}
    assert got == {0: ("finished", "done"), 1: ("drained", "done"), 2: ("finished", "exhausted"),
                   3: ("unfinished", "unfinished"), 4: ("not_dispatched", "not_dispatched"),
                   5: ("finished", "done")}
    snap = fr.frontier_snapshot(split, fr.baseline(recs))
    assert snap.collect()[0].last_committed == 1
    replay = {r.offset: r.reason for r in lc.replay_set(split, snap).collect()}
    assert replay == {2: "exhausted", 3: "unfinished", 4: "not_dispatched", 5: "blocked_done"}
    dup = lc.replay_duplicates(lc.replay_set(split, snap), split.where("final_status = 'done'"))
    assert [r.offset for r in dup.collect()] == [5]
    successes = lc.phase_union((1, split.where("final_status = 'done'").select("partition", "offset")),
                               (2, lc.replay_set(split, snap).select("partition", "offset")))
    hist = {r.successes: r.records for r in lc.success_histogram(recs, successes).collect()}
    assert hist == {1: 5, 2: 1}
    assert lc.lost_records(recs, successes).count() == 0
    resume = lc.resume_scan(recs, spark.createDataFrame([(0, 1)], "partition int, committed_through bigint"))
    r = resume.collect()[0]
    assert (r.start_offset, r.last_offset, r.to_read) == (2, 5, 4)


def test_commit_failures_and_processed(spark):
    tl = spark.createDataFrame([(0, 10, 0, 1), (0, 20, 2, 2), (1, 15, 0, 1), (1, 30, 4, 4)],
                               "partition int, commit_ms bigint, committed_through bigint, released bigint")
    commits = lc.commit_outcomes(tl, 1, 4)
    ok = {(r.partition, r.commit_ms): r.ok for r in commits.collect()}
    assert ok == {(0, 10): False, (0, 20): True, (1, 15): False, (1, 30): True}
    s = {r.partition: r for r in lc.commit_outcome_summary(commits).collect()}
    assert (s[0].durable_frontier, s[0].memory_frontier, s[0].failed_commits, s[0].first_failure_ms) == (2, 2, 1, 10)
    assert s[1].first_failure_ms == 10
    outs = spark.createDataFrame([(0, 0, 5), (0, 1, 6), (0, 2, None), (1, 0, 9)],
                                 "partition int, offset bigint, done_ms bigint")
    pc = {r.partition: (r.done, r.failed_commits, r.processed) for r in lc.processed_count(outs, commits).collect()}
    assert pc == {0: (2, 1, 1), 1: (1, 1, 0)}


def test_catch_up(spark):
    recs = spark.createDataFrame([(0, i, 100 + i) for i in range(5)], "partition int, offset bigint, fetched_ms bigint")
    outs = spark.createDataFrame([(0, i, 150 + 10 * i) for i in range(5)], "partition int, offset bigint, done_ms bigint")
    r = lc.catch_up(recs, outs, 100).collect()[0]
    assert (r.expected, r.producer_done_ms, r.processed_at_deadline, r.caught_up_ms, r.status) == \
        (5, 104, 5, 190, "caught_up")
    r = lc.catch_up(recs, outs, 50).collect()[0]
    assert (r.processed_at_deadline, r.caught_up_ms, r.status) == (1, None, "timeout")
    r = lc.catch_up(recs, outs, 50, expected=1, bucket_width=7).collect()[0]
    assert (r.caught_up_ms, r.status) == (150, "caught_up")
    assert lc.kth_smallest(outs, "done_ms", 4, 7).collect()[0].value == 180


def test_catch_up_interrupted_or_not_waited(spark):
    recs = spark.createDataFrame([(0, i, 100 + i) for i in range(5)], "partition int, offset bigint, fetched_ms bigint")
    outs = spark.createDataFrame([(0, i, 150 + 10 * i) for i in range(5)], "partition int, offset bigint, done_ms bigint")

    def got(*args, **kw):
        r = lc.catch_up(recs, outs, *args, **kw).collect()[0]
        return r.processed_at_deadline, r.caught_up_ms, r.status

    assert got(100, interrupt_ms=175) == (3, None, "interrupted")
    assert got(100, interrupt_ms=20) == (0, None, "interrupted")  # before the wait begins
    assert got(100, interrupt_ms=195) == (5, 190, "caught_up")
    assert got(20, interrupt_ms=1000) == (0, None, "timeout")
    assert got(100, expected=2, interrupt_ms=175) == (3, 160, "caught_up")
    assert got(0, expected=0)[2] == "not_waited"


def test_first_failed_commit_stops_intake(spark):
    recs, outs = _run(spark)
    outs = outs.join(recs.select("partition", "offset", "fetched_ms"), ["partition", "offset"])
    base = fr.baseline(recs)
    stop = lc.commit_failure_stop(lc.failing_from(fr.frontier_timeline(outs, base, 2), 50))
    split = lc.drain_split(outs, None, stop, 100)  # the commit of offset 1 at 120 fails
    got = {r.offset: r.final_status for r in split.collect()}
    assert got == {0: "done", 1: "done", 2: "exhausted", 3: "done", 4: "done", 5: "done"}
    split = lc.drain_split(outs, None, lc.commit_failure_stop(lc.failing_from(fr.frontier_timeline(outs, base, 2), 0)), 30)
    got = {r.offset: r.final_status for r in split.collect()}  # stops at 40
    assert got == {0: "done", 1: "unfinished", 2: "unfinished", 3: "unfinished", 4: "not_dispatched", 5: "not_dispatched"}
    commits = lc.failing_from(fr.frontier_timeline(split, base, 2), 0)
    assert [(r.durable_frontier, r.memory_frontier, r.first_failure_ms) for r in lc.commit_outcome_summary(commits).collect()] \
        == [(None, 0, 40)]
    never = lc.commit_failure_stop(lc.failing_from(fr.frontier_timeline(outs, base, 2), 10_000))
    assert {r.split for r in lc.drain_split(outs, None, never, 100).collect()} == {"finished"}


def test_active_jobs_gauge(spark):
    iv = spark.createDataFrame([(0, 10), (5, 15), (10, 20), (30, 31)], "s bigint, e bigint")
    for width in (3, 1000):
        got = [(r.ts_ms, r.active) for r in lc.active_jobs(iv, "s", "e", width).orderBy("ts_ms").collect()]
        assert got == [(0, 1), (5, 2), (10, 2), (15, 1), (20, 0), (30, 1), (31, 0)]


def test_first_k_bounded(spark):
    df = spark.createDataFrame([(p, o) for p in range(3) for o in range(50)], "p int, o bigint")
    got = first_k(df, ["p"], "o", F.floor(F.col("o") / 4), 6).collect()
    assert sorted((r.p, r.o) for r in got) == [(p, o) for p in range(3) for o in range(6)]


def test_error_kinds(spark):
    a = spark.createDataFrame([("simulated transient failure",), ("context canceled",), (None,),
                               ("context deadline exceeded",)], "error string")
    got = {r.error: (r.attempts, r.is_failure) for r in lc.error_kinds(a).collect()}
    assert got == {"simulated transient failure": (1, True), "context canceled": (1, False),
                   "context deadline exceeded": (1, True)}


def test_starting_offsets_json(spark):
    resume = spark.createDataFrame([(0, 3, 9, 7), (2, 0, 4, 5)],
                                   "partition int, start_offset bigint, last_offset bigint, to_read bigint")
    got = resume.agg(lc.starting_offsets_json(resume, "t").alias("j")).collect()[0].j
    import json
    assert json.loads(got) == {"t": {"0": 3, "2": 0}}
