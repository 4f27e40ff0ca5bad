"""Run lifecycle: shutdown drain, replay, no-loss, resume, commit failures,
catch-up and the active-job gauge.

A shutdown stops intake at ``stop_ms``; work already dispatched may finish
within ``drain_timeout_ms``; the rest stays uncommitted and is replayed by
the next run, which starts after the last commit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..params import DEFAULT_BUCKET_SIZE, check_non_negative
from . import frontier as fr
from .attempts import CANCELED_ERROR, is_failure
from .prefix import first_k, running_agg

#: Later than any time, with room for a drain timeout.
NEVER_MS = 1 << 62


def drain_split(outcome_rows: DataFrame, fetched: DataFrame | None, stop_ms: int | Column,
                drain_timeout_ms: int) -> DataFrame:
    """where each record stands after a shutdown at ``stop_ms``, a number or
    a scalar column.

    ``split``: ``not_dispatched`` (fetched at or after the stop), ``finished``
    (last try ended by the stop), ``drained`` (ended inside the drain window)
    or ``unfinished``.  ``final_status``: ``done`` / ``exhausted`` for finished
    and drained records, else the split.  ``done_ms`` is kept only for
    records that are done by the end of the window.  ``fetched`` supplies
    ``fetched_ms`` when the outcome rows do not carry it.
    """
    check_non_negative("drain_timeout_ms", drain_timeout_ms)
    stop = F.lit(stop_ms)
    cut = stop + F.lit(int(drain_timeout_ms))
    rows = outcome_rows if fetched is None else outcome_rows.join(
        fetched.select("partition", "offset", "fetched_ms"), ["partition", "offset"])
    split = (F.when(F.col("fetched_ms") >= stop, F.lit("not_dispatched"))
             .when(F.col("end_ms") <= stop, F.lit("finished"))
             .when(F.col("end_ms") <= cut, F.lit("drained"))
             .otherwise(F.lit("unfinished")))
    rows = rows.withColumn("split", split)
    ended = F.col("split").isin("finished", "drained")
    return rows.select(
        "partition", "offset", "key", "fetched_ms", "split",
        F.when(ended, F.col("status")).otherwise(F.col("split")).alias("final_status"),
        F.when(ended, F.col("done_ms")).alias("done_ms"))


def replay_set(split_rows: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Everything fetched and not committed comes back on restart.

    reason: ``exhausted`` / ``unfinished`` / ``not_dispatched`` /
    ``blocked_done`` (done, but behind a gap).
    """
    above = fr.above_committed(split_rows, snapshot, "last_committed")
    reason = F.when(F.col("final_status") == "done", F.lit("blocked_done")).otherwise(F.col("final_status"))
    return above.select("partition", "offset", "key", reason.alias("reason"))


def replay_duplicates(replay: DataFrame, earlier_done: DataFrame) -> DataFrame:
    """Replayed records that the earlier run already processed."""
    return replay.join(earlier_done.select("partition", "offset"), ["partition", "offset"], "left_semi")


def phase_union(*phases: tuple[int, DataFrame]) -> DataFrame:
    """O3: outcome tables of several runs, tagged with their phase."""
    out = None
    for phase, df in phases:
        tagged = df.withColumn("phase", F.lit(int(phase)))
        out = tagged if out is None else out.unionByName(tagged)
    return out


def success_histogram(produced: DataFrame, successes: DataFrame) -> DataFrame:
    """Records by number of successful processings over all phases.

    A row with ``successes = 0`` is loss; more than 1 is duplication.
    """
    per = successes.groupBy("partition", "offset").agg(F.count(F.lit(1)).alias("successes"))
    joined = (produced.select("partition", "offset")
              .join(per, ["partition", "offset"], "left")
              .withColumn("successes", F.coalesce("successes", F.lit(0)).cast("bigint")))
    return joined.groupBy("successes").agg(F.count(F.lit(1)).alias("records"))


def lost_records(produced: DataFrame, successes: DataFrame) -> DataFrame:
    """Produced records never processed successfully (must be empty)."""
    return produced.join(successes.select("partition", "offset"), ["partition", "offset"], "left_anti")


def resume_scan(records: DataFrame, committed: DataFrame) -> DataFrame:
    """Per partition, where a restarted reader starts and what it reads.

    Starts after the last commit; from the earliest offset when the partition
    never committed.  A partition that is read to its end has ``to_read`` 0.
    """
    c = committed.groupBy("partition").agg(F.max("committed_through").alias("committed_through"))
    rows = records.select("partition", "offset").join(F.broadcast(c), "partition", "left")
    unread = F.col("committed_through").isNull() | (F.col("offset") > F.col("committed_through"))
    agg = rows.groupBy("partition").agg(F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"),
                                        F.count_if(unread).alias("to_read"), F.max("committed_through").alias("through"))
    return agg.select("partition", F.coalesce(F.col("through") + 1, F.col("first_offset")).alias("start_offset"),
                      "last_offset", "to_read")


def starting_offsets_json(resume: DataFrame, topic: str) -> Column:
    """``startingOffsets`` JSON for the Kafka source from a resume scan."""
    return F.to_json(F.create_map(F.lit(topic), F.map_from_entries(F.collect_list(
        F.struct(F.col("partition").cast("string"), F.col("start_offset"))))))


def commit_outcomes(timeline: DataFrame, failing_first: int,
                    bucket_size: int = DEFAULT_BUCKET_SIZE) -> DataFrame:
    """Commit log where the first ``failing_first`` commits of every partition fail."""
    cols = ["partition", "committed_through", "commit_ms"]
    if failing_first <= 0:
        return timeline.select(*cols, F.lit(True).alias("ok"))
    bucket = F.floor(F.col("commit_ms") / F.lit(60_000)).cast("bigint")
    failed = (first_k(timeline.select("partition", "commit_ms"), ["partition"], "commit_ms",
                      bucket, failing_first, "_rk")
              .select("partition", "commit_ms", F.lit(False).alias("_fail")))
    return (timeline.join(failed, ["partition", "commit_ms"], "left")
            .select(*cols, F.col("_fail").isNull().alias("ok")))


def failing_from(timeline: DataFrame, fail_from_ms: int) -> DataFrame:
    """Commit log of a timeline when every commit from an instant on fails."""
    return timeline.select("partition", "committed_through", "commit_ms",
                           (F.col("commit_ms") < F.lit(int(fail_from_ms))).alias("ok"))


def commit_failure_stop(commits: DataFrame) -> Column:
    """the instant of the first failed commit of any partition, which ends
    intake, as a scalar; beyond all times where none fails."""
    return commits.where(~F.col("ok")).agg(F.coalesce(F.min("commit_ms"), F.lit(NEVER_MS))).scalar()


def commit_outcome_summary(commits: DataFrame) -> DataFrame:
    """durable vs in-memory frontier and the intake cut-off.

    ``first_failure_ms`` is the earliest failed commit of any partition: the
    moment intake stops.  It is a minimum over the per-partition summary,
    which has one row per log partition, so the all-rows window is bounded
    by the partition count (no second pass over the commit log).
    """
    per = commits.groupBy("partition").agg(
        F.max(F.when(F.col("ok"), F.col("committed_through"))).alias("durable_frontier"),
        F.max("committed_through").alias("memory_frontier"),
        F.count_if(~F.col("ok")).alias("failed_commits"),
        F.min(F.when(~F.col("ok"), F.col("commit_ms"))).alias("_first_fail"))
    return per.select("partition", "durable_frontier", "memory_frontier", "failed_commits",
                      F.min("_first_fail").over(Window.partitionBy()).alias("first_failure_ms"))


def processed_count(outcome_rows: DataFrame, commits: DataFrame) -> DataFrame:
    """A5: handler successes whose own commit, if any, did not fail.

    Done-but-blocked records count: they returned without error.
    """
    done = outcome_rows.groupBy("partition").agg(F.count_if(F.col("done_ms").isNotNull()).alias("done"))
    failed = commits.groupBy("partition").agg(F.count_if(~F.col("ok")).alias("failed_commits"))
    return (done.join(failed, "partition", "left")
            .select("partition", "done",
                    F.coalesce("failed_commits", F.lit(0)).cast("bigint").alias("failed_commits"),
                    (F.col("done") - F.coalesce("failed_commits", F.lit(0))).cast("bigint").alias("processed")))


def kth_smallest(values: DataFrame, col: str, k: int, bucket_width: int) -> DataFrame:
    """The ``k``-th smallest ``col`` (1-based) as a one-row DataFrame ``value``.

    Bucket counts and their prefix sums locate the one bucket that holds it;
    only that bucket's rows are ranked.  Empty when fewer than k rows.
    """
    rows = values.select(F.col(col).alias("v"))
    rows = rows.withColumn("b", F.floor(F.col("v") / F.lit(bucket_width)).cast("bigint"))
    counts = rows.groupBy("b").agg(F.count(F.lit(1)).alias("n"))
    w = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    target = (counts.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0)))
              .where((F.col("before") < k) & (F.col("before") + F.col("n") >= k))
              .select("b", (F.lit(k) - F.col("before")).alias("r")))
    inb = rows.join(F.broadcast(target), "b")
    wr = Window.partitionBy("b").orderBy("v")
    return inb.withColumn("rk", F.row_number().over(wr)).where(F.col("rk") == F.col("r")).select(
        F.col("v").alias("value"))


def catch_up(records: DataFrame, outcome_rows: DataFrame, timeout_ms: int,
             expected: int | None = None, bucket_width: int = 1000,
             interrupt_ms: int | None = None) -> DataFrame:
    """Does the processed count reach ``expected`` within the catch-up window?

    The window opens when the producer is done (last record written) and
    lasts ``timeout_ms``, or until ``interrupt_ms`` if that comes first; with a
    timeout of 0 nothing is waited for.  ``expected`` defaults to the number of
    records.  ``processed_at_deadline`` counts up to the end of the window.
    Status: ``caught_up``, ``timeout``, ``interrupted`` or ``not_waited``.
    Global values are scalar subqueries, computed once.  One row:
    (expected, producer_done_ms, deadline_ms, processed_at_deadline,
    caught_up_ms, status).
    """
    check_non_negative("timeout_ms", timeout_ms)
    producer_done = records.agg(F.max("fetched_ms")).scalar()
    deadline = producer_done + F.lit(int(timeout_ms))
    ends = deadline
    if interrupt_ms is not None:
        ends = F.least(deadline, F.greatest(F.lit(int(interrupt_ms)), producer_done))
    done = outcome_rows.where(F.col("done_ms").isNotNull()).select("done_ms")
    if expected is None:
        # k = number of records: reached only when every record is done,
        # and then it is the last completion time
        exp = records.agg(F.count(F.lit(1))).scalar()
        summary = done.agg(F.count(F.lit(1)).alias("n_done"), F.max("done_ms").alias("last_done"),
                           F.count_if(F.col("done_ms") <= ends).alias("at_deadline"))
        reach = F.when(F.col("n_done") >= exp, F.col("last_done"))
    else:
        exp = F.lit(int(expected)).cast("bigint")
        kth = kth_smallest(done, "done_ms", int(expected), bucket_width).agg(F.max("value")).scalar()
        summary = done.agg(F.count_if(F.col("done_ms") <= ends).alias("at_deadline"))
        reach = kth
    waited = F.lit(int(timeout_ms) > 0)
    caught = F.when(waited & (reach <= ends), F.greatest(reach, producer_done))
    return summary.select(
        exp.cast("bigint").alias("expected"),
        producer_done.alias("producer_done_ms"),
        deadline.alias("deadline_ms"),
        F.col("at_deadline").cast("bigint").alias("processed_at_deadline"),
        caught.alias("caught_up_ms"),
        F.when(~waited, F.lit("not_waited")).when(caught.isNotNull(), F.lit("caught_up"))
        .when(ends < deadline, F.lit("interrupted")).otherwise(F.lit("timeout")).alias("status"))


def active_jobs(intervals: DataFrame, start: str, end: str, bucket_ms: int = 60_000) -> DataFrame:
    """Number of jobs in progress after every change point.

    A job counts from ``start`` (dispatch) up to ``end``.  (ts_ms, delta, active)
    """
    ev = intervals.select(F.explode(F.array(
        F.struct(F.col(start).alias("ts_ms"), F.lit(1).cast("bigint").alias("d")),
        F.struct(F.col(end).alias("ts_ms"), F.lit(-1).cast("bigint").alias("d")))).alias("e"))
    per_ts = ev.groupBy(F.col("e.ts_ms").alias("ts_ms")).agg(F.sum("e.d").cast("bigint").alias("delta"))
    bucket = F.floor(F.col("ts_ms") / F.lit(bucket_ms)).cast("bigint")
    return running_agg(per_ts, [], ["ts_ms"], bucket, "delta", "active", how="sum")


def error_kinds(attempt_rows: DataFrame) -> DataFrame:
    """Attempts by error kind, and whether the kind counts as a failure."""
    return (attempt_rows.where(F.col("error").isNotNull())
            .groupBy("error").agg(F.count(F.lit(1)).alias("attempts"))
            .withColumn("is_failure", is_failure("error")))


def drain_attempts(attempt_rows: DataFrame, stop_ms: int, drain_timeout_ms: int,
                   fetched: DataFrame | None = None) -> DataFrame:
    """Attempts as a shutdown leaves them: tries that start after the drain
    window never run; a try still running at its end is cancelled.
    ``fetched`` supplies ``fetched_ms`` when the attempt rows do not carry it."""
    cut = int(stop_ms) + int(drain_timeout_ms)
    rows = attempt_rows if fetched is None else attempt_rows.join(
        fetched.select("partition", "offset", "fetched_ms"), ["partition", "offset"])
    rows = rows.where((F.col("fetched_ms") < F.lit(stop_ms)) & (F.col("start_ms") < F.lit(cut)))
    cancelled = F.col("end_ms") > F.lit(cut)
    return rows.select(
        "partition", "offset", "key", "attempt", "start_ms",
        F.least(F.col("end_ms"), F.lit(cut)).alias("end_ms"),
        (F.col("ok") & ~cancelled).alias("ok"),
        F.when(cancelled, F.lit(CANCELED_ERROR)).otherwise(F.col("error")).alias("error"))
