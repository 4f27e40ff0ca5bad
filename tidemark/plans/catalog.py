"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query runs the delivery model (``model.py``) over the whole input
tables; none samples, caps or filters rows to stay cheap.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import attempts as att
from ..operators import evidence as ev
from ..operators import frontier as fr
from ..operators import handler as hd
from ..operators import lifecycle as lc
from ..params import DEFAULT_BUCKET_SIZE
from ..session import scratch_path
from ..sources.records import read_table, records_from_table
from ..sources.textlog import PARTITION_DIR, read_logs_lines
from ..streaming import pipeline as sp
from ..streaming.frontier import streaming_frontier
from .model import LOG_ORDER, RESTART_AT_MS, SHUTDOWN_AT_MS, Model, Run

Query = Callable[[SparkSession, str], DataFrame]
_M = Model()


def _run(spark: SparkSession, d: str) -> Run:
    return _M.run(spark, d)


# -- records, attempts, outcomes ------------------------------------------------
def _key_partition(spark, d):
    r = _run(spark, d).records
    return r.groupBy("key", "partition").agg(F.count(F.lit(1)).alias("records"))


def _offset_assign(spark, d):
    return _run(spark, d).records


def _baseline_offset(spark, d):
    return _run(spark, d).base


def _key_override(spark, d):
    h = _run(spark, d).handled
    return h.groupBy("key").agg(F.min("latency_ms").alias("min_latency_ms"),
                                F.max("latency_ms").alias("max_latency_ms"),
                                F.count(F.lit(1)).alias("records"))


def _attempt_outcome(spark, d):
    return _run(spark, d).outcomes


def _attempt_expand(spark, d):
    return _run(spark, d).attempts


def _retry_schedule(spark, d):
    a = _run(spark, d).attempts
    return a.where(~F.col("ok")).select("partition", "offset", "attempt", "retry", "delay_ms")


def _exhausted(spark, d):
    return att.exhausted(_run(spark, d).outcomes)


def _failed_attempt_counter(spark, d):
    return att.failed_attempt_counter(_run(spark, d).attempts, _M.B)


# -- frontier ----------------------------------------------------------------------
def _frontier_timeline(spark, d):
    return _run(spark, d).timeline


def _frontier_snapshot(spark, d):
    r = _M.run(spark, d, materialize=False)  # read once
    return fr.frontier_snapshot(r.outcomes)


def _dense_timeline(spark, d):
    """W1 over a compacted log: offsets that do not exist stall nothing (Q1)."""
    return fr.frontier_timeline(_run(spark, d).compacted_outcomes, bucket_size=_M.B, dense=True)


def _dense_snapshot(spark, d):
    """A2 and A3 over a compacted log."""
    out = _run(spark, d).compacted_outcomes
    return fr.pending_count(out, fr.frontier_snapshot(out, dense=True))


def _blocked_by_gap(spark, d):
    r = _run(spark, d)
    return fr.blocked_by_gap(r.outcomes, bucket_size=_M.B)


def _pending_count(spark, d):
    r = _run(spark, d)
    return fr.pending_count(r.outcomes, r.snapshot)


def _tracker_snapshot(spark, d):
    r = _run(spark, d)
    return fr.tracker_snapshot(r.outcomes, r.snapshot, _M.B)


def _final_commit(spark, d):
    return fr.final_commit(_run(spark, d).commits)


def _commit_record_lookup(spark, d):
    r = _run(spark, d)
    return fr.commit_record_lookup(r.commits, r.records)


def _unknown_commit(spark, d):
    r = _run(spark, d)
    return fr.unknown_commits(r.stored_positions, r.records)


def _untracked_completion(spark, d):
    r = _run(spark, d)
    return fr.untracked_completions(r.completions, r.records, r.base)


def _completion_class(spark, d):
    r = _run(spark, d)
    c = fr.completion_classes(r.completions, r.records, r.base, _M.B)
    return c.withColumnRenamed("class", "completion_class")


def _commit_cache(spark, d):
    r = _run(spark, d)
    return fr.commit_cache(r.records, fr.final_commit(r.commits))


def _redelivery_dedup(spark, d):
    r = _run(spark, d)
    again = (fr.above_committed(r.records, r.snapshot, "last_committed")
             .withColumn("fetched_ms", F.lit(RESTART_AT_MS).cast("bigint")))
    fetches = r.records.select("partition", "offset", "fetched_ms").unionByName(
        again.select("partition", "offset", "fetched_ms"))
    return fr.redelivery_dedup(fetches, fr.final_commit(r.commits))


# -- lifecycle ---------------------------------------------------------------------
def _drain_split(spark, d):
    return (_run(spark, d).split.groupBy("partition", "split", "final_status")
            .agg(F.count(F.lit(1)).alias("records")))


def _replay_set(spark, d):
    return _run(spark, d).replay


def _replay_duplicates(spark, d):
    r = _run(spark, d)
    return lc.replay_duplicates(r.replay, r.split.where(F.col("final_status") == "done"))


def _no_loss(spark, d):
    r = _run(spark, d)
    return lc.success_histogram(r.records, r.successes)


def _lost_records(spark, d):
    r = _run(spark, d)
    return lc.lost_records(r.records, r.successes)


def _replay_timeline(spark, d):
    return _run(spark, d).replay_timeline


def _resume_scan(spark, d):
    r = _run(spark, d)
    return lc.resume_scan(r.records, fr.final_commit(r.phase1_commits))


def _commit_outcome(spark, d):
    return lc.commit_outcome_summary(_run(spark, d).failing_commits)


def _processed_count(spark, d):
    r = _run(spark, d)
    return lc.processed_count(r.cut_split, r.failing_commits)


# Fixed value: records that a caller waits for in the second and third row of catch_up.
CATCH_UP_EXPECTED = 500


def _catch_up(spark, d):
    r = _run(spark, d)
    timeout = _M.params.drain_timeout_ms
    rows = [lc.catch_up(r.records, r.outcomes, t, expected, interrupt_ms=stop) for t, expected, stop in
            ((timeout, None, None), (timeout, CATCH_UP_EXPECTED, None), (0, CATCH_UP_EXPECTED, None),
             (timeout, None, SHUTDOWN_AT_MS))]
    return reduce(DataFrame.unionByName, rows)


def _active_jobs(spark, d):
    r = _run(spark, d)
    return lc.active_jobs(r.outcomes_fetched, "fetched_ms", "end_ms")


def _error_filter(spark, d):
    r = _run(spark, d)
    a = att.expand_attempts(r.handled, _M.policy, keep=("fetched_ms",))
    da = lc.drain_attempts(a, SHUTDOWN_AT_MS, _M.params.drain_timeout_ms)
    return lc.error_kinds(da)


# -- log evidence ------------------------------------------------------------------
def _log_parse(spark, d):
    return ev.parse_log(_run(spark, d).kept_loglines)


def _log_keyword_filter(spark, d):
    return ev.keyword_filter(_run(spark, d).kept_loglines)


def _log_out_of_order(spark, d):
    return ev.out_of_order(_run(spark, d).events, LOG_ORDER, Run.log_bucket())


def _scenario_checks(spark, d):
    r = _run(spark, d)
    scenarios = ev.derived_scenarios(r.events, LOG_ORDER, expected=Run.expected)
    ooo = ev.out_of_order(r.events, LOG_ORDER, Run.log_bucket())
    return ev.scenario_checks(r.kept_loglines, scenarios, ooo)


def _substring_count(spark, d):
    r = _run(spark, d)
    return ev.substring_count(r.kept_loglines, ev.derived_scenarios(r.events, LOG_ORDER))


def _log_first_last(spark, d):
    return ev.first_last_clock(_run(spark, d).kept_loglines, LOG_ORDER)



def _log_file_out_of_order(spark, d):
    """S8 + W3: the run log written as text files (one folder per day, lines
    in log order), read back line by line with exact line indices."""
    path = scratch_path(spark, "logfiles")
    # range partitioning splits a big day over several tasks; part files are
    # numbered in range order, so file-name order is line order for the reader
    r = _run(spark, d)
    lines = r.kept_loglines
    (lines.repartitionByRange("scenario", *LOG_ORDER).sortWithinPartitions("scenario", *LOG_ORDER)
     .select("scenario", "line").write.partitionBy("scenario").text(path))
    lines = read_logs_lines(spark, path + "/*/*.txt", PARTITION_DIR)
    bucket = F.floor(F.col("line_idx") / F.lit(_M.B)).cast("bigint")
    return ev.out_of_order(r.kept_events(lines, ["line_idx"]), ["line_idx"], bucket)


# -- given text ---------------------------------------------------------------------
# Words looked for in turns, and one word counted for each language.
TURN_KEYWORDS = ["the", "und", "quiero", "\n"]
LANGUAGE_WORDS = {"de": "und", "en": "the", "es": "que", "fr": "le"}


def _turn_keyword_filter(spark, d):
    """P1 over the turns of ``conversations``."""
    return ev.keyword_filter(read_table(spark, d, "conversations"), "text", TURN_KEYWORDS)


def _language_word_count(spark, d):
    """A8 over the texts of ``documents``: the words to count are given by language, as the
    replay keys of scenarios are; a language without a word has no row."""
    words = spark.createDataFrame(list(LANGUAGE_WORDS.items()), "lang string, replay_key string")
    return ev.substring_count(read_table(spark, d, "documents"), F.broadcast(words), "text", "lang", prefix="")


# -- a second, larger topic ---------------------------------------------------------
# Fixed values of the lineitem topic: key "order-<orderkey>", write order
# (orderkey, linenumber), fetched at the ship date; lines with return flag 'R'
# fail (linenumber mod 5) tries; every try takes 100 ms per unit of quantity.
LINE_FAIL_FLAG, LINE_FAIL_MODULUS, LINE_MS_PER_QTY = "R", 5, 100


def _lineitem_pending(spark, d):
    """Frontier and pending counts of a topic fed from ``lineitem``."""
    li = read_table(spark, d, "lineitem")
    seq = F.col("l_orderkey") * F.lit(16) + F.col("l_linenumber")
    key = F.concat(F.lit("order-"), F.col("l_orderkey").cast("string"))
    value = F.concat(F.lit("line-"), F.col("l_orderkey").cast("string"), F.lit("-"),
                     F.col("l_linenumber").cast("string"))
    fails = F.when(F.col("l_returnflag") == LINE_FAIL_FLAG, F.col("l_linenumber") % F.lit(LINE_FAIL_MODULUS))
    recs = records_from_table(li, key, value, seq, "l_shipdate", bucket_size=_M.B, keep={
        "failures": F.coalesce(fails, F.lit(0)).cast("int"),
        "latency_ms": F.round(F.col("l_quantity") * F.lit(LINE_MS_PER_QTY)).cast("bigint")})
    r = Run(_M, spark, d)
    handled = r._keep(recs, "lineitem-handled")
    out = att.outcomes(handled, _M.policy)
    snap = r._keep(fr.frontier_snapshot(out), "lineitem-snapshot")
    return fr.pending_count(out, snap)


# -- streaming ---------------------------------------------------------------------
# Rows of a file, and files at least: a topic of any size gives several micro-batches.
STREAM_FILE_ROWS, STREAM_FILES = 1 << 20, 8
STREAM_FILES_PER_TRIGGER = 2


def _stream_files(rows: DataFrame) -> int:
    return max(STREAM_FILES, -(-rows.count() // STREAM_FILE_ROWS))


def _stream_bucket(r: Run) -> int:
    """Offsets per state bucket: the model's, and the default where every log partition then has ten buckets, too."""
    shortest = r.records.groupBy("partition").count().agg(F.min("count")).first()[0] or 0
    return max(_M.B, DEFAULT_BUCKET_SIZE) if shortest >= 10 * DEFAULT_BUCKET_SIZE else _M.B


def _stream_frontier(spark, d):
    """T1 over a completion log: files in completion-time order, two per micro-batch."""
    r = _run(spark, d)
    work = scratch_path(spark, "stream-frontier")
    done = r.outcomes.where(F.col("done_ms").isNotNull()).select("partition", "offset", "done_ms")
    done.repartitionByRange(_stream_files(done), "done_ms").write.parquet(f"{work}/completions")
    stream = (spark.readStream.schema("partition int, offset bigint, done_ms bigint")
              .option("maxFilesPerTrigger", STREAM_FILES_PER_TRIGGER).parquet(f"{work}/completions"))
    adv = streaming_frontier(stream, r.base, _stream_bucket(r))
    sp.run_available(sp.commit_sink(adv, f"{work}/commits", f"{work}/ckpt"))
    return sp.read_commits(spark, f"{work}/commits")


def _stream_pipeline(spark, d):
    """T4: file log -> user handler with retry timers -> attempts -> T1 -> commit sink."""
    r = _run(spark, d)
    work = scratch_path(spark, "stream-pipeline")
    log = r.handled.select("partition", "offset", "key", "value", "fetched_ms", "failures", "latency_ms")
    sp.write_log(log, f"{work}/log", _stream_files(log))
    return sp.pipeline(spark, f"{work}/log", work, model_handler, _M.policy, r.base, STREAM_FILES_PER_TRIGGER,
                       schema=sp.RECORD_SCHEMA + ", failures int, latency_ms bigint", bucket_size=_stream_bucket(r))


# -- handlers ----------------------------------------------------------------------
# Fixed values of the example user handlers: a record whose event id is 3 mod 7 fails its
# first try, one whose id is 5 mod 101 raises in every try; a try takes 10 ms per unit of
# (id mod 10).  The model's handler raises where a failing record's offset is 0 mod 97.
# Budget model: keys whose user id is 2 mod 10 fail their first 5 tries in total.
FLAKY_MODULUS, FLAKY_REMAINDER = 7, 3
RAISING_MODULUS, RAISING_REMAINDER = 101, 5
RAISING_OFFSETS = 97
MESSAGE_ID = re.compile(r"^message-(\d+):")
BUDGET_MODULUS, BUDGET_REMAINDER, BUDGET_TRIES = 10, 2, 5


class HandlerFault(RuntimeError):
    """A fault that says how long the try took."""

    def __init__(self, text: str, took_ms: int) -> None:
        super().__init__(text)
        self.took_ms = took_ms


def message_ids(value):
    """Event ids in the records' values; a value without one is an error."""
    try:  # a few rows at a time, as after a raise, are not worth pandas' operators
        return np.array([int(MESSAGE_ID.match(v)[1]) for v in value], dtype=np.int64)
    except TypeError:
        return value.str.extract(MESSAGE_ID.pattern, expand=False).astype("int64").to_numpy()


def flaky_handler(pdf):
    """Example user handler (vectorised): per row whether the try succeeds, its error and duration."""
    ids = message_ids(pdf["value"])
    took = 10 * (ids % 10)
    bad = np.flatnonzero(ids % RAISING_MODULUS == RAISING_REMAINDER)
    if len(bad):
        raise HandlerFault(f"cannot read message {ids[bad[0]]}", int(took[bad[0]]))
    ok = ~((ids % FLAKY_MODULUS == FLAKY_REMAINDER) & (pdf["attempt"].to_numpy() == 1))
    return pd.DataFrame({"ok": ok, "error": np.where(ok, None, "not yet"), "took_ms": took})


def model_handler(pdf):
    """The model's handler: a record fails its first ``failures`` tries, each takes ``latency_ms``."""
    fails = pdf["attempt"] <= pdf["failures"]
    raising = pdf[fails & (pdf["offset"] % RAISING_OFFSETS == 0)]
    if len(raising):
        raise HandlerFault("simulated fault", int(raising["latency_ms"].iloc[0]))
    return pd.DataFrame({"ok": ~fails, "took_ms": pdf["latency_ms"]})


def _user_handler(spark, d):
    r = _run(spark, d)
    return hd.handle_records(r.records, flaky_handler, _M.policy)


def _key_failure_budget(spark, d):
    r = _run(spark, d)
    digits = F.regexp_extract("key", r"^key-(\d+)$", 1)
    uid = F.when(digits != "", digits.cast("bigint"))  # ANSI casts reject ''
    budget = F.when(uid % BUDGET_MODULUS == BUDGET_REMAINDER, F.lit(BUDGET_TRIES))
    rows = att.key_budget_failures(r.records, budget, _M.policy, _M.B)
    n = _M.policy.normalised().max_retries
    return rows.select("partition", "offset", "key", "failures",
                       (F.least(F.col("failures"), F.lit(n)) + 1).cast("int").alias("attempts"),
                       F.when(F.col("failures") <= n, F.lit("done")).otherwise(F.lit("exhausted")).alias("status"))


QUERIES: dict[str, Query] = {
    "key_partition": _key_partition,
    "offset_assign": _offset_assign,
    "baseline_offset": _baseline_offset,
    "key_override": _key_override,
    "attempt_outcome": _attempt_outcome,
    "attempt_expand": _attempt_expand,
    "retry_schedule": _retry_schedule,
    "exhausted": _exhausted,
    "failed_attempt_counter": _failed_attempt_counter,
    "frontier_timeline": _frontier_timeline,
    "frontier_snapshot": _frontier_snapshot,
    "dense_timeline": _dense_timeline,
    "dense_snapshot": _dense_snapshot,
    "blocked_by_gap": _blocked_by_gap,
    "pending_count": _pending_count,
    "tracker_snapshot": _tracker_snapshot,
    "final_commit": _final_commit,
    "commit_record_lookup": _commit_record_lookup,
    "unknown_commit": _unknown_commit,
    "untracked_completion": _untracked_completion,
    "completion_class": _completion_class,
    "commit_cache": _commit_cache,
    "redelivery_dedup": _redelivery_dedup,
    "drain_split": _drain_split,
    "replay_set": _replay_set,
    "replay_duplicates": _replay_duplicates,
    "no_loss": _no_loss,
    "lost_records": _lost_records,
    "resume_scan": _resume_scan,
    "replay_timeline": _replay_timeline,
    "commit_outcome": _commit_outcome,
    "processed_count": _processed_count,
    "catch_up": _catch_up,
    "active_jobs": _active_jobs,
    "error_filter": _error_filter,
    "log_parse": _log_parse,
    "log_keyword_filter": _log_keyword_filter,
    "log_out_of_order": _log_out_of_order,
    "scenario_checks": _scenario_checks,
    "substring_count": _substring_count,
    "log_first_last": _log_first_last,
    "log_file_out_of_order": _log_file_out_of_order,
    "turn_keyword_filter": _turn_keyword_filter,
    "language_word_count": _language_word_count,
    "stream_frontier": _stream_frontier,
    "stream_pipeline": _stream_pipeline,
    "user_handler": _user_handler,
    "key_failure_budget": _key_failure_budget,
    "lineitem_pending": _lineitem_pending,
}
