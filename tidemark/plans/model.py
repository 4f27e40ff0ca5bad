"""The delivery model run over the driver's tables.

``events`` becomes a topic: one record per event, key ``key-<user_id>``,
partition by the key hash, offsets in ``event_id`` order, fetched at the
event time.  A handler model gives every record a number of failed tries and
a latency; the retry policy turns them into attempts and outcomes; the
frontier turns outcomes into commits.  Every table is derived by Spark from
the parquet input, so its work grows with the data.

A ``Run`` is one evaluation.  Its base table (records with handler inputs)
is written once as a parquet table into the shared checkpoint folder and
read back: every query reads it several times, the read prunes columns, and
the cut lineage means a lost executor never forces the offset assignment to
rerun.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import attempts as att
from ..operators import evidence as ev
from ..operators import frontier as fr
from ..operators import lifecycle as lc
from ..params import DeliveryParams, RetryPolicy
from ..session import scratch_path
from ..sources.records import read_table, records_from_events

# Fixed values of the handler model.
# Failed tries: for events of type 'error', k mod 4 (k = the "k" property), so
# 3 retries suffice; 0 otherwise.  In one log partition the errors of the last day
# (from 2024-01-30 00:00:00 UTC) fail k mod 6 tries: 4 and 5 exhaust.
FAILING_EVENT_TYPE = "error"
FAILURE_MODULUS = 4
# Phase 2 does not get over more failing tries than STILL_FAILING.
STILL_FAILING = 4
LATE_PARTITION, LATE_FROM_MS, LATE_FAILURE_MODULUS = 0, 1706572800000, 6
# Latency of every try: 1000 ms per unit of k, unless the key has an override.
LATENCY_MS_PER_K = 1000
LATENCY_OVERRIDES_MS = {"key-0": 900, "key-3": 50, "key-5": 50}
# Shutdown instant of phase 1 (2024-01-30, in the middle of some tries) and the
# phase-2 restart (2024-02-01 00:00:00 UTC).
SHUTDOWN_AT_MS = 1706597329737
RESTART_AT_MS = 1706745600000
# Commits fail from this instant on in the commit-failure model
# (2024-01-20 00:00:00 UTC).
COMMITS_FAIL_FROM_MS = 1705708800000
# Redelivered completions: records with k mod 10 = 0 complete a second time
# this long after the first completion.
REDELIVERY_MODULUS = 10
REDELIVERY_DELAY_MS = 1000
# Wrong completions: of records with k mod 50 = 7 a second one names a partition
# that has no log, with 8 an offset beyond the log, with 9 it comes in the same
# millisecond, with 6 a millisecond before the record was fetched.
WRONG_MODULUS, EARLY, NO_LOG, BEYOND_LOG, SAME_MS = 50, 6, 7, 8, 9
OFFSET_BEYOND = 1 << 40
# Offsets per bucket over the driver's tables: at least ten buckets in each log
# partition of the smallest table that is checked.  A long log takes the default.
BUCKET_SIZE = 256
# A compacted log: records with k mod 10 = 9 are gone, and their offsets with them.
COMPACTED_MODULUS, COMPACTED_REMAINDER = 10, 9
# Values as the log shows them: text of the user that reads like messages of the consumer,
# by k mod 25.
USER_TEXT_MODULUS = 25
USER_TEXT = {11: "; exhausted retries", 12: "; ✓ Committed partition 0 through offset 3", 13: "; failed on attempt 1: x; retrying in 5ms"}
# Expectation i of a day's log is on unless (day of the month + i) mod 3 = 0.
EXPECTATION_MODULUS = 3
# Log order of rendered run logs and the time bucket of their ordered checks.
LOG_ORDER = ["ts_ms", "kind_rank", "partition", "offset", "attempt"]
LOG_BUCKET_MS = 60_000


@dataclass(frozen=True)
class Model:
    params: DeliveryParams = field(default_factory=lambda: DeliveryParams(
        retry=RetryPolicy(3, 100, 1000), bucket_size=BUCKET_SIZE))

    @property
    def policy(self) -> RetryPolicy:
        return self.params.retry

    @property
    def B(self) -> int:
        return self.params.bucket_size

    def run(self, spark: SparkSession, sf_dir: str, materialize: bool = True) -> "Run":
        return Run(self, spark, sf_dir, materialize)

    def handled_plan(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        """Records with the handler model's ``failures`` and ``latency_ms``."""
        events = read_table(spark, sf_dir, "events")
        r = records_from_events(events, self.params.partitions, self.B)
        late = (F.col("partition") == LATE_PARTITION) & (F.col("fetched_ms") >= LATE_FROM_MS)
        failures = (F.when(F.col("event_type") != FAILING_EVENT_TYPE, F.lit(0))
                    .when(late, F.col("k") % F.lit(LATE_FAILURE_MODULUS))
                    .otherwise(F.col("k") % F.lit(FAILURE_MODULUS)))
        r = r.withColumn("failures", failures.cast("int"))
        ov = att.key_overrides(spark, LATENCY_OVERRIDES_MS)
        return att.apply_override(r, ov, "key", F.col("k") * F.lit(LATENCY_MS_PER_K), "latency_ms")


class Run:
    """One evaluation of the model over ``sf_dir``."""

    def __init__(self, model: Model, spark: SparkSession, sf_dir: str, materialize: bool = True):
        self.m, self.spark, self.sf_dir, self.materialize = model, spark, sf_dir, materialize

    @property
    def B(self) -> int:
        return self.m.B

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once as a parquet table in the shared folder, read it back."""
        if not self.materialize:
            return df
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    # -- base tables -----------------------------------------------------------
    @cached_property
    def handled(self) -> DataFrame:
        return self._keep(self.m.handled_plan(self.spark, self.sf_dir), "handled")

    @cached_property
    def records(self) -> DataFrame:
        return self.handled.select("partition", "offset", "key", "value", "fetched_ms")

    @cached_property
    def base(self) -> DataFrame:
        """One row per log partition; written once, read by every branch."""
        return self._keep(fr.baseline(self.records), "base")

    @cached_property
    def outcomes(self) -> DataFrame:
        return att.outcomes(self.handled, self.m.policy)

    @cached_property
    def outcomes_fetched(self) -> DataFrame:
        """Outcomes carrying ``fetched_ms`` (no re-join with the records)."""
        return att.outcomes(self.handled, self.m.policy, keep=("fetched_ms",))

    @cached_property
    def attempts(self) -> DataFrame:
        return att.expand_attempts(self.handled, self.m.policy)

    @cached_property
    def timeline(self) -> DataFrame:
        return fr.frontier_timeline(self.outcomes, bucket_size=self.B)

    @cached_property
    def compacted_outcomes(self) -> DataFrame:
        """Outcomes of the log after compaction: some offsets do not exist."""
        kept = F.coalesce(F.col("k") % COMPACTED_MODULUS != COMPACTED_REMAINDER, F.lit(True))
        return att.outcomes(self.handled.where(kept), self.m.policy)

    @cached_property
    def commits(self) -> DataFrame:
        """Commit log of the run: one successful commit per frontier advance."""
        return self.timeline.select("partition", "committed_through", "commit_ms", F.lit(True).alias("ok"))

    @cached_property
    def snapshot(self) -> DataFrame:
        """One row per log partition; written once, read by every branch."""
        return self._keep(fr.frontier_snapshot(self.outcomes), "snapshot")

    @cached_property
    def completions(self) -> DataFrame:
        """Completion events: every done record, a second completion of records
        with k mod 10 = 0 (a redelivery inside the same run), and wrong ones."""
        done = (att.outcomes(self.handled, self.m.policy, keep=("k", "fetched_ms"))
                .where(F.col("done_ms").isNotNull()))
        wrong = F.col("k") % F.lit(WRONG_MODULUS)
        again = F.array(F.lit(0), F.when(F.col("k") % F.lit(REDELIVERY_MODULUS) == 0, F.lit(1)),
                        F.when(wrong == NO_LOG, F.lit(2)), F.when(wrong == BEYOND_LOG, F.lit(3)),
                        F.when(wrong == SAME_MS, F.lit(4)), F.when(wrong == EARLY, F.lit(5)))
        c = F.col("case")
        return done.withColumn("case", F.explode(F.array_compact(again))).select(
            F.when(c == 2, F.col("partition") + self.m.params.partitions).otherwise(F.col("partition")).alias("partition"),
            F.when(c == 3, F.col("offset") + OFFSET_BEYOND).otherwise(F.col("offset")).alias("offset"),
            F.when(c == 1, F.col("done_ms") + REDELIVERY_DELAY_MS).when(c == 5, F.col("fetched_ms") - 1)
            .otherwise(F.col("done_ms")).alias("done_ms"))

    @cached_property
    def stored_positions(self) -> DataFrame:
        """Commits, and each partition's final position as the next offset to read,
        which at the end of a log is no record."""
        final = self.commits.groupBy("partition").agg(
            (F.max("committed_through") + 1).alias("committed_through"), F.max("commit_ms").alias("commit_ms"))
        return self.commits.unionByName(final.withColumn("ok", F.lit(True)))

    # -- shutdown / replay -------------------------------------------------------
    @cached_property
    def split(self) -> DataFrame:
        """Phase 1 stops intake at SHUTDOWN_AT_MS and drains for the drain timeout."""
        return lc.drain_split(self.outcomes_fetched, None, SHUTDOWN_AT_MS, self.m.params.drain_timeout_ms)

    @cached_property
    def phase1_snapshot(self) -> DataFrame:
        """One row per log partition; written once, read by every branch."""
        return self._keep(fr.frontier_snapshot(self.split), "phase1-snapshot")

    @cached_property
    def phase1_commits(self) -> DataFrame:
        tl = fr.frontier_timeline(self.split, bucket_size=self.B)
        return tl.select("partition", "committed_through", "commit_ms", F.lit(True).alias("ok"))

    @cached_property
    def replay(self) -> DataFrame:
        return lc.replay_set(self.split, self.phase1_snapshot)

    @cached_property
    def replay_outcomes(self) -> DataFrame:
        """Phase 2: the backlog above the phase-1 frontier is fetched at the
        restart and handled without faults, one try each; what has more failing
        tries than ``STILL_FAILING`` is not done in this run either."""
        handled = self.handled.select("partition", "offset", "latency_ms", "failures")
        done = F.when(F.col("failures") <= STILL_FAILING, F.lit(RESTART_AT_MS) + F.col("latency_ms"))
        return (self.replay.join(handled, ["partition", "offset"])
                .select("partition", "offset", "key", done.cast("bigint").alias("done_ms")))

    @cached_property
    def successes(self) -> DataFrame:
        """Records that a phase has done, with the phase."""
        first = self.split.where(F.col("final_status") == "done").select("partition", "offset")
        second = self.replay_outcomes.where(F.col("done_ms").isNotNull()).select("partition", "offset")
        return lc.phase_union((1, first), (2, second))

    @cached_property
    def replay_timeline(self) -> DataFrame:
        """W1 of phase 2, resumed from the phase-1 frontier."""
        base = self.phase1_snapshot.select("partition", F.col("last_committed").alias("base"))
        return fr.frontier_timeline(self.replay_outcomes, base, self.B)

    @cached_property
    def cut_split(self) -> DataFrame:
        """The run as its first failed commit leaves it: intake stops there."""
        stop = lc.commit_failure_stop(lc.failing_from(self.timeline, COMMITS_FAIL_FROM_MS))
        return self._keep(lc.drain_split(self.outcomes_fetched, None, stop, self.m.params.drain_timeout_ms), "cut")

    @cached_property
    def failing_commits(self) -> DataFrame:
        """The commit log of that run: its drain also tries to commit, and fails."""
        return lc.failing_from(fr.frontier_timeline(self.cut_split, bucket_size=self.B), COMMITS_FAIL_FROM_MS)

    # -- run logs ----------------------------------------------------------------
    @cached_property
    def loglines(self) -> DataFrame:
        """The run's log: one file per UTC day."""
        shown = F.col("value")
        for k, text in USER_TEXT.items():
            shown = F.when(F.col("k") % USER_TEXT_MODULUS == k, F.concat("value", F.lit(text))).otherwise(shown)
        a = att.expand_attempts(self.handled.withColumn("value", shown), self.m.policy, keep=("value",))
        return ev.render_log(a, self.commits)

    @cached_property
    def kept_loglines(self) -> DataFrame:
        """``loglines`` materialised, as the log files of a real run would be:
        checks then filter a stored column instead of re-rendering text."""
        return self._keep(self.loglines, "loglines")

    @cached_property
    def events(self) -> DataFrame:
        """The parsed log, written once: checks read it several times."""
        return self.kept_events(self.kept_loglines, LOG_ORDER)

    def kept_events(self, lines: DataFrame, order: list[str]) -> DataFrame:
        """What the checks use of the parsed ``lines``, written once."""
        parsed = ev.parse_log(lines)
        return self._keep(parsed.select("scenario", *order, "kind", "log_partition", "log_offset", "log_key"), "events")

    @staticmethod
    def expected(i: int) -> Column:
        """Whether a day's log is expected to satisfy check i."""
        return (F.dayofmonth(F.to_date("scenario")) + i) % EXPECTATION_MODULUS != 0

    @staticmethod
    def log_bucket() -> Column:
        return F.floor(F.col("ts_ms") / F.lit(LOG_BUCKET_MS)).cast("bigint")
