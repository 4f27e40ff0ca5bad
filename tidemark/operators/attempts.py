"""Processing attempts: retry expansion, outcomes, overrides, failure counters.

Input records carry ``failures`` (failed tries the handler would produce
before succeeding) and ``latency_ms`` (time spent on every try, failed or
not).  A record is tried ``least(failures, n) + 1`` times; it is ``done``
when ``failures <= n`` and ``exhausted`` otherwise.  Waits between tries
follow the retry policy.  Everything is a closed form per record except the
explicit one-row-per-try expansion, which is a bounded ``explode``.

Canonical schemas::

    attempts(partition, offset, key, attempt INT, start_ms, end_ms, ok BOOLEAN,
             error STRING, retry BOOLEAN, delay_ms BIGINT)
    outcomes(partition, offset, key, attempts INT, status STRING, done_ms BIGINT NULL,
             end_ms BIGINT)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.retry import retry_decision, total_wait
from ..params import RetryPolicy
from .prefix import running_agg

# The handler's failure text and the cancellation error text
# (a cancellation is not a failure; a deadline error is).
TRANSIENT_ERROR = "simulated transient failure"
CANCELED_ERROR = "context canceled"


def key_overrides(spark: SparkSession, overrides: dict[str, int], key: str = "key",
                  value: str = "override_ms") -> DataFrame:
    """A literal (key, value) table; its size is the dict's, so broadcasting is safe."""
    rows = [(str(k), int(v)) for k, v in sorted(overrides.items())]
    schema = f"{key} string, {value} bigint"
    return spark.createDataFrame(rows, schema)


def apply_override(df: DataFrame, overrides: DataFrame, key: str, default, out: str) -> DataFrame:
    """``out`` = per-key override when present, else ``default``."""
    value = [c for c in overrides.columns if c != key][0]
    default = F.col(default) if isinstance(default, str) else default
    joined = df.join(F.broadcast(overrides), on=key, how="left")
    return joined.withColumn(out, F.coalesce(F.col(value), default).cast("bigint")).drop(value)


def _tries(policy: RetryPolicy):
    n = policy.normalised().max_retries
    return F.least(F.col("failures"), F.lit(n)) + F.lit(1)


def outcomes(records: DataFrame, policy: RetryPolicy, keep: tuple[str, ...] = ()) -> DataFrame:
    """F3 (closed form): one outcome row per record.

    ``keep``: extra record columns carried through (saves re-joining them).
    """
    n = policy.normalised().max_retries
    tries = _tries(policy)
    end = F.col("fetched_ms") + tries * F.col("latency_ms") + total_wait(tries - 1, policy)
    done = F.col("failures") <= F.lit(n)
    return records.select(
        "partition", "offset", "key",
        tries.cast("int").alias("attempts"),
        F.when(done, F.lit("done")).otherwise(F.lit("exhausted")).alias("status"),
        F.when(done, end).cast("bigint").alias("done_ms"),
        end.cast("bigint").alias("end_ms"),
        *keep,
    )


def expand_attempts(records: DataFrame, policy: RetryPolicy, keep: tuple[str, ...] = ()) -> DataFrame:
    """F3 + F1/F2: one row per try with timing, result and retry decision.

    ``keep``: extra record columns carried onto every try.
    """
    tries = _tries(policy)
    base_cols = ["partition", "offset", "key", "fetched_ms", "latency_ms", "failures"]
    rows = records.select(
        *base_cols, *[c for c in keep if c not in base_cols],
        F.explode(F.sequence(F.lit(1), tries.cast("int"))).alias("attempt"))
    start = (F.col("fetched_ms") + (F.col("attempt") - 1) * F.col("latency_ms")
             + total_wait(F.col("attempt") - 1, policy))
    ok = F.col("attempt") > F.col("failures")
    decision = retry_decision("attempt", policy)
    return rows.select(
        "partition", "offset", "key",
        F.col("attempt").cast("int").alias("attempt"),
        start.cast("bigint").alias("start_ms"),
        (start + F.col("latency_ms")).cast("bigint").alias("end_ms"),
        ok.alias("ok"),
        F.when(~ok, F.lit(TRANSIENT_ERROR)).alias("error"),
        F.when(~ok, decision["retry"]).otherwise(F.lit(False)).alias("retry"),
        F.when(~ok, decision["delay_ms"]).otherwise(F.lit(0).cast("bigint")).alias("delay_ms"),
        *keep,
    )


def exhausted(outcome_rows: DataFrame) -> DataFrame:
    """records whose tries ran out; they stay uncommitted (a gap)."""
    return outcome_rows.where(F.col("status") == "exhausted")


def is_failure(error) -> "F.Column":
    """An error counts unless it is absent or a cancellation: the fixed text
    ``context canceled``, by itself or as the last cause of a wrapped error."""
    error = F.col(error) if isinstance(error, str) else error
    return error.isNotNull() & (error != "context canceled") & ~error.endswith(": context canceled")


def failed_attempt_counter(attempt_rows: DataFrame, bucket_size: int) -> DataFrame:
    """Running number of failed tries per (partition, key) in (offset, attempt) order."""
    rows = attempt_rows.withColumn("_fail", (~F.col("ok")).cast("bigint"))
    bucket = F.floor(F.col("offset") / F.lit(bucket_size))
    res = running_agg(rows, ["partition", "key"], ["offset", "attempt"], bucket,
                      "_fail", "failures_so_far", how="sum")
    return res.select("partition", "offset", "key", "attempt", "ok", "failures_so_far")


def key_budget_failures(records: DataFrame, budget, policy: RetryPolicy,
                        bucket_size: int) -> DataFrame:
    """Failed tries per record when failures are counted per (partition, key).

    A key with budget F fails its first F tries in total, across all of its
    records in offset order (one handler per log partition keeps the count).
    Record j of the key (0-based) then fails
    ``greatest(0, least(n + 1, F - j * (n + 1)))`` times; j comes from a
    two-level row index, so a hot key is never one task.
    ``budget``: a column (NULL or 0 = never fails), e.g. from a broadcast
    join with a literal key table or from a rule on the key.
    """
    from .prefix import row_index

    n = policy.normalised().max_retries
    budget = F.col(budget) if isinstance(budget, str) else budget
    rows = records.withColumn("_budget", budget.cast("bigint"))
    bucket = F.floor(F.col("offset") / F.lit(bucket_size))
    ranked = row_index(rows, ["partition", "key"], ["offset"], bucket, "_j")
    # least/greatest skip NULLs, so a missing budget is handled before them
    fails = F.when(F.col("_budget").isNull(), F.lit(0)).otherwise(
        F.greatest(F.lit(0), F.least(F.lit(n + 1), F.col("_budget") - F.col("_j") * F.lit(n + 1))))
    return ranked.withColumn("failures", fails.cast("int")).drop("_budget", "_j")
