"""Retry decision and capped exponential backoff as column expressions.

The policy is a driver-side literal, so every per-attempt quantity is a
lookup into a short constant array: no loops, no UDF, full codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import RetryPolicy


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _long_array(values: list[int]) -> Column:
    return F.array(*[F.lit(int(v)).cast("bigint") for v in values])


def backoff_delay(attempt, policy: RetryPolicy) -> Column:
    """Delay in ms before retrying after failed try ``attempt`` (>= 1).

    ``min(base * 2^(attempt-1), max)``; 0 when base <= 0 or attempt < 1.
    """
    attempt = _col(attempt)
    table = policy.delay_table()
    idx = F.least(attempt.cast("int"), F.lit(len(table)))
    return F.when(attempt >= 1, F.element_at(_long_array(table), idx)).otherwise(F.lit(0).cast("bigint"))


def retry_allowed(attempt, policy: RetryPolicy) -> Column:
    """Retry iff 1 <= attempt <= max_retries."""
    attempt = _col(attempt)
    n = policy.normalised().max_retries
    return attempt.between(1, n) if n >= 1 else F.lit(False)


def retry_decision(attempt, policy: RetryPolicy) -> Column:
    """struct(retry BOOLEAN, delay_ms BIGINT) for a failed try ``attempt``."""
    retry = retry_allowed(attempt, policy)
    delay = F.when(retry, backoff_delay(attempt, policy)).otherwise(F.lit(0).cast("bigint"))
    return F.struct(retry.alias("retry"), delay.alias("delay_ms"))


def total_wait(failed_tries, policy: RetryPolicy) -> Column:
    """Sum of backoff waits after ``failed_tries`` (0..max_retries) failures."""
    sums = policy.delay_prefix_sums()
    m = F.least(F.greatest(_col(failed_tries).cast("int"), F.lit(0)), F.lit(len(sums) - 1))
    return F.element_at(_long_array(sums), m + 1)
