"""user handlers with bounded retry, run inside Spark tasks.

A handler is a vectorised Python function: it receives a pandas DataFrame of
records (plus the ``attempt`` number) and returns, row by row, whether each was
processed: a boolean Series, or a DataFrame with ``ok`` and, if it likes, ``error``
(text) and ``took_ms``.  A handler that raises fails the tries of the rows it was
given, never the job: the rows are halved until the raising ones stand alone (on a
retry they are handed over apart from the others), and each of those is a failed try with the exception's type and text (and its
``took_ms`` attribute, if it has one).  Rows beside them are handed over again, which
is at-least-once delivery like everything here.

``handle_records`` (batch) retries the failed rows under the retry policy and emits
one attempts row per try, with its error, start and end.  Times run on the record's
own clock: the first try starts when the record was fetched, a try ends ``took_ms``
later and the next one starts after the policy's wait.  Nothing is slept and no
record is put off.  Waiting for real is ``streaming.handler``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import RetryPolicy

ATTEMPT_SCHEMA = ("partition int, offset bigint, key string, attempt int, start_ms bigint, end_ms bigint, "
                  "ok boolean, error string, retry boolean, delay_ms bigint")

Handler = Callable[[pd.DataFrame], "pd.Series | pd.DataFrame"]
#: Error of a try that failed without saying why.
FAILED = "failed"
#: Column that marks rows whose last try raised; handlers do not see it.
RAISED = "__raised"


def one_try(handler: Handler, rows: pd.DataFrame, raised: np.ndarray | None = None) -> pd.DataFrame:
    """``ok``, ``error``, ``took_ms`` and ``raised`` of one try of every row, in row order.

    ``raised`` marks rows whose last try raised: they are handed over by themselves, all
    together and, if that raises, one by one, so that a retry does not search for them
    again.  Where the first half of raising rows does not raise, the second half does, and
    is halved without a call."""
    n = len(rows)
    last = np.zeros(n, dtype=bool) if raised is None else np.asarray(raised, dtype=bool)
    place = np.argsort(last, kind="stable")
    rows, calm = rows.iloc[place], int(n - last.sum())
    ok, took, thrown = np.zeros(n, dtype=bool), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=bool)
    error = np.full(n, None, dtype=object)

    def raises(a: int, b: int) -> bool:
        try:
            res = handler(rows.iloc[a:b].copy())
        except Exception as e:  # noqa: BLE001 - whatever a handler raises is a failed try
            if b - a == 1:
                thrown[place[a]], error[place[a]], took[place[a]] = True, f"{type(e).__name__}: {e}", int(getattr(e, "took_ms", 0))
            return True
        at = place[a:b]
        ok[at], error[at], took[at] = _told(res, b - a)
        return False

    def halve(a: int, b: int) -> None:
        """Rows that raise together."""
        if b - a == 1:
            return
        mid = (a + b) // 2
        if raises(a, mid):
            halve(a, mid)
            if raises(mid, b):
                halve(mid, b)
        elif b - mid > 1:
            halve(mid, b)
        else:
            raises(mid, b)

    if calm and raises(0, calm):
        halve(0, calm)
    if calm < n and raises(calm, n) and n - calm > 1:
        for x in range(calm, n):
            raises(x, x + 1)
    return pd.DataFrame({"ok": ok, "error": error, "took_ms": took, "raised": thrown})


def _told(res: pd.Series | pd.DataFrame, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray | int]:
    """``ok``, ``error`` and ``took_ms`` of a handler's answer for ``n`` rows."""
    told = res if isinstance(res, pd.DataFrame) else pd.DataFrame({"ok": np.asarray(res)})
    if len(told) != n:
        raise ValueError(f"the handler answered {len(told)} of {n} rows")
    ok = told["ok"]
    ok = (ok if ok.dtype == bool else ok.fillna(False).astype(bool)).to_numpy()
    error = told["error"].to_numpy(dtype=object) if "error" in told else np.full(n, None, dtype=object)
    error = np.where(ok, None, np.where(pd.isna(error), FAILED, error))
    took = told["took_ms"].fillna(0).to_numpy(dtype=np.int64) if "took_ms" in told else 0
    return ok, error, took


class Tries:
    """Tries of record batches under a retry policy (normalised once, on the driver)."""

    def __init__(self, handler: Handler, policy: RetryPolicy) -> None:
        pol = policy.normalised()
        self.handler, self.retries, self.waits = handler, pol.max_retries, np.array(pol.delay_table(), dtype=np.int64)

    def run(self, rows: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
        """One try of every row (``attempt`` and ``clock_ms`` say which and when, ``raised``,
        if there, whether the last one raised): the attempts rows, and the rows to be tried
        again with their next number and time."""
        rows = rows.reset_index(drop=True)
        raised = rows.pop(RAISED).to_numpy() if RAISED in rows else None
        told = one_try(self.handler, rows, raised)
        attempt, start = rows["attempt"].to_numpy(dtype=np.int64), rows["clock_ms"].to_numpy(dtype=np.int64)
        ok, end = told["ok"].to_numpy(), start + told["took_ms"].to_numpy()
        retry = ~ok & (attempt >= 1) & (attempt <= self.retries)
        wait = np.where(retry, self.waits[np.clip(attempt, 1, len(self.waits)) - 1], 0)
        tried = pd.DataFrame({
            "partition": rows["partition"].astype("int32"), "offset": rows["offset"].astype("int64"), "key": rows["key"],
            "attempt": attempt.astype("int32"), "start_ms": start, "end_ms": end, "ok": ok, "error": told["error"],
            "retry": retry, "delay_ms": wait.astype("int64")})
        again = rows[retry].assign(attempt=(attempt + 1)[retry].astype("int32"), clock_ms=(end + wait)[retry])
        return tried, again.assign(wait_ms=wait[retry], **{RAISED: told["raised"].to_numpy()[retry]})


def handle_records(records: DataFrame, handler: Handler, policy: RetryPolicy) -> DataFrame:
    """Run ``handler`` over every record with bounded retry; one row per try."""
    tries = Tries(handler, policy)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            clock = pdf["fetched_ms"].fillna(0) if "fetched_ms" in pdf else 0
            pending = pdf.assign(attempt=np.int32(1), clock_ms=clock)
            while len(pending):
                tried, again = tries.run(pending)
                yield tried
                pending = again.drop(columns="wait_ms")

    return records.mapInPandas(run, ATTEMPT_SCHEMA)


def handler_outcomes(attempt_rows: DataFrame) -> DataFrame:
    """Outcome per record from handler attempts: done or exhausted, when it was done,
    when its last try ended, and the error of that one."""
    last = F.max_by(F.struct("ok", "end_ms", "error"), "attempt")
    return attempt_rows.groupBy("partition", "offset", "key").agg(F.max("attempt").alias("attempts"), last.alias("last")).select(
        "partition", "offset", "key", "attempts", F.when(F.col("last.ok"), F.lit("done")).otherwise(F.lit("exhausted")).alias("status"),
        F.when(F.col("last.ok"), F.col("last.end_ms")).alias("done_ms"), F.col("last.end_ms").alias("end_ms"), F.col("last.error").alias("error"))
