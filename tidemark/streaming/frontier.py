"""The commit frontier as two chained stateful streaming operators.

Level 1 is keyed by (log partition, offset bucket) and holds the done times of one
bucket's offsets that wait behind a gap *in that bucket*.  When the contiguous head
of the bucket grows it emits one summary row: the steps of the running maximum of
done time over the new part of the head (last offset and value of each step), and
whether the bucket is now full.  Level 2 is keyed by log partition and sees only
summaries: it knows the first bucket that is not full and the maximum of done time
before it, releases summaries of that bucket at once, and keeps those of later
buckets, one map entry a bucket, until all buckets before them are full.

So the rows of a hot log partition spread over its buckets, a long stall costs
each batch only the buckets that it touches, and no group ever reads or writes
more than one bucket at a time, also when a late gap releases many.

A completion at or behind its bucket's head, or at or below the base, is a
redelivery and is dropped; a repeated waiting offset keeps its earliest done time
(T2).  Every released offset carries the running maximum of done time, which
equals the batch commit time of W1 whatever the arrival order; the reader
re-aggregates by (partition, commit_ms).

Bases come as a table with one row per log partition, e.g. from
``frontier.baseline`` over the fetched records or from the commit table on resume;
it is broadcast to the rows (bounded by the partition count).  A log partition
without one is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..params import DEFAULT_BUCKET_SIZE, check_positive

STATE_STORE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SUMMARY_SCHEMA = "partition int, bucket bigint, base bigint, start bigint, throughs array<bigint>, tops array<bigint>, full boolean"
OUTPUT_SCHEMA = "partition int, commit_ms bigint, committed_through bigint, released bigint"
_NO_CARRY = -(1 << 63)
_NOT_DONE = (1 << 63) - 1


def head_steps(done: np.ndarray, top: int) -> tuple[int, np.ndarray, np.ndarray]:
    """The contiguous head of ``done`` (times by place, ``_NOT_DONE`` where missing): its
    length, and for each step of the running maximum (from ``top`` on) the last place and the value."""
    missing = np.flatnonzero(done == _NOT_DONE)
    run = int(missing[0]) if len(missing) else len(done)
    value = np.maximum.accumulate(np.maximum(done[:run], top))
    last = np.flatnonzero(np.append(value[1:] != value[:-1], True)) if run else np.zeros(0, dtype=np.int64)
    return run, last, value[last]


class BucketProcessor(StatefulProcessor):
    """Level 1: one bucket of one log partition."""

    def __init__(self, bucket_size: int) -> None:
        self.size = bucket_size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.bucket = handle.getValueState("bucket", "head bigint, top bigint, done binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        partition, bucket = int(key[0]), int(key[1])
        head = top = done = None
        for batch in rows:
            if batch["base"].isna().any():
                raise ValueError(f"no base for log partition {partition}")
            base = int(batch["base"].iloc[0])
            if done is None:
                first = max(base + 1, bucket * self.size)
                state = self.bucket.get() if self.bucket.exists() else None
                head, top = (first, _NO_CARRY) if state is None else (int(state[0]), int(state[1]))
                left = max(0, (bucket + 1) * self.size - head)
                done = np.full(left, _NOT_DONE, dtype=np.int64) if state is None else np.frombuffer(bytes(state[2]), dtype=np.int64).copy()
            at = batch["offset"].to_numpy(dtype=np.int64) - head
            np.minimum.at(done, at[at >= 0], batch["done_ms"].to_numpy(dtype=np.int64)[at >= 0])
        if done is None or not len(done):
            return
        run, last, tops = head_steps(done, top)
        if run:
            top = int(tops[-1])
            yield pd.DataFrame({"partition": np.array([partition], dtype=np.int32), "bucket": [bucket], "base": [base], "start": [head],
                                "throughs": [head + last], "tops": [tops], "full": [run == len(done)]})
        self.bucket.update((head + run, top, done[run:].tobytes()))

    def close(self) -> None:
        pass


class FrontierProcessor(StatefulProcessor):
    """Level 2: the buckets of one log partition, by their summaries."""

    def __init__(self, bucket_size: int) -> None:
        self.size = bucket_size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.front = handle.getValueState("front", "bucket bigint, carry bigint")
        self.waiting = handle.getMapState("waiting", "bucket bigint", "start bigint, throughs array<bigint>, tops array<bigint>, full boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        front = carry = None
        for batch in rows:
            for s in batch.sort_values(["bucket", "start"]).itertuples(index=False):  # one a bucket and micro-batch
                if front is None:
                    front, carry = map(int, self.front.get()) if self.front.exists() else ((int(s.base) + 1) // self.size, _NO_CARRY)
                if s.bucket != front:
                    self._keep(int(s.bucket), s)
                    continue
                entry = (int(s.start), s.throughs, s.tops, bool(s.full))
                while entry is not None:
                    yield self._released(key[0], carry, entry)
                    full, tops = entry[3], entry[2]
                    if full:
                        carry = max(carry, int(tops[-1]))
                        front += 1
                    entry = self._take(front) if full else None
        if front is not None:
            self.front.update((front, carry))

    def _keep(self, bucket: int, s) -> None:
        entry = (int(s.start), [int(x) for x in s.throughs], [int(x) for x in s.tops], bool(s.full))
        if self.waiting.containsKey((bucket,)):
            start, throughs, tops, _ = self.waiting.getValue((bucket,))
            entry = (int(start), [*throughs, *entry[1]], [*tops, *entry[2]], entry[3])
        self.waiting.updateValue((bucket,), entry)

    def _take(self, bucket: int):
        if not self.waiting.containsKey((bucket,)):
            return None
        entry = self.waiting.getValue((bucket,))
        self.waiting.removeKey((bucket,))
        return entry

    def _released(self, partition: int, carry: int, entry) -> pd.DataFrame:
        start, throughs, tops = entry[0], np.asarray(entry[1], dtype=np.int64), np.asarray(entry[2], dtype=np.int64)
        commit = np.maximum(tops, carry)
        last = np.flatnonzero(np.append(commit[1:] != commit[:-1], True))
        through = throughs[last]
        return pd.DataFrame({"partition": np.full(len(last), partition, dtype=np.int32), "commit_ms": commit[last], "committed_through": through,
                             "released": np.diff(np.concatenate([[start - 1], through]))})

    def close(self) -> None:
        pass


def streaming_frontier(completions: DataFrame, base: DataFrame, bucket_size: int = DEFAULT_BUCKET_SIZE) -> DataFrame:
    """Frontier advances of a completion stream (partition, offset, done_ms).

    Output rows (partition, commit_ms, committed_through, released) per micro
    batch; ``final_timeline`` folds them into the W1 table.  ``base`` has the last
    committed offset of every log partition; one without it is an error.
    """
    check_positive("bucket_size", bucket_size)
    completions.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE_PROVIDER)
    rows = (completions.select("partition", "offset", "done_ms")
            .join(F.broadcast(base.select("partition", "base")), "partition", "left")
            .withColumn("bucket", F.floor(F.col("offset") / F.lit(bucket_size)).cast("bigint")))
    summaries = rows.groupBy("partition", "bucket").transformWithStateInPandas(
        statefulProcessor=BucketProcessor(bucket_size), outputStructType=SUMMARY_SCHEMA, outputMode="Append", timeMode="None")
    return summaries.groupBy("partition").transformWithStateInPandas(
        statefulProcessor=FrontierProcessor(bucket_size), outputStructType=OUTPUT_SCHEMA, outputMode="Append", timeMode="None")


def final_timeline(advances: DataFrame) -> DataFrame:
    """Fold per-batch advance rows into one row per (partition, commit_ms)."""
    return (advances.groupBy("partition", "commit_ms")
            .agg(F.max("committed_through").alias("committed_through"),
                 F.sum("released").cast("bigint").alias("released")))
