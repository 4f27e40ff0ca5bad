"""F7 as a stateful stream: tries now, retries when their timer fires.

Keyed by (log partition, key bucket).  A new record is tried at once; where it fails
and the retry policy allows another try, the record goes into the group's state
and a processing-time timer is registered for the end of its wait.  When the timer
fires, the records that are due are tried again, all together.  No task sleeps, so a
long backoff holds no slot, and other records of the group go on meanwhile.  The
state holds only waiting records and is part of the checkpoint: a restarted query
goes on with the retries that were open.  A redelivery of a record that waits is
dropped (T2).

State is read and written in blocks (Arrow, up to ``HELD_ROWS`` records that are due
together), as every call to the store is a round trip: their number follows the
micro-batches and groups, not the records.

The attempts rows carry the record's own clock (``operators.handler``), so they do not
depend on when the micro-batches ran.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from ..operators.handler import ATTEMPT_SCHEMA, Handler, Tries
from ..params import RetryPolicy, check_positive
from .frontier import STATE_STORE_PROVIDER

KEY_BUCKETS = 32
#: Waiting records in one entry of the state.
HELD_ROWS = 4096


class RetryProcessor(StatefulProcessor):
    def __init__(self, tries: Tries, record: StructType) -> None:
        self.tries, self.columns = tries, record.names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "due_ms bigint, block int", "records binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        held = {k: _unpacked(v[0])["offset"].to_numpy() for k, v in self.waiting.iterator()}
        for batch in rows:
            waits = np.concatenate(list(held.values())) if held else np.zeros(0, dtype=np.int64)
            fresh = batch[~batch["offset"].isin(waits)].drop_duplicates("offset")
            if len(fresh):
                clock = fresh["fetched_ms"].fillna(0) if "fetched_ms" in fresh else 0
                yield self._try(fresh[self.columns].assign(attempt=np.int32(1), clock_ms=clock), now, held)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = max(timerValues.getCurrentProcessingTimeInMs(), expiredTimerInfo.getExpiryTimeInMs())
        held, due = {}, {}
        for k, v in self.waiting.iterator():
            (due if k[0] <= now else held)[k] = v[0]
        for k in due:
            self.waiting.removeKey(tuple(k))
        if due:
            yield self._try(pd.concat([_unpacked(v) for v in due.values()], ignore_index=True), now, held)

    def _try(self, rows: pd.DataFrame, now: int, held: dict) -> pd.DataFrame:
        """One try of the rows; what is to be tried again goes into the state and, as offsets, into ``held``."""
        tried, again = self.tries.run(rows)
        for due, part in again.groupby(now + again.pop("wait_ms")):
            block = max((k[1] + 1 for k in held if k[0] == due), default=0)
            for at in range(0, len(part), HELD_ROWS):
                some = part.iloc[at:at + HELD_ROWS]
                self.waiting.updateValue((int(due), block), (_packed(some),))
                held[int(due), block] = some["offset"].to_numpy()
                block += 1
            self.handle.registerTimer(int(due))
        return tried

    def close(self) -> None:
        pass


def _packed(rows: pd.DataFrame) -> bytes:
    table, out = pa.Table.from_pandas(rows, preserve_index=False), pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema) as stream:
        stream.write_table(table)
    return out.getvalue().to_pybytes()


def _unpacked(block: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(pa.py_buffer(bytes(block))).read_pandas()


def streaming_attempts(records: DataFrame, handler: Handler, policy: RetryPolicy, key_buckets: int = KEY_BUCKETS) -> DataFrame:
    """One attempts row per try of every record of the stream."""
    check_positive("key_buckets", key_buckets)
    records.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE_PROVIDER)
    keyed = records.withColumn("key_bucket", F.pmod(F.xxhash64("key"), F.lit(key_buckets)).cast("int"))
    return keyed.groupBy("partition", "key_bucket").transformWithStateInPandas(
        statefulProcessor=RetryProcessor(Tries(handler, policy), records.schema), outputStructType=ATTEMPT_SCHEMA,
        outputMode="Append", timeMode="ProcessingTime")
