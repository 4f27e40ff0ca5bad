"""The consume -> handle -> commit loop as streaming queries.

* S3 ``write_log``: keyed log sink, files partitioned by log partition (or
  Kafka, when the connector is on the classpath).
* S1 ``read_log_stream``: the same log as a stream, ``maxFilesPerTrigger``
  bounding each micro-batch like the consumer's bounded queue.
* S7 ``commit_sink``: the commit table, by Spark's exactly-once file sink; readers
  see the batches that its manifest names, and no others.
* T3 ``run_available``: consume what is there, then stop (``availableNow``),
  with a timeout after which the query is stopped and the uncommitted part
  is left to the next run via the checkpoint.
* T3 ``run_until``: the same for a query that never runs out of batches (timers):
  stop when the expected records are finished, on a signal or at the deadline.
* T4 ``pipeline``: query 1 runs the user handler with retry timers and appends
  attempts; query 2 runs the streaming frontier over what succeeded and writes commits.

The Kafka connector jar is not part of this environment, so the Kafka paths
are thin options that are not exercised by the tests.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..operators.handler import ATTEMPT_SCHEMA, Handler
from ..params import DEFAULT_BUCKET_SIZE, RetryPolicy
from .frontier import OUTPUT_SCHEMA, final_timeline, streaming_frontier
from .handler import streaming_attempts

#: Files of attempts per micro-batch of the frontier at least, and rows that it shall have:
#: the handler writes a file per task and micro-batch, many small ones in a wide session.
DONE_FILES, DONE_ROWS = 64, 1 << 21
RECORD_SCHEMA = "partition int, offset bigint, key string, value string, fetched_ms bigint"


def write_log(records: DataFrame, path: str, files: int | None = None) -> None:
    """S3 (files): append records, one folder per log partition.

    Range partitioning on (partition, offset) gives every task a contiguous
    offset range, so a hot log partition is written by many tasks and each
    file holds offsets in order.
    """
    ranged = (records.repartitionByRange(files, "partition", "offset") if files
              else records.repartitionByRange("partition", "offset"))
    (ranged.sortWithinPartitions("partition", "offset")
     .write.mode("append").partitionBy("partition").parquet(path))


def write_kafka(records: DataFrame, servers: str, topic: str) -> None:
    """S3 (Kafka): key/value records to a topic (needs the Kafka connector)."""
    (records.select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
                    F.col("partition"))
     .write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save())


def read_log_stream(spark: SparkSession, path: str, schema: str = RECORD_SCHEMA,
                    max_files_per_trigger: int = 1) -> DataFrame:
    """S1 (files): the log as a stream, bounded per micro-batch."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(path))


def read_kafka_stream(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "earliest",
                      max_offsets_per_trigger: int | None = None, min_partitions: int | None = None) -> DataFrame:
    """S1 (Kafka): records in the canonical schema (needs the Kafka connector).

    ``starting_offsets`` may be the JSON built from the commit table (S2).
    ``min_partitions`` splits one topic partition over several tasks.
    """
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", int(max_offsets_per_trigger))
    if min_partitions:
        r = r.option("minPartitions", int(min_partitions))
    return r.load().select(
        F.col("partition"), F.col("offset"), F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"), F.unix_millis("timestamp").alias("fetched_ms"))


def file_sink(rows: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append a stream to a table of files, exactly once.

    Spark's file sink writes a batch's files first and then one entry of the table's
    manifest (``_spark_metadata``) that names them.  Readers, batch or streaming, take
    the files from the manifest: a batch that was killed before its entry leaves no
    visible rows, and the run that repeats it adds them once."""
    return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")


def commit_sink(advances: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Frontier advances to the commit table."""
    return file_sink(advances.withColumn("ok", F.lit(True)), path, checkpoint)


def run_available(query_builder, timeout_s: float | None = None) -> str:
    """Consume everything available, then stop; with a timeout, stop then anyway."""
    q: StreamingQuery = query_builder.trigger(availableNow=True).start()
    finished = q.awaitTermination(timeout_s) if timeout_s is not None else (q.awaitTermination(), True)[1]
    if not finished:
        q.stop()
        return "timeout"
    if q.exception() is not None:
        raise q.exception()
    return "caught_up"


#: Name of the observed metric that counts finished records.
FINISHED = "finished"


def finished(attempts: DataFrame) -> DataFrame:
    """The attempts stream, observed: each micro-batch reports the records whose last try it holds."""
    return attempts.observe(FINISHED, F.count_if(~F.col("retry")).alias("n"))


def run_until(query_builder, expected: int, before: int = 0, timeout_s: float | None = None,
              interrupt: Event | None = None, poll_s: float = 0.2) -> str:
    """T3 on a live query: run until ``expected`` records are finished (``caught_up``), the
    event is set (``interrupted``) or the time is over (``timeout``), then stop intake.

    Progress is what the query reports of its committed micro-batches (``finished``);
    ``before`` were finished by earlier runs.  A micro-batch cut off by the stop is
    done again by the next run from the checkpoint."""
    end = None if timeout_s is None else time.monotonic() + timeout_s
    done: dict[int, int] = {}
    q: StreamingQuery = query_builder.trigger(processingTime="0 seconds").start()
    try:
        while True:
            if q.exception() is not None:
                raise q.exception()
            for p in q.recentProgress:
                seen = p.observedMetrics.get(FINISHED)
                if seen is not None:
                    done[p.batchId] = seen["n"]
            if before + sum(done.values()) >= expected:
                return "caught_up"
            if interrupt is not None and interrupt.is_set():
                return "interrupted"
            if end is not None and time.monotonic() >= end:
                return "timeout"
            q.awaitTermination(poll_s)
    finally:
        q.stop()


def pipeline(spark: SparkSession, log_path: str, work_dir: str, handler: Handler, policy: RetryPolicy, base: DataFrame,
             max_files_per_trigger: int = 1, timeout_s: float | None = None, interrupt: Event | None = None,
             schema: str = RECORD_SCHEMA, bucket_size: int = DEFAULT_BUCKET_SIZE) -> DataFrame:
    """T4: records -> handler with retry timers -> attempts table -> streaming frontier -> commits.

    ``handler`` is a user handler (``operators.handler``); its retries wait on timers
    (``streaming.handler``).  The first query runs until every record of the log has
    had its last try, the second folds what succeeded into commits.  Returns the
    commit table as the W1 timeline; a run that does not catch up raises, and another
    call with the same ``work_dir`` goes on where it stopped.
    """
    attempts_path, commits_path = f"{work_dir}/attempts", f"{work_dir}/commits"
    records = read_log_stream(spark, log_path, schema, max_files_per_trigger)
    expected = spark.read.schema(schema).parquet(log_path).count()
    known = _table(spark, attempts_path, ATTEMPT_SCHEMA)
    before = known.where(~F.col("retry")).count() if known is not None else 0
    if before < expected:
        tries = finished(streaming_attempts(records, handler, policy))
        status = run_until(file_sink(tries, attempts_path, f"{work_dir}/ckpt-handle"), expected, before, timeout_s, interrupt)
        if status != "caught_up":
            raise TimeoutError(f"handler stream did not catch up: {status}")
    done = (spark.readStream.schema(ATTEMPT_SCHEMA).option("maxFilesPerTrigger", _done_files(spark, attempts_path)).parquet(attempts_path)
            .where("ok").select("partition", "offset", F.col("end_ms").alias("done_ms")))
    adv = streaming_frontier(done, base, bucket_size)
    status = run_available(commit_sink(adv, commits_path, f"{work_dir}/ckpt-frontier"), timeout_s)
    if status != "caught_up":
        raise TimeoutError("frontier stream did not catch up")
    return read_commits(spark, commits_path)


def _done_files(spark: SparkSession, attempts_path: str) -> int:
    """Attempts files that hold about ``DONE_ROWS`` rows, ``DONE_FILES`` at least."""
    attempts = _table(spark, attempts_path, ATTEMPT_SCHEMA)
    if attempts is None:  # an empty log
        return DONE_FILES
    rows, files = attempts.agg(F.count("*"), F.count_distinct("_metadata.file_path")).first()
    return max(DONE_FILES, files * DONE_ROWS // max(1, rows))


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    return spark.read.schema(schema).parquet(path) if _exists(spark, path) else None


def read_commits(spark: SparkSession, path: str) -> DataFrame:
    """The commit table folded into the W1 timeline (empty if no batch wrote, so
    that there is no folder; any other failure to read is an error)."""
    if _exists(spark, path):
        return final_timeline(spark.read.schema(OUTPUT_SCHEMA).parquet(path))
    else:
        return spark.createDataFrame([], OUTPUT_SCHEMA)
