"""Streaming frontier equals the batch frontier for any arrival order."""

import os
import random
import shutil
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import frontier as fr
from tidemark.streaming import pipeline as sp
from tidemark.streaming.frontier import _NOT_DONE, head_steps, streaming_frontier


@pytest.mark.parametrize("bucket", [4, 4096])
def test_stream_equals_batch_random_arrival(spark, bucket):
    rnd = random.Random(7)
    rows, bases = [], []
    for p in range(5):
        base = rnd.choice([-1, 10])
        bases.append((p, base))
        offs = [o for o in range(base + 1, base + 60) if rnd.random() > 0.03]
        for o in offs:
            if rnd.random() > 0.05:
                rows.append((p, o, rnd.randint(1, 100_000)))
    # redeliveries: same offset, later time, arriving in another batch
    rows += [(p, o, t + 5) for p, o, t in rnd.sample(rows, 15)]
    rnd.shuffle(rows)
    d = tempfile.mkdtemp(prefix="tidemark-stream-", dir="/tmp")
    comp = spark.createDataFrame(rows, "partition int, offset bigint, done_ms bigint")
    chunk = len(rows) // 6 + 1
    for i in range(6):  # six files = six micro-batches in arrival order
        part = rows[i * chunk:(i + 1) * chunk]
        if part:
            spark.createDataFrame(part, "partition int, offset bigint, done_ms bigint") \
                .coalesce(1).write.mode("append").parquet(f"{d}/in")
    base = spark.createDataFrame(bases, "partition int, base bigint")
    stream = (spark.readStream.schema("partition int, offset bigint, done_ms bigint")
              .option("maxFilesPerTrigger", 1).parquet(f"{d}/in"))
    status = sp.run_available(sp.commit_sink(streaming_frontier(stream, base, bucket), f"{d}/commits", f"{d}/ckpt"), 600)
    assert status == "caught_up"
    got = sorted(tuple(r) for r in sp.read_commits(spark, f"{d}/commits")
                 .select("partition", "commit_ms", "committed_through", "released").collect())
    first = comp.groupBy("partition", "offset").agg(F.min("done_ms").alias("done_ms"))
    exp = sorted(tuple(r) for r in fr.frontier_timeline(first, base, 8)
                 .select("partition", "commit_ms", "committed_through", "released").collect())
    assert got == exp and len(exp) > 0
    assert len([f for f in os.listdir(f"{d}/commits/_spark_metadata") if f.isdigit()]) > 1  # batches


def test_stream_stall_then_release(spark):
    """A gap that stays open for several batches, then closes in the last one."""
    d = tempfile.mkdtemp(prefix="tidemark-stall-", dir="/tmp")
    batches = [[(0, o, 100 + o) for o in range(1, 40)],            # offset 0 missing: stall
               [(0, o, 50 + o) for o in range(40, 80)] + [(0, 3, 1)],  # redelivery of a waiting one
               [(0, 0, 5000), (0, 81, 7)]]                          # gap closes; 80 still missing
    for rows in batches:
        spark.createDataFrame(rows, "partition int, offset bigint, done_ms bigint") \
            .coalesce(1).write.mode("append").parquet(f"{d}/in")
    base = spark.createDataFrame([(0, -1)], "partition int, base bigint")
    stream = (spark.readStream.schema("partition int, offset bigint, done_ms bigint")
              .option("maxFilesPerTrigger", 1).parquet(f"{d}/in"))
    assert sp.run_available(sp.commit_sink(streaming_frontier(stream, base, 8), f"{d}/commits", f"{d}/ckpt"), 600) == "caught_up"
    got = [tuple(r) for r in sp.read_commits(spark, f"{d}/commits")
           .select("commit_ms", "committed_through", "released").collect()]
    assert got == [(5000, 79, 80)]


def test_head_steps():
    run, last, tops = head_steps(np.array([5, 3, 9, 9, _NOT_DONE, 1]), 4)
    assert (run, last.tolist(), tops.tolist()) == (4, [1, 3], [5, 9])
    assert head_steps(np.array([_NOT_DONE, 1]), 4)[0] == 0
    run, last, tops = head_steps(np.array([1, 2]), 7)
    assert (run, last.tolist(), tops.tolist()) == (2, [1], [7])


def test_rows_of_a_batch_that_is_not_committed_are_invisible(spark):
    """Files without an entry in the manifest, as a killed batch leaves them, are read by nobody."""
    d = tempfile.mkdtemp(prefix="tidemark-sink-", dir="/tmp")
    schema = "partition int, commit_ms bigint, committed_through bigint, released bigint"
    for i in range(3):
        spark.createDataFrame([(0, i, i, 1)], schema).coalesce(1).write.mode("append").parquet(f"{d}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/in")
    assert sp.run_available(sp.commit_sink(stream, f"{d}/commits", f"{d}/ckpt"), 300) == "caught_up"
    part = next(f for f in os.listdir(f"{d}/commits") if f.endswith(".parquet"))
    shutil.copy(f"{d}/commits/{part}", f"{d}/commits/part-00000-killed.parquet")
    assert sp.read_commits(spark, f"{d}/commits").groupBy().sum("released").first()[0] == 3
    # the next run adds what is new, once
    spark.createDataFrame([(0, 9, 9, 1)], schema).coalesce(1).write.mode("append").parquet(f"{d}/in")
    assert sp.run_available(sp.commit_sink(stream, f"{d}/commits", f"{d}/ckpt"), 300) == "caught_up"
    assert sp.run_available(sp.commit_sink(stream, f"{d}/commits", f"{d}/ckpt"), 300) == "caught_up"
    assert sp.read_commits(spark, f"{d}/commits").groupBy().sum("released").first()[0] == 4
    assert sp.read_commits(spark, f"{d}/none").count() == 0
