"""Record sources: key assignment, offset assignment, synthetic and table-backed.

Canonical record schema::

    records(partition INT, offset BIGINT, key STRING, value STRING, fetched_ms BIGINT)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import key_partition
from ..functions.time import epoch_ms
from ..operators.prefix import row_index
from ..params import DEFAULT_BUCKET_SIZE, DEFAULT_PARTITIONS, check_positive


def assign_partitions(df: DataFrame, key: str = "key", partitions: int = DEFAULT_PARTITIONS,
                      out: str = "partition") -> DataFrame:
    """Log partition of every row by its key (FNV-1a hash balancer)."""
    return df.withColumn(out, key_partition(key, partitions))


def assign_offsets(df: DataFrame, seq: str, partition: str = "partition",
                   bucket_size: int = DEFAULT_BUCKET_SIZE, out: str = "offset",
                   ties: list[str] | None = None) -> DataFrame:
    """Per-partition offsets 0, 1, 2... in ``seq`` (write) order.

    ``seq`` must be a BIGINT that orders writes; the bucket is ``seq div B``
    so no task holds more than one bucket of one partition.  ``ties``:
    further order columns for rows with equal ``seq``.
    """
    check_positive("bucket_size", bucket_size)
    bucket = F.floor(F.col(seq) / F.lit(bucket_size))
    return row_index(df, [partition], [seq, *(ties or [])], bucket, out, start=0)


def synthetic_records(spark: SparkSession, n: int, partitions: int = DEFAULT_PARTITIONS,
                      bucket_size: int = DEFAULT_BUCKET_SIZE) -> DataFrame:
    """``key-i`` / ``message-i`` records for i in 0..n-1, written in i order."""
    check_positive("n", n)
    base = spark.range(n).select(
        F.col("id").alias("seq"),
        F.format_string("key-%d", F.col("id")).alias("key"),
        F.format_string("message-%d", F.col("id")).alias("value"),
        F.col("id").alias("fetched_ms"),
    )
    keyed = assign_partitions(base, "key", partitions)
    return assign_offsets(keyed, "seq", bucket_size=bucket_size).select(
        "partition", "offset", "key", "value", "fetched_ms")


def records_from_events(events: DataFrame, partitions: int = DEFAULT_PARTITIONS,
                        bucket_size: int = DEFAULT_BUCKET_SIZE) -> DataFrame:
    """Records of a topic fed from the ``events`` table, one record per event.

    key ``key-<user_id>``, value ``message-<event_id>: <event_type>``,
    ``fetched_ms`` = event time, write order = ``event_id``.  Keeps
    ``event_type`` and the ``k`` property for the handler model.
    """
    base = events.select(
        F.col("event_id").alias("seq"),
        F.concat(F.lit("key-"), F.col("user_id").cast("string")).alias("key"),
        F.concat(F.lit("message-"), F.col("event_id").cast("string"), F.lit(": "),
                 F.col("event_type")).alias("value"),
        epoch_ms(events, "ts").alias("fetched_ms"),
        F.col("event_type"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    keyed = assign_partitions(base, "key", partitions)
    return assign_offsets(keyed, "seq", bucket_size=bucket_size).select(
        "partition", "offset", "key", "value", "fetched_ms", "seq", "event_type", "k")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def records_from_table(df: DataFrame, key, value, seq, ts: str, partitions: int = DEFAULT_PARTITIONS,
                       bucket_size: int = DEFAULT_BUCKET_SIZE, keep: dict | None = None) -> DataFrame:
    """Records of a topic fed from any table: ``key``/``value``/``seq`` are
    columns or expressions, ``ts`` a timestamp column (fetch time).  ``keep``:
    extra output columns (name -> column) carried for a handler model."""
    extra = [c.alias(n) for n, c in (keep or {}).items()]
    base = df.select(F.col(seq).alias("seq") if isinstance(seq, str) else seq.alias("seq"),
                     (F.col(key) if isinstance(key, str) else key).alias("key"),
                     (F.col(value) if isinstance(value, str) else value).alias("value"),
                     epoch_ms(df, ts).alias("fetched_ms"), *extra)
    keyed = assign_partitions(base, "key", partitions)
    # rows with equal seq are ordered by every other input column, so even
    # exact duplicates get offsets that do not change any derived value
    ties = ["fetched_ms", *(keep or {}).keys(), "value"]
    return assign_offsets(keyed, "seq", bucket_size=bucket_size, ties=ties).select(
        "partition", "offset", "key", "value", "fetched_ms", "seq", *(keep or {}).keys())
