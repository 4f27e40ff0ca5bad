"""Record sources: offset assignment (two-level) and the synthetic source."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.prefix import row_index
from tidemark.sources.records import assign_offsets, records_from_events, synthetic_records


def test_assign_offsets_matches_row_number(spark):
    rows = [(p, seq) for seq in range(0, 700, 3) for p in ((seq * 7) % 4,)]
    df = spark.createDataFrame(rows, "partition int, seq bigint")
    exp = {(r.partition, r.seq): r.o for r in df.select(
        "partition", "seq", (F.row_number().over(Window.partitionBy("partition").orderBy("seq")) - 1).alias("o")
    ).collect()}
    for b in (1, 5, 64, 4096):
        got = {(r.partition, r.seq): r.offset for r in assign_offsets(df, "seq", bucket_size=b).collect()}
        assert got == exp, b


def test_row_index_global_group(spark):
    df = spark.createDataFrame([(t,) for t in (5, 1, 9, 3, 7)], "t bigint")
    got = {r.t: r.i for r in row_index(df, [], ["t"], F.floor(F.col("t") / 4), "i", start=1).collect()}
    assert got == {1: 1, 3: 2, 5: 3, 7: 4, 9: 5}


def test_synthetic_records(spark):
    rows = synthetic_records(spark, 10, partitions=3, bucket_size=2).collect()
    by_key = {r.key: (r.partition, r.offset) for r in rows}
    assert [by_key[f"key-{i}"][0] for i in range(10)] == [0, 1, 2, 0, 2, 0, 1, 2, 1, 2]
    # offsets count up in write order inside each partition
    assert [by_key[k][1] for k in ("key-0", "key-3", "key-5")] == [0, 1, 2]
    assert [by_key[k][1] for k in ("key-2", "key-4", "key-7", "key-9")] == [0, 1, 2, 3]


def test_records_from_events_columns(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    r = records_from_events(ev, 3, 64)
    assert r.columns[:5] == ["partition", "offset", "key", "value", "fetched_ms"]
    counts = r.groupBy("partition").agg(F.count(F.lit(1)).alias("n"), F.max("offset").alias("mx")).collect()
    assert all(c.mx == c.n - 1 for c in counts)
    assert sum(c.n for c in counts) == ev.count()
