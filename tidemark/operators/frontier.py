"""Commit frontier: baseline, contiguous frontier, commit timeline, gap blocking.

The frontier of a log partition is the highest offset f such that every
offset base+1..f is done; only it may be committed.  Batch forms:

* ``contiguous_frontier`` (A2) - one aggregation into offset bitmaps; the first
  bitmap that is not full tells the frontier.
* ``commit_times`` (W1 core) - the commit time of offset o is the running
  maximum of done time over base+1..o (a never-done row or a hole is +inf).
  Two-level running max, see ``prefix.py``.

Tables keyed by log partition (one row per partition: baselines, frontiers)
are broadcast: their size is bounded by the partition count of the topic,
not by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..params import DEFAULT_BUCKET_SIZE, check_positive
from .prefix import row_index, running_aggs

INF = (1 << 63) - 1


def _bucket(col: str, size: int) -> Column:
    return F.floor(F.col(col) / F.lit(size)).cast("bigint")


def baseline(records: DataFrame, fetch_order: str | None = None) -> DataFrame:
    """A1: ``base`` = first fetched offset - 1 per partition."""
    first = F.min("offset") if fetch_order is None else F.min_by("offset", fetch_order)
    return records.groupBy("partition").agg((first - 1).cast("bigint").alias("base"))


#: Offsets of one bitmap (Spark's bitmaps hold 4 KB).
BITMAP_BITS = 32768


def _leading_ones(bitmap: Column, start: Column) -> Column:
    """How many bits are set in a row from bit ``start`` on (the bits before it count as set)."""
    text = F.hex(bitmap)  # two digits a byte, the lowest bit of a byte is its first
    whole = F.greatest(F.floor(start / 8).cast("int"), F.lit(0))  # bytes that lie wholly before the start
    rest = F.substr(text, whole * 2 + 1)
    first = F.conv(F.substr(rest, F.lit(1), F.lit(2)), 16, 10).cast("int").bitwiseOR(
        F.call_function("shiftleft", F.lit(1), (start % 8).cast("int")) - 1)
    full = F.when(first == 255, F.length(F.regexp_extract(F.substr(rest, F.lit(3)), "^(?:FF)*", 0)) / 2 + 1).otherwise(0).cast("int")
    byte = F.when(full == 0, first).otherwise(F.conv(F.substr(rest, full * 2 + 1, F.lit(2)), 16, 10).cast("int"))
    byte = F.coalesce(byte, F.lit(0))  # past the last byte
    ones = F.bit_count(byte.bitwiseXOR(byte + 1)) - 1
    return ((whole + full) * 8 + ones - start).cast("bigint")


def contiguous_frontier(good: DataFrame, base: DataFrame | None = None, done: Column | None = None) -> DataFrame:
    """A2: highest f with every offset in base+1..f present in ``good``.

    ``good``: (partition, offset), duplicates allowed; with ``done``, only rows that
    satisfy it are present, and the others count for the base alone.  ``base``:
    (partition, base), one row per partition; without it the base is the lowest
    offset of any row less one.  Partitions with no good offset keep base.  One
    aggregation: offsets become one bitmap per partition and ``BITMAP_BITS`` offsets
    (map-side partial bitmaps, duplicates fall together); the first bitmap that is not
    full tells the frontier by its leading ones.  Returns (partition, base, frontier).
    """
    size = F.lit(BITMAP_BITS)
    present = F.lit(True) if done is None else done
    bucket = F.floor(F.col("offset") / size).cast("bigint")
    rows = good.select("partition", "offset", present.alias("_in"))
    if base is not None:
        base = base.select("partition", "base")
        rows = rows.join(F.broadcast(base), "partition").where(F.col("offset") > F.col("base"))
    bit = F.when(F.col("_in"), F.col("offset") - bucket * size)
    maps = rows.groupBy("partition", bucket.alias("bucket")).agg(
        F.bitmap_construct_agg(bit).alias("map"), F.min("offset").alias("low"), *([] if base is None else [F.min("base").alias("base")]))
    begin = F.col("bucket") * size
    # a bucket's bitmap is read once, from its begin and from its lowest offset or the base: few numbers go on
    lead = F.greatest((F.col("low") if base is None else F.col("base") + 1) - begin, F.lit(0))
    tiny = maps.select("partition", "bucket", F.bitmap_count("map").alias("n"), _leading_ones(F.col("map"), F.lit(0)).alias("ones"),
                       _leading_ones(F.col("map"), lead).alias("ones_on"), *(["low"] if base is None else ["base"]))
    every, by = Window.partitionBy("partition"), Window.partitionBy("partition").orderBy("bucket")
    if base is None:
        tiny = tiny.withColumn("base", (F.min("low").over(every) - 1).cast("bigint"))
    first = F.floor((F.col("base") + 1) / size).cast("bigint")
    tiny = tiny.withColumn("rn", F.row_number().over(by)).withColumn("placed", F.col("bucket") - first + 1 == F.col("rn"))
    whole = F.col("n") == size - F.greatest(F.col("base") + 1 - begin, F.lit(0))
    broken = F.min(F.when(~(F.col("placed") & whole), F.col("rn"))).over(every)
    tiny = tiny.withColumn("at", F.coalesce(broken, F.max("rn").over(every) + 1))  # place of the first that is not whole
    inside = F.greatest(F.col("base") + 1, begin) - 1 + F.when(F.col("rn") == 1, F.col("ones_on")).otherwise(F.col("ones"))
    found = tiny.groupBy("partition").agg(
        F.min("base").alias("base"),
        F.coalesce(F.max(F.when((F.col("rn") == F.col("at")) & F.col("placed"), inside)),
                   F.max(F.greatest(F.col("base"), (first + F.col("at") - 1) * size - 1))).cast("bigint").alias("frontier"))
    if base is None:
        return found
    return base.join(found.select("partition", "frontier"), "partition", "left").select(
        "partition", "base", F.coalesce("frontier", "base").alias("frontier"))


def commit_times(outcome_rows: DataFrame, base: DataFrame | None = None,
                 bucket_size: int = DEFAULT_BUCKET_SIZE, dense: bool = False) -> DataFrame:
    """W1 core: per tracked offset above base, ``commit_ms`` (NULL = never).

    ``outcome_rows``: (partition, offset, done_ms [, ...]), one row per
    (partition, offset) (deduplicate redeliveries first); ``done_ms`` NULL
    when not done.  One two-level pass computes both the running max of done
    time and the running row count; an offset whose position differs from
    ``offset - base`` sits behind a hole, which stalls the frontier for good.
    With ``dense`` (a compacted log) only the offsets that exist count: a hole
    stalls nothing.
    """
    rows = outcome_rows
    if base is not None:
        rows = (rows.join(F.broadcast(base.select("partition", "base")), "partition")
                .where(F.col("offset") > F.col("base")))
    eff = F.when(F.col("done_ms").isNull(), F.lit(INF)).otherwise(F.col("done_ms"))
    rows = rows.withColumn("_eff", eff.cast("bigint")).withColumn("_one", F.lit(1).cast("bigint"))
    specs = [("_eff", "_commit", "max"), *([] if dense else [("_one", "_pos", "sum")])]
    # without a base the lowest offset tells it: the running minimum of the offset
    res = running_aggs(rows, ["partition"], ["offset"], _bucket("offset", bucket_size),
                       specs if base is not None else [*specs, ("offset", "_low", "min")])
    if base is None:
        res = res.withColumn("base", F.col("_low") - 1).drop("_low")
    ok = F.col("_commit") < F.lit(INF)
    if not dense:
        ok = ok & (F.col("offset") - F.col("base") == F.col("_pos"))
    return (res.withColumn("commit_ms", F.when(ok, F.col("_commit")))
            .drop("_eff", "_one", "_commit", "_pos"))


def frontier_timeline(outcome_rows: DataFrame, base: DataFrame | None = None,
                      bucket_size: int = DEFAULT_BUCKET_SIZE, dense: bool = False) -> DataFrame:
    """One row per frontier advance = one coalesced commit (``dense``: see ``commit_times``).

    (partition, commit_ms, committed_through, released)
    """
    ct = commit_times(outcome_rows, base, bucket_size, dense)
    return (ct.where(F.col("commit_ms").isNotNull())
            .groupBy("partition", "commit_ms")
            .agg(F.max("offset").alias("committed_through"),
                 F.count(F.lit(1)).alias("released")))


def blocked_by_gap(outcome_rows: DataFrame, base: DataFrame | None = None,
                   bucket_size: int = DEFAULT_BUCKET_SIZE) -> DataFrame:
    """Done records that waited for a lower offset, ranked by blocker.

    One row per blocking offset: the offset whose completion (or whose
    absence, ``commit_ms`` NULL) held back the done records above it.
    (partition, blocker_offset, commit_ms, blocked, max_blocked_ms, total_blocked_ms)
    """
    ct = commit_times(outcome_rows, base, bucket_size)
    done = F.col("done_ms").isNotNull()
    waited = done & (F.col("commit_ms").isNull() | (F.col("done_ms") < F.col("commit_ms")))
    wait_ms = F.when(done, F.col("commit_ms") - F.col("done_ms"))
    grouped = (ct.groupBy("partition", "commit_ms")
               .agg(F.min("base").alias("base"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"),
                    F.count_if(waited).alias("blocked"),
                    F.max(wait_ms).alias("max_blocked_ms"),
                    F.sum(wait_ms).cast("bigint").alias("total_blocked_ms")))
    # what is still blocked waits for the offset after the last released one,
    # which may be absent
    last = grouped.where(F.col("commit_ms").isNotNull()).groupBy("partition").agg(F.max("last_offset").alias("_last"))
    grouped = grouped.where(F.col("blocked") > 0).join(last, "partition", "left")
    blocker = F.when(F.col("commit_ms").isNull(), F.coalesce("_last", "base") + 1).otherwise(F.col("first_offset"))
    return grouped.select("partition", blocker.cast("bigint").alias("blocker_offset"),
                          "commit_ms", "blocked", "max_blocked_ms", "total_blocked_ms")


def frontier_snapshot(outcome_rows: DataFrame, base: DataFrame | None = None, dense: bool = False) -> DataFrame:
    """A2 on outcomes (one row per (partition, offset)): (partition, base, last_committed).

    With ``dense`` the frontier is the last existing offset before the first that is not done."""
    done = F.col("done_ms").isNotNull()
    if not dense:
        fr = contiguous_frontier(outcome_rows, base, done)
        return fr.select("partition", "base", F.col("frontier").alias("last_committed"))
    rows = outcome_rows.select("partition", "offset", done.alias("_done"))
    low = base if base is not None else baseline(rows)
    rows = rows.join(F.broadcast(low.select("partition", "base")), "partition").where(F.col("offset") > F.col("base"))
    open_ = rows.where(~F.col("_done")).groupBy("partition").agg(F.min("offset").alias("_open"))
    through = (rows.join(F.broadcast(open_), "partition", "left").where(F.col("_open").isNull() | (F.col("offset") < F.col("_open")))
               .groupBy("partition").agg(F.max("offset").alias("_through")))
    return low.select("partition", "base").join(through, "partition", "left").select(
        "partition", "base", F.coalesce("_through", "base").alias("last_committed"))


def pending_count(outcome_rows: DataFrame, snapshot: DataFrame) -> DataFrame:
    """A3: tracked offsets beyond the frontier, split in flight / completed."""
    above = (outcome_rows.join(F.broadcast(snapshot.select("partition", "last_committed")), "partition")
             .where(F.col("offset") > F.col("last_committed")))
    done = F.col("done_ms").isNotNull()
    counts = above.groupBy("partition").agg(
        F.count_if(~done).alias("in_flight"), F.count_if(done).alias("completed"))
    return (snapshot.select("partition", "last_committed").join(counts, "partition", "left")
            .select("partition", "last_committed",
                    F.coalesce("in_flight", F.lit(0)).cast("bigint").alias("in_flight"),
                    F.coalesce("completed", F.lit(0)).cast("bigint").alias("completed"),
                    (F.coalesce("in_flight", F.lit(0)) + F.coalesce("completed", F.lit(0)))
                    .cast("bigint").alias("pending")))


def tracker_snapshot(outcome_rows: DataFrame, snapshot: DataFrame,
                     bucket_size: int = DEFAULT_BUCKET_SIZE) -> DataFrame:
    """A4 + O1: every tracked offset beyond the frontier, one row each.

    (partition, last_committed, pending, in_flight, completed, set, rank,
    offset): the counts of the partition, and the offset's set and its rank in
    it, ascending from 1.  A partition with nothing pending has one row with no
    set, rank and offset.
    """
    front = snapshot.select("partition", "last_committed")
    above = (outcome_rows.join(F.broadcast(front), "partition")
             .where(F.col("offset") > F.col("last_committed"))
             .select("partition", "offset",
                     F.when(F.col("done_ms").isNull(), F.lit("in_flight")).otherwise(F.lit("completed"))
                     .alias("set")))
    ranked = row_index(above, ["partition", "set"], ["offset"], _bucket("offset", bucket_size), "rank", start=1)
    # the counts (one row per log partition) go to the listing, which stays where it is
    counts = pending_count(outcome_rows, snapshot)
    columns = ["partition", "last_committed", "pending", "in_flight", "completed", "set", "rank", "offset"]
    listed = ranked.join(F.broadcast(counts), "partition").select(*columns)
    nothing = counts.where(F.col("pending") == 0).select(*[F.col(c) if c in counts.columns else F.lit(None).cast(listed.schema[c].dataType).alias(c)
                                                           for c in columns])
    return listed.unionByName(nothing)


def final_commit(commits: DataFrame) -> DataFrame:
    """A10: last successful commit per partition."""
    ok = F.col("ok") if "ok" in commits.columns else F.lit(True)
    return (commits.where(ok).groupBy("partition")
            .agg(F.max("committed_through").alias("committed_through")))


def commit_record_lookup(commits: DataFrame, records: DataFrame) -> DataFrame:
    """The record each commit names (offset = committed_through)."""
    r = records.select("partition", F.col("offset").alias("committed_through"), "key", "value")
    return commits.join(r, ["partition", "committed_through"], "inner")


def unknown_commits(commits: DataFrame, records: DataFrame) -> DataFrame:
    """Commits of offsets that were never tracked (an error)."""
    r = records.select("partition", F.col("offset").alias("committed_through"))
    return commits.join(r, ["partition", "committed_through"], "left_anti")


def untracked_completions(completions: DataFrame, records: DataFrame, base: DataFrame) -> DataFrame:
    """Completions above the baseline of offsets never marked in flight, also
    of partitions that have no record and so no baseline."""
    above = (completions.join(F.broadcast(base.select("partition", "base")), "partition", "left")
             .where(F.col("base").isNull() | (F.col("offset") > F.col("base"))).drop("base"))
    return above.join(records.select("partition", "offset"), ["partition", "offset"], "left_anti")


def above_committed(rows: DataFrame, committed: DataFrame, through: str = "committed_through") -> DataFrame:
    """Keep rows strictly beyond the partition's highest committed offset."""
    c = committed.groupBy("partition").agg(F.max(through).alias("_through"))
    return (rows.join(F.broadcast(c), "partition", "left")
            .where(F.col("_through").isNull() | (F.col("offset") > F.col("_through")))
            .drop("_through"))


def completion_classes(completions: DataFrame, records: DataFrame, base: DataFrame | None = None,
                       bucket_size: int = DEFAULT_BUCKET_SIZE) -> DataFrame:
    """Classify every completion event like a single tracker would that sees
    fetches, completions and commits in one time order.

    ``completions``: (partition, offset, done_ms), several per offset allowed.
    ``records``: (partition, offset) and, if known, ``fetched_ms``; a fetch comes
    before a completion of the same millisecond.  Of completions of one offset in the
    same millisecond one is the first.
    Classes: ``ok`` (first completion), ``noop_committed`` (at/below the
    baseline, or after the offset's commit), ``error_not_in_flight`` (never
    fetched, or not yet), ``error_double`` (again before the offset was committed).
    """
    if base is None:
        base = baseline(records)
    at = F.min("fetched_ms") if "fetched_ms" in records.columns else F.lit(None).cast("bigint")
    tracked = records.groupBy("partition", "offset").agg(at.alias("_fetched"))
    early = F.coalesce(F.col("done_ms") < F.col("_fetched"), F.lit(False))
    firsts = (tracked.join(completions.select("partition", "offset", "done_ms"), ["partition", "offset"], "left")
              .groupBy("partition", "offset").agg(F.min(F.when(~early, F.col("done_ms"))).alias("done_ms"), F.first("_fetched").alias("_fetched")))
    ct = commit_times(firsts, base, bucket_size).select("partition", "offset", "commit_ms", "_fetched")
    # ct has one row per tracked offset above the baseline, so it also tells
    # whether a completion's offset was ever fetched
    ev = (completions.join(F.broadcast(base.select("partition", "base")), "partition", "left")
          .join(ct.withColumn("_tracked", F.lit(True)), ["partition", "offset"], "left").withColumn("_early", early))
    once = Window.partitionBy("partition", "offset", "_early").orderBy("done_ms")
    ev = ev.withColumn("_nth", F.row_number().over(once))
    after = (F.col("done_ms") > F.col("commit_ms")) | ((F.col("_nth") > 1) & (F.col("done_ms") == F.col("commit_ms")))
    cls = (F.when(F.col("offset") <= F.col("base"), F.lit("noop_committed"))
           .when(F.col("_tracked").isNull() | F.col("_early"), F.lit("error_not_in_flight"))
           .when(F.col("_nth") == 1, F.lit("ok"))
           .when(F.col("commit_ms").isNotNull() & after, F.lit("noop_committed"))
           .otherwise(F.lit("error_double")))
    return ev.select("partition", "offset", "done_ms", cls.alias("class"))


def commit_cache(fetches: DataFrame, committed: DataFrame) -> DataFrame:
    """Cached messages left after commits evicted everything <= frontier.

    A re-fetched offset keeps one entry, the latest fetch wins.
    (partition, cached, cached_bytes, lowest_cached)
    """
    latest = (fetches.groupBy("partition", "offset")
              .agg(F.max_by(F.struct("key", "value"), "fetched_ms").alias("m")))
    left = above_committed(latest, committed)
    size = F.coalesce(F.octet_length("m.key"), F.lit(0)) + F.coalesce(F.octet_length("m.value"), F.lit(0))
    return left.groupBy("partition").agg(
        F.count(F.lit(1)).alias("cached"),
        F.sum(size).cast("bigint").alias("cached_bytes"),
        F.min("offset").alias("lowest_cached"))


def redelivery_dedup(fetches: DataFrame, committed: DataFrame) -> DataFrame:
    """T2 (batch): drop redelivered and already-committed offsets.

    One row per (partition, offset) beyond the committed offset, the latest
    fetch kept.
    """
    fresh = above_committed(fetches, committed)
    return (fresh.groupBy("partition", "offset")
            .agg(F.max("fetched_ms").alias("fetched_ms"),
                 F.count(F.lit(1)).alias("deliveries")))
