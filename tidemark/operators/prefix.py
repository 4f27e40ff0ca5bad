"""Two-level ordered aggregation: running max / sum and first-k per group.

A log has few partitions, so ``Window.partitionBy("partition")`` would put a
third of all rows into one task.  Every ordered operator here splits the
order axis into buckets of bounded size instead:

1. one aggregate row per (group, bucket)            - partial aggregation;
2. a window over those small rows gives each bucket the total of all earlier
   buckets (the carry)                              - #rows / bucket_size rows;
3. the rows are shuffled by (group, bucket) once; the join with the carry and
   the in-bucket window both use that one distribution.

No task ever holds more than one bucket of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_AGG = {"max": F.max, "sum": F.sum, "min": F.min}

# Buckets per carry bucket for a third level.  None: the carry (one row per
# bucket) is prefix-summed in one window per group, fine up to ~10^7 buckets
# per group.  Set it (e.g. 4096) when a group holds more than ~10^10 rows so
# the carry itself is computed two-level.
CARRY_BUCKET_SIZE: int | None = None


def _combine(how: str, carry: Column, local: Column) -> Column:
    if how == "sum":
        return F.coalesce(carry, F.lit(0)) + F.coalesce(local, F.lit(0))
    if how == "max":
        return F.greatest(carry, local)
    return F.least(carry, local)


def running_aggs(df: DataFrame, groups: list[str], order: list[str], bucket: Column,
                 specs: list[tuple[str, str, str]], inclusive: bool = True, _tag: str = "_tm") -> DataFrame:
    """Several running aggregates in one two-level pass.

    ``specs``: (value column, output column, "max" | "sum" | "min").
    ``bucket`` must be non-decreasing in ``order`` inside a group (for example
    ``offset div B``).  ``inclusive`` includes the current row; otherwise only
    strictly earlier rows count (NULL / 0 when there are none).

    Plan: the rows are shuffled once, by (groups, bucket), for the in-bucket
    window.  Bucket totals come from a partial (map-side) aggregation of the
    same input, so only one row per bucket and task is shuffled for them;
    their prefix (the carry, one row per bucket) is joined back on the
    shuffle keys.
    """
    b = f"{_tag}_bucket"
    rows = df.withColumn(b, bucket)
    end = Window.currentRow if inclusive else -1
    wi = Window.partitionBy(*groups, b).orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
    local = rows.repartition(*groups, b).select(
        "*", *[_AGG[how](value).over(wi).alias(f"{_tag}_loc{i}") for i, (value, _, how) in enumerate(specs)])
    per_bucket = rows.groupBy(*groups, b).agg(
        *[_AGG[how](value).alias(f"{_tag}_bv{i}") for i, (value, _, how) in enumerate(specs)])
    if CARRY_BUCKET_SIZE and _tag == "_tm":
        cb = F.floor(F.col(b) / F.lit(int(CARRY_BUCKET_SIZE))).cast("bigint")
        carry = _three_level_carry(per_bucket, groups, b, cb, specs, _tag)
    else:
        wb = Window.partitionBy(*groups).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
        carry = per_bucket.select(*groups, b, *[_AGG[how](f"{_tag}_bv{i}").over(wb).alias(f"{_tag}_carry{i}")
                                                for i, (_, _, how) in enumerate(specs)])
    # every (group, bucket) has a carry row, so a left join equals an inner
    # one; it keeps Catalyst from inferring NOT NULL filters on the group
    # keys, which would evaluate an expensive key expression twice
    out = local.join(carry, on=[*groups, b], how="left")
    for i, (_, name, how) in enumerate(specs):
        res = _combine(how, F.col(f"{_tag}_carry{i}"), F.col(f"{_tag}_loc{i}"))
        if how == "sum":
            res = res.cast("bigint")
        out = out.withColumn(name, res)
    tmp = [b] + [f"{_tag}_{k}{i}" for i in range(len(specs)) for k in ("loc", "carry")]
    return out.drop(*tmp)


def _three_level_carry(per_bucket: DataFrame, groups: list[str], b: str, cb: Column,
                       specs: list[tuple[str, str, str]], tag: str) -> DataFrame:
    """Carry of every bucket (exclusive prefix over earlier buckets), itself
    computed with the bucketed pass over the per-bucket rows."""
    inner = [(f"{tag}_bv{i}", f"{tag}_carry{i}", how) for i, (_, _, how) in enumerate(specs)]
    res = running_aggs(per_bucket, groups, [b], cb, inner, inclusive=False, _tag=f"{tag}c")
    fix = []
    for i, (_, _, how) in enumerate(specs):
        c = F.col(f"{tag}_carry{i}")
        if how == "sum":  # an exclusive sum over nothing is NULL, not 0
            c = F.when(c == 0, None).otherwise(c)
        fix.append(c.alias(f"{tag}_carry{i}"))
    return res.select(*groups, b, *fix)


def running_agg(df: DataFrame, groups: list[str], order: list[str], bucket: Column,
                value: str, out: str, how: str = "max", inclusive: bool = True) -> DataFrame:
    """Add ``out`` = running ``how`` of ``value`` over ``order`` within ``groups``."""
    return running_aggs(df, groups, order, bucket, [(value, out, how)], inclusive)


def row_index(df: DataFrame, groups: list[str], order: list[str], bucket: Column,
              out: str, start: int = 0) -> DataFrame:
    """Dense position (``start``-based) of each row in ``order`` within ``groups``."""
    one = df.withColumn("_tm_one", F.lit(1).cast("bigint"))
    res = running_agg(one, groups, order, bucket, "_tm_one", "_tm_pos", how="sum")
    return res.withColumn(out, (F.col("_tm_pos") - F.lit(1 - start)).cast("bigint")).drop("_tm_one", "_tm_pos")


def first_k(df: DataFrame, groups: list[str], order: str, bucket: Column, k: int,
            out_rank: str = "rank_in_group") -> DataFrame:
    """Rows with the ``k`` smallest ``order`` values per group (ties by order).

    Bucket counts locate the at most ``k`` leading buckets that can hold the
    answer; only their rows are ranked.  Nothing is collected per group.
    """
    b = "_tm_bucket"
    rows = df.withColumn(b, bucket)
    counts = rows.groupBy(*groups, b).agg(F.count(F.lit(1)).alias("_tm_n"))
    wb = Window.partitionBy(*groups).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    lead = (counts.withColumn("_tm_before", F.coalesce(F.sum("_tm_n").over(wb), F.lit(0)))
            .where(F.col("_tm_before") < k).select(*groups, b))
    cand = rows.join(lead, on=[*groups, b], how="inner")
    w = Window.partitionBy(*groups).orderBy(order)
    return (cand.withColumn(out_rank, F.row_number().over(w))
            .where(F.col(out_rank) <= k).drop(b))
