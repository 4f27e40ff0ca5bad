"""Text run logs as (scenario, line_idx, line) rows with exact line order.

Two readers with the same result:

* ``read_logs_whole`` - one row per file (``wholetext``), split and
  ``posexplode``d; simple, but a file must fit in one task's memory.
* ``read_logs_lines`` - line mode for files of any size.  Each split keeps
  its lines in order; per (file, split) line counts are prefix-summed
  (one small row per split) and added to the position inside the split.  Files of
  one scenario follow each other by the first number in their names, so part file
  100000 comes after 99999.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


FILE_NAME = r"([^/]+?)(\.[^./]*)?$"   # scenario = file name without extension
PARTITION_DIR = r"scenario=([^/]+)/"  # scenario = folder written by partitionBy


def _scenario_of(path_col, pattern: str):
    return F.regexp_extract(path_col, pattern, 1)


def read_logs_whole(spark: SparkSession, path: str, scenario_pattern: str = FILE_NAME) -> DataFrame:
    df = spark.read.text(path, wholetext=True).select(
        _scenario_of(F.col("_metadata.file_path"), scenario_pattern).alias("scenario"), "value")
    body = F.regexp_replace("value", r"\n$", "")
    return df.select("scenario", F.posexplode(F.split(body, "\n")).alias("line_idx", "line")).select(
        "scenario", F.col("line_idx").cast("bigint").alias("line_idx"), "line")


def read_logs_lines(spark: SparkSession, path: str, scenario_pattern: str = FILE_NAME) -> DataFrame:
    raw = spark.read.text(path).select(
        _scenario_of(F.col("_metadata.file_path"), scenario_pattern).alias("scenario"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        F.col("value").alias("line"))
    # one scenario may span several files (by name and number), each file
    # several blocks: prefix-sum the per-(file, block) counts, one small row each
    counts = raw.groupBy("scenario", "file", "block").agg(F.count(F.lit(1)).alias("n"))
    name = F.regexp_extract("file", r"([^/]*)$", 1)
    number = F.expr(r"try_cast(regexp_extract(file, '/[^/0-9]*([0-9]{1,38})[^/]*$', 1) AS DECIMAL(38,0))")
    order = [F.regexp_extract(name, r"^([^0-9]*)", 1), number, "file", "block"]
    w = Window.partitionBy("scenario").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("scenario", "file", "block", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("start"))
    wi = Window.partitionBy("scenario", "file", "block").orderBy("pos")
    return (raw.join(starts, ["scenario", "file", "block"])
            .select("scenario", (F.col("start") + F.row_number().over(wi) - 1).cast("bigint").alias("line_idx"),
                    "line"))
