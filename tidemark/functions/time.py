"""Time columns as BIGINT milliseconds, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

_NTZ_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_ms(df: DataFrame, name: str) -> Column:
    """Epoch milliseconds of timestamp column ``name`` of ``df``.

    TIMESTAMP_NTZ is read as UTC wall time; TIMESTAMP is an instant already.
    """
    dtype = df.schema[name].dataType
    if isinstance(dtype, TimestampNTZType):
        return F.expr(f"timestampdiff(MILLISECOND, {_NTZ_EPOCH}, `{name}`)").cast("bigint")
    return F.unix_millis(F.col(name)).cast("bigint")


def utc_wall_time(ms) -> Column:
    """TIMESTAMP_NTZ holding the UTC wall time of epoch milliseconds."""
    ms = F.col(ms) if isinstance(ms, str) else ms
    return F.timestamp_add("MILLISECOND", ms, F.expr(_NTZ_EPOCH))


def log_prefix(ms) -> Column:
    """``yyyy/MM/dd HH:mm:ss`` log-line clock of epoch milliseconds (UTC)."""
    return F.date_format(utc_wall_time(ms), "yyyy/MM/dd HH:mm:ss")


def utc_date(ms) -> Column:
    """``yyyy-MM-dd`` UTC day of epoch milliseconds."""
    return F.date_format(utc_wall_time(ms), "yyyy-MM-dd")
