"""Key -> log-partition assignment as a JVM-side column expression.

The modelled producer uses a key-hash balancer: FNV-1a 32 over the key bytes,
read as a signed 32-bit integer, remainder by the partition count, absolute
value.  Spark's own ``hash`` is Murmur3 and gives different partitions, so
the hash is spelled out with higher-order functions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import check_positive

# FNV-1a 32-bit offset basis and prime.
FNV32_OFFSET_BASIS = 2166136261
FNV32_PRIME = 16777619
_MASK32 = 0xFFFFFFFF


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _fnv_fold(byte_values) -> Column:
    return F.aggregate(
        byte_values,
        F.lit(FNV32_OFFSET_BASIS).cast("bigint"),
        lambda acc, b: ((acc.bitwiseXOR(b)) * F.lit(FNV32_PRIME)).bitwiseAND(F.lit(_MASK32)),
    )


def fnv1a32(key) -> Column:
    """FNV-1a 32 of the UTF-8 bytes of ``key`` as an unsigned BIGINT.

    ASCII keys (one byte per character) read each byte with ``ascii``; other
    keys go through the hex of their UTF-8 encoding, two digits per byte.
    """
    key = _col(key)
    n_bytes = F.octet_length(key)
    positions = F.sequence(F.lit(1), n_bytes)
    ascii_bytes = F.transform(positions, lambda i: F.ascii(F.substr(key, i, F.lit(1))).cast("bigint"))
    raw = F.hex(F.encode(key, "UTF-8"))
    utf8_bytes = F.transform(
        positions, lambda i: F.conv(F.substr(raw, i * 2 - 1, F.lit(2)), 16, 10).cast("bigint"))
    return (F.when(key.isNull(), None)
            .when(n_bytes == 0, F.lit(FNV32_OFFSET_BASIS).cast("bigint"))
            .when(n_bytes == F.length(key), _fnv_fold(ascii_bytes))
            .otherwise(_fnv_fold(utf8_bytes)))


def key_partition(key, partitions: int) -> Column:
    """Log partition of ``key`` for ``partitions`` partitions (INT)."""
    check_positive("partitions", partitions)
    # signed 32-bit view of the hash without naming it twice (the fold is
    # interpreted code; a second mention would evaluate it again)
    signed = F.pmod(fnv1a32(key) + F.lit(1 << 31), F.lit(1 << 32)) - F.lit(1 << 31)
    return F.abs(signed % F.lit(int(partitions))).cast("int")
