"""Shared helpers: bounded Arrow batches, flat byte buffers, word and shingle hashes.

A batch of texts becomes one flat byte buffer (texts joined by a newline), so
numpy finds words, hashes and runs for all of them at once.  Null texts count
as empty.  Buffers are bounded: a group holds ``GROUP_BYTES`` of text, or one
longer text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..session import scratch_path, ship_package

GROUP_BYTES = 1 << 20
BATCH_ROWS = 1000
BATCH_BYTES = 4 << 20
BROADCAST_IDS = 500_000


def bounded_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch to a Python worker holds, in rows and bytes, and
    send the package to the workers."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def schema(fields: list[StructField], ddl: str) -> StructType:
    """The given fields and then those of the DDL text."""
    return StructType([*fields, *StructType.fromDDL(ddl).fields])


def field(df: DataFrame, source: str, name: str) -> StructField:
    """A nullable field ``name`` of the type of column ``source``."""
    return StructField(name, df.schema[source].dataType)


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back (cuts lineage)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_ids(df: DataFrame, ids: DataFrame, on: list[str], how: str = "left_semi") -> DataFrame:
    """``df`` joined with ``ids`` by the columns ``on``, which have no nulls.  Up to
    ``BROADCAST_IDS`` ids are sent to the tasks, so the rows stay where they are;
    more are joined by a shuffle."""
    few = ids.count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if few else ids, on, how)


def map_groups(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None],
               schema: StructType | str, text: str = "text",
               setup: Callable[[], None] | None = None) -> DataFrame:
    """Apply ``fn`` to record batches of at most ``GROUP_BYTES`` of ``text`` each."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if setup is not None:
            setup()
        for batch in batches:
            for part in slices(batch, text):
                out = fn(part)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts hold about ``GROUP_BYTES``."""
    n = batch.num_rows
    if not n:
        return
    sizes = np.array([len(b) for b in raw(batch.column(text))], dtype=np.int64)
    group = np.cumsum(sizes) // GROUP_BYTES
    at = 0
    for end in [*np.flatnonzero(np.diff(group)) + 1, n]:
        if end > at:
            yield batch.slice(at, end - at)
        at = int(end)


def raw(col: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text; a null text is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return [b or b"" for b in col.cast(pa.large_binary()).to_pylist()]


def flat(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one buffer, a newline after each; and where each begins
    (one more entry for the end)."""
    buf = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
    at = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=at[1:])
    return buf, at


# -- words -----------------------------------------------------------------------

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def byte_class(member: Callable[[int], bool]) -> np.ndarray:
    return np.array([member(b) for b in range(256)], dtype=bool)


def spans(buf: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes of the class."""
    m = np.zeros(len(buf) + 2, dtype=np.int8)
    m[1:-1] = member[buf]
    d = np.diff(m)
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1)


_U = np.uint64
_RNG = np.random.default_rng(20240611)
_BYTE = _RNG.integers(0, 2**64, 256, dtype=_U)
_P = int(_RNG.integers(0, 2**63, dtype=_U)) * 8 + 3 & (2**64 - 1)
_Q = [int(x) | 1 for x in _RNG.integers(0, 2**64, 8, dtype=_U)]
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, GROUP_BYTES + (1 << 16))
        for key, base in (("up", _P), ("down", pow(_P, -1, 2**64))):
            p = np.full(size, base, dtype=_U)
            p[0] = 1
            _POWERS[key] = np.cumprod(p, dtype=_U)
    return _POWERS["up"][:n], _POWERS["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (xor-shift and multiply, twice)."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """64-bit hash of every word, with ``fold`` lower-casing A-Z: a polynomial over random
    values of the bytes, by differences of one running sum."""
    if not len(starts):
        return np.zeros(0, dtype=_U)
    up, down = _powers(len(buf) + 1)
    total = np.zeros(len(buf) + 1, dtype=_U)
    np.cumsum((_BYTE[LOWER] if fold else _BYTE)[buf] * up[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(_U))


def word_rows(starts: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Index of the first word of every text (one more entry for the end)."""
    return np.searchsorted(starts, at)


NOT_SPACE = byte_class(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its ``k``-word shingles; with
    fewer words the whole sequence is one shingle; without words none."""
    buf, at = flat(texts)
    starts, ends = spans(buf, NOT_SPACE)
    w = word_hashes(buf, starts, ends)
    rows = word_rows(starts, at)
    h = np.zeros(max(0, len(w) - k + 1), dtype=_U)
    for j in range(k):
        h += w[j:j + len(h)] * _U(_Q[j])
    h = mix(h)
    out = []
    for a, b in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(h[a:b - k + 1]))
        elif b > a:
            s = np.array([sum(int(x) * _Q[j] for j, x in enumerate(w[a:b])) + (b - a) & (2**64 - 1)], dtype=_U)
            out.append(mix(s ^ _U(0x9E3779B97F4A7C15)))
        else:
            out.append(np.zeros(0, dtype=_U))
    return out
