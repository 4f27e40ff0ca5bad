"""WARC archives: a writer and a splittable reader.

Every record is a gzip member of its own.  The writer uses Spark's file writer,
so tasks that are lost or run twice leave whole files only: members are written
as raw bytes with the last byte, always zero, as the line separator.  Records
with the payload of another one are written as revisits.

The reader needs no index: archives are cut into byte ranges; a task scans its
range for the gzip magic, takes a place for a member only if the bytes there
decode to a WARC header, and reads the records that start inside its range, also
beyond its end.

Edge cases: a null payload is empty; a null url has no target URI; white space
and control characters in a url are percent-encoded; a null or repeated page id
is written and read like any other; an empty table gives no files and no
records; very long payloads are one record each; other columns are ignored.
"""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import _text as T

MIN_REVISIT_BYTES = 1000
SPLIT_BYTES = 16 << 20
_MAGIC = b"\x1f\x8b\x08"
_BLOCK = 1 << 20
_DATE = "2024-01-01T00:00:00Z"
READ_SCHEMA = ("archive string, offset bigint, record_id string, record_type string, target_uri string, "
               "payload_digest string, refers_to string, payload binary")


# -- writing ---------------------------------------------------------------------

def with_revisits(pages: DataFrame, id_col: str, payload: Column, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``pages`` (``id``, ``uri``, ``payload``, ``digest``) and ``refers_to``: of
    rows with equal payloads of at least ``min_bytes`` the largest id, for the
    others.  Payloads are told apart by SHA-1 and length; only these are shuffled
    for that, and the decision comes back by id and digest."""
    rows = pages.select(F.col(id_col).cast("string").alias("id"), F.col(id_col).alias("ord"), F.col("url").alias("uri"),
                        payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("bytes", F.length("payload"))
    narrow = rows.where(F.col("bytes") >= min_bytes).select("ord", "id", "digest", "bytes")
    groups = narrow.groupBy("digest", "bytes").agg(F.max(F.struct("ord", "id")).alias("last"), F.min("ord").alias("lo")) \
        .where(F.col("lo") < F.col("last.ord"))
    chosen = (narrow.join(groups, ["digest", "bytes"]).where(F.col("ord").isNull() | (F.col("ord") < F.col("last.ord")))
              .select(F.col("id").alias("d_id"), F.col("digest").alias("d_digest"), F.col("last.id").alias("refers_to")).distinct())
    return (rows.join(chosen, F.col("id").eqNullSafe(F.col("d_id")) & (F.col("digest") == F.col("d_digest")), "left")
            .select("id", "uri", "payload", "digest", "refers_to"))


def write(records: DataFrame, path: str) -> None:
    """One gzip member per row of ``id``, ``uri``, ``payload``, ``digest``, ``refers_to``."""
    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                m = gzip.compress(_record(row), 6, mtime=0)
                while m[-1]:  # the length's highest byte, of records over 16 MB: an empty member follows
                    m += gzip.compress(b"", mtime=0)
                out.append(m[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    T.bounded_batches(records.sparkSession)
    (records.mapInArrow(members, "value binary").select(F.col("value").cast("string").alias("value"))
     .write.option("lineSep", "\x00").option("compression", "none").text(path))


def _urn(page: str | None) -> str:
    return f"<urn:page:{'' if page is None else quote(page, safe='')}>"


def _page(urn: str | None) -> str | None:
    name = (urn or "")[len("<urn:page:"):-1]
    return unquote(name) or None


def _record(row: dict) -> bytes:
    revisit = row["refers_to"] is not None
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (b"" if revisit else row["payload"] or b"")
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _urn(row["id"])), ("WARC-Date", _DATE),
            ("WARC-Payload-Digest", f"sha1:{row['digest']}"), ("Content-Type", "application/http; msgtype=response")]
    if row["uri"] is not None:
        head.append(("WARC-Target-URI", quote(row["uri"], safe="!#$%&'()*+,/:;=?@[]~")))
    if revisit:
        head += [("WARC-Refers-To", _urn(row["refers_to"])),
                 ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    head.append(("Content-Length", str(len(body))))
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + body + b"\r\n\r\n"


# -- reading ---------------------------------------------------------------------

class _File:
    """Reads of one archive at given places, from any file system that Arrow knows."""

    def __init__(self, path: str) -> None:
        from pyarrow import fs

        system, name = fs.FileSystem.from_uri(path)
        self.file = system.open_input_file(name)
        self.size = self.file.size()

    def at(self, offset: int, n: int) -> bytes:
        n = min(n, self.size - offset)
        return self.file.read_at(n, offset) if n > 0 else b""


def _decode(file: _File, offset: int) -> tuple[bytes, int] | None:
    """The member at ``offset`` and the place after it; None if no WARC record is there."""
    z, out, at = zlib.decompressobj(31), [], offset
    size = 4096  # enough for the header; a false candidate costs no more
    while not z.eof:
        raw = file.at(at, size)
        if not raw:
            return None
        try:
            out.append(z.decompress(raw))
        except zlib.error:
            return None
        at += len(raw)
        if size < _BLOCK:
            head = b"".join(out)
            if not head.startswith(b"WARC/"[:len(head)]):
                return None
            size = _BLOCK
    data = b"".join(out)
    return (data, at - len(z.unused_data)) if data.startswith(b"WARC/") else None


def records(path: str, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """The records of an archive that start in ``[start, end)``."""
    file = _File(path)
    end = min(end, file.size)
    at = start
    while at < end:
        block = file.at(at, min(_BLOCK, end - at) + len(_MAGIC) - 1)
        i = block.find(_MAGIC)
        if i < 0:
            at += max(1, len(block) - len(_MAGIC) + 1)
            continue
        found = _decode(file, at + i)
        if found is None:
            at += i + 1
            continue
        yield at + i, found[0]
        at = found[1]


def _fields(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, body = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8", "replace").split("\r\n")[1:] if ": " in x)
    return {k.lower(): v for k, v in fields.items()}, body[:int(fields.get("Content-Length", len(body)))]


def read(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The records of all archives under ``path`` (``READ_SCHEMA``; payload: what
    follows the HTTP header).  Byte ranges are dealt to tasks at random."""
    T.bounded_batches(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length").where("length > 0")
    ranges = files.select("path", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(split_bytes))).alias("start"))

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("archive", pa.string()), ("offset", pa.int64()), *((n, pa.string()) for n in (
            "record_id", "record_type", "target_uri", "payload_digest", "refers_to")), ("payload", pa.binary())])
        rows, size = [], 0
        for batch in batches:
            for r in batch.to_pylist():
                for offset, data in records(r["path"], r["start"], r["start"] + split_bytes):
                    f, body = _fields(data)
                    payload = body.partition(b"\r\n\r\n")[2]
                    rows.append((r["path"], offset, _page(f.get("warc-record-id")), f.get("warc-type"), f.get("warc-target-uri"),
                                 f.get("warc-payload-digest", "").removeprefix("sha1:"), _page(f.get("warc-refers-to")), payload))
                    size += len(payload)
                    if size > T.GROUP_BYTES or len(rows) >= T.BATCH_ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    n = max(1, spark.sparkContext.defaultParallelism * 4)
    return ranges.repartition(n, F.xxhash64("path", "start")).mapInArrow(fn, READ_SCHEMA)



def archive(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html") -> str:
    """Write the pages as archives under the shared folder; returns the folder."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    path = scratch_path(pages.sparkSession, "warc")
    write(with_revisits(pages, id_col, payload), path)
    return path


def verified(records_: DataFrame) -> DataFrame:
    """Per record ``id``, ``record_type``, ``refers_to``, ``payload_digest`` and
    ``payload_bytes``: computed from the payload of a response; of a revisit
    those of the response that it names, if the digests agree (else null)."""
    rows = records_.select(F.col("record_id").alias("id"), "record_type", "refers_to", F.col("payload_digest").alias("said"),
                           F.sha1("payload").alias("sha"), F.length("payload").cast("bigint").alias("n"))
    rows = T.kept(rows, "warc-records")
    own = rows.where("record_type = 'response'").select(
        "id", "record_type", "refers_to", F.when(F.col("sha") == F.col("said"), F.col("sha")).alias("payload_digest"), F.col("n").alias("payload_bytes"))
    by = own.select(F.col("id").alias("refers_to"), F.col("payload_digest").alias("said"), "payload_bytes").distinct()
    revisits = rows.where("record_type = 'revisit'").join(by, ["refers_to", "said"], "left").select(
        "id", "record_type", "refers_to", F.when(F.col("payload_bytes").isNotNull(), F.col("said")).alias("payload_digest"), "payload_bytes")
    return own.unionByName(revisits)
