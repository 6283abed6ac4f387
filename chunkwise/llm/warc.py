"""WARC archives as a chunked record table (operator 5).

An archive is a table of rows (record_id, chunk_no, data, payload_sha1, last);
record_id numbers the records of an archive. The data of a record's rows, in order of chunk_no, are the bytes of one WARC/1.1
record; records in any order make a valid WARC file. A record longer than
``chunk_bytes`` is several rows: the writer cuts the payload straight from the
input buffer and the reader takes one row at a time, so neither builds a record
as a whole. Each row carries the SHA-1 of the payload bytes up to its end: the
last one is the payload's digest, and the reader, which keeps one running hash
and no payload, checks every row against it.

A payload that several records share is stored once: the record with the
smallest page id is a ``response``, the others are ``revisit`` records without
payload that name it. Payloads under ``min_revisit_bytes`` are always stored.

Defined results: a null payload counts as empty; a null page id is a page of its
own, later than every other one; rows with the same id and payload are written
each, with the same type; a null url gives no target header; control characters
and spaces of a url are percent-encoded; an empty table gives an empty archive.
Extra columns of the input are never read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwise.config import materialize

CHUNK_BYTES = 1 << 20
CHUNK_ROW = "record_id string, chunk_no int, data binary, payload_sha1 binary, last boolean"
RECORD = "page_id string, payload_bytes bigint, payload_digest string, record_type string, refers_to string, target_uri string, intact boolean"

_CAPTURE_DATE = "2024-01-01T00:00:00Z"  # the tables carry no fetch time
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode("ascii")


def payload_stats(payload: Column) -> Column:
    """struct(bytes, digest): length and base32 SHA-1 of the payload in UTF-8, hashed chunk by chunk."""

    @F.arrow_udf("struct<bytes:bigint,digest:string>")
    def stats(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            sizes, digests = [], []
            for value in batch:
                view = memoryview(value.as_buffer())
                sha = hashlib.sha1()
                for k in range(0, len(view), CHUNK_BYTES):
                    sha.update(view[k : k + CHUNK_BYTES])
                sizes.append(len(view))
                digests.append(base32_sha1(sha.digest()))
            yield pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), pa.array(digests, pa.string())], ["bytes", "digest"])

    return stats(F.coalesce(payload, F.lit("")))


def record_head(page_id: str, url: str | None, size: int, digest: str, refers_to: str | None, revisit: bool) -> bytes:
    """Everything in front of the payload."""
    http = "" if revisit else f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:x-page:{page_id}>",
        f"WARC-Date: {_CAPTURE_DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Bytes: {size}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(http) + (0 if revisit else size)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        lines += [f"WARC-Profile: {_REVISIT_PROFILE}", f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
    return ("\r\n".join(lines) + "\r\n\r\n" + http).encode()


def record_chunks(head: bytes, payload: memoryview, chunk_bytes: int) -> Iterator[tuple[bytes, bytes, bool]]:
    """(data, SHA-1 of the payload so far, last) of one record, a chunk at a time."""
    sha, at, first = hashlib.sha1(), 0, True
    while True:
        part = payload[at : at + chunk_bytes]
        sha.update(part)
        at += len(part)
        last = at >= len(payload)
        yield (head if first else b"") + bytes(part) + (b"\r\n\r\n" if last else b""), sha.digest(), last
        if last:
            return
        first = False


def _write_rows(chunk_bytes: int):
    schema = pa.schema([("record_id", pa.string()), ("chunk_no", pa.int32()), ("data", pa.binary()), ("payload_sha1", pa.binary()), ("last", pa.bool_())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0  # a record's chunks come from one task
        rows, held = [], 0
        for batch in batches:
            column = {n: batch.column(n) for n in batch.schema.names}
            for i in range(batch.num_rows):
                page, url, size, digest, refers, revisit = (column[n][i].as_py() for n in ("page_id", "url", "bytes", "digest", "refers_to", "revisit"))
                payload = memoryview(b"") if revisit else memoryview(column["html"][i].as_buffer())
                head = record_head(page, url, size, digest, refers, revisit)
                for k, (data, sha, last) in enumerate(record_chunks(head, payload, chunk_bytes)):
                    rows.append((f"{part}-{number}", k, data, sha, last))
                    held += len(data)
                    if held >= 8 * chunk_bytes:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                        rows, held = [], 0
                number += 1
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return write


def write_archive(
    pages: DataFrame,
    path: str,
    chunk_bytes: int = CHUNK_BYTES,
    min_revisit_bytes: int = 0,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
) -> None:
    """Write one record per row of ``pages`` to the chunk table at ``path``."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("html"))
    rows = rows.withColumn("s", payload_stats(F.col("html")))
    known = materialize(rows.select("page_id", "s.bytes", "s.digest").distinct(), "payload_digests")
    first = known.where(F.col("bytes") >= min_revisit_bytes).groupBy("digest").agg(F.min("page_id").alias("refers_to"))
    revisit = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    decided = known.join(first, "digest", "left").select("page_id", "digest", F.when(revisit, F.col("refers_to")).alias("refers_to"))
    decided = decided.where(F.col("refers_to").isNotNull())  # the others are responses
    page, other = rows.select("*", "s.*").drop("s").alias("p"), decided.alias("d")
    same = F.col("p.page_id").eqNullSafe(F.col("d.page_id")) & (F.col("p.digest") == F.col("d.digest"))
    text_id = F.coalesce(F.col("p.page_id").cast("string"), F.lit("null")).alias("page_id")
    planned = page.join(other, same, "left").select(
        text_id,
        *(F.col(f"p.{c}") for c in ("url", "bytes", "digest")),
        F.when(F.col("d.refers_to").isNull(), F.col("p.html")).alias("html"),
        F.col("d.refers_to").cast("string").alias("refers_to"),
        F.col("d.refers_to").isNotNull().alias("revisit"),
    )
    planned.mapInArrow(_write_rows(chunk_bytes), CHUNK_ROW).write.option("compression", "zstd").parquet(path)


class _Record:
    """One record while its chunks pass by: its header fields, a running hash and counts."""

    def __init__(self, data: bytes):
        head, mark, rest = data.partition(b"\r\n\r\n")
        lines = head.decode("utf-8").split("\r\n")
        self.fields = dict(line.split(": ", 1) for line in lines[1:])
        self.good = lines[0].startswith("WARC/1.") and bool(mark)
        self.left = int(self.fields["Content-Length"])
        self.sha, self.size = hashlib.sha1(), 0
        self.pending = memoryview(data)[len(head) + len(mark) :]
        if self.left:  # an HTTP head comes before the payload
            http, mark, _ = rest.partition(b"\r\n\r\n")
            self.good &= bool(mark)
            self.pending = self.pending[len(http) + len(mark) :]
            self.left -= len(http) + len(mark)

    def add(self, data: memoryview, sha1: bytes, last: bool) -> None:
        part = data[: self.left]
        self.sha.update(part)
        self.size += len(part)
        self.left -= len(part)
        self.good &= self.sha.digest() == sha1
        if last:
            self.good &= self.left == 0 and bytes(data[len(part) :]) == b"\r\n\r\n"

    def row(self) -> tuple:
        f, revisit = self.fields, self.fields["WARC-Type"] == "revisit"
        said = f["WARC-Payload-Digest"].removeprefix("sha1:")
        digest, size = (said, int(f["X-Payload-Bytes"])) if revisit else (base32_sha1(self.sha.digest()), self.size)
        page = f["WARC-Record-ID"].removeprefix("<urn:x-page:").removesuffix(">")
        refers = f["WARC-Refers-To"].removeprefix("<urn:x-page:").removesuffix(">") if revisit else None
        intact = self.good and digest == said and size == int(f["X-Payload-Bytes"])
        return (None if page == "null" else page, size, digest, f["WARC-Type"], refers, f.get("WARC-Target-URI"), intact)


def _read_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of each record come in order of chunk_no, one record after the other."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri", "intact"]
    types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.bool_()]
    record = None
    for batch in batches:
        rows = []
        numbers, shas, lasts = (batch.column(n).to_pylist() for n in ("chunk_no", "payload_sha1", "last"))
        for i, number in enumerate(numbers):
            view = memoryview(batch.column("data")[i].as_buffer())
            if number == 0:
                record = _Record(bytes(view))
                view = record.pending
            record.add(view, shas[i], lasts[i])
            if lasts[i]:
                rows.append(record.row())
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def read_archive(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """One row per record, from its bytes alone. Records of one chunk need no shuffle;
    the chunks of longer ones meet in a task, which streams over them in order."""
    chunks = spark.read.schema(CHUNK_ROW).parquet(path)
    single = (F.col("chunk_no") == 0) & F.col("last")
    columns = ("chunk_no", "data", "payload_sha1", "last")
    short = chunks.where(single).select(*columns).mapInArrow(_read_rows, RECORD)
    long = chunks.where(~single)
    long = long.repartition("record_id").sortWithinPartitions("record_id", "chunk_no").select(*columns).mapInArrow(_read_rows, RECORD)
    return short.unionAll(long).withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})
