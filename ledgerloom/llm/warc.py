"""WARC archives: one gzip member per record, written in tasks, read back sequentially with bounded memory.

Payloads of at least ``REVISIT_BYTES`` that repeat an earlier page's payload are written as ``revisit``
records.  Archives go to the shared scratch folder through ``pyarrow.fs`` (local and remote stores); a task
names its files anew at every attempt and reports them, and only reported files are read, so a lost or
repeated task leaves no half archive in the result.  The reader inflates one member at a time, frames the
block by Content-Length and checks block and payload digests.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.words import ship
from ledgerloom.scale import durable, scratch_path

REVISIT_BYTES = 100
ARCHIVE_BYTES = 64 << 20
READ_TASKS = 20_000
READ_BYTES = 1 << 20
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record(page_id, url, payload: bytes, digest: str, refers_to=None, revisit: bool = False) -> bytes:
    """One WARC/1.1 record.  A revisit keeps the HTTP head and leaves out the payload."""
    block = _HTTP % len(payload) + (b"" if revisit else payload)
    shown = "" if page_id is None else str(page_id)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{shown}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {' '.join((url or '').split())}",
        "Content-Type: application/http;msgtype=response",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def members(stream, size: int = READ_BYTES) -> Iterator[bytes]:
    """Inflated gzip members of a stream, one at a time; the stream is read in blocks."""
    inflate, parts, data = zlib.decompressobj(31), [], b""
    while True:
        if not data:
            data = stream.read(size)
            if not data:
                break
        parts.append(inflate.decompress(data))
        data = b""
        if inflate.eof:
            yield b"".join(parts)
            data, inflate, parts = inflate.unused_data, zlib.decompressobj(31), []
    if parts:
        raise ValueError("the archive ends within a gzip member")


def parse(data: bytes) -> dict:
    """Headers, block and payload of a record; raises if framing or a digest is wrong."""
    head, found, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not found or not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    size = int(headers["content-length"])
    block, tail = rest[:size], rest[size:]
    if len(block) != size or tail != b"\r\n\r\n":
        raise ValueError("the block does not have its Content-Length")
    if f"sha256:{hashlib.sha256(block).hexdigest()}" != headers["warc-block-digest"]:
        raise ValueError("wrong block digest")
    payload = block.partition(b"\r\n\r\n")[2]
    digest = headers["warc-payload-digest"].removeprefix("sha256:")
    if headers["warc-type"] == "response" and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError("wrong payload digest")
    return {"headers": headers, "payload": payload, "digest": digest}


def _number(urn: str | None) -> int | None:
    text = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def _open_folder(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (
        fs.LocalFileSystem(), folder)


def plan_records(pages: DataFrame) -> DataFrame:
    """Adds ``payload_digest``, ``refers_to`` and ``revisit``; a null html is an empty payload."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        html.cast("binary").alias("payload"), F.sha2(html, 256).alias("payload_digest"),
    )
    large = F.octet_length("payload") >= REVISIT_BYTES
    first = (
        rows.where(large).groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and first is not null").select("payload_digest", "first")
    )
    joined = rows.join(first, "payload_digest", "left")
    revisit = large & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.withColumn("revisit", revisit).withColumn("refers_to", F.expr("if(revisit, first, null)"))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record per page below ``folder``; returns ``archive, records`` of the files that count."""
    rows = plan_records(pages).select("page_id", "url", "payload", "payload_digest", "refers_to", "revisit")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open_folder(folder)
        store.create_dir(root, recursive=True)
        stream, name, count, written, done = None, "", 0, 0, []
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if stream is None:
                    name, count, written = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    stream = store.open_output_stream(name, compression=None)
                data = member(record(*row))
                stream.write(data)
                count, written = count + 1, written + len(data)
                if written >= ARCHIVE_BYTES:
                    stream.close()
                    done.append((name, count))
                    stream = None
        if stream is not None:
            stream.close()
            done.append((name, count))
        yield pa.RecordBatch.from_pydict(
            {"archive": [x[0] for x in done], "records": [x[1] for x in done]},
            schema=pa.schema([("archive", pa.string()), ("records", pa.int64())]),
        )

    return durable(rows.mapInArrow(write, "archive string, records long"))


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Records of the archives: ``page_id, url, record_type, refers_to, payload, payload_digest``, verified."""

    schema = "page_id long, url string, record_type string, refers_to long, payload binary, payload_digest string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = _open_folder(folder)
        target = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                            ("refers_to", pa.int64()), ("payload", pa.binary()), ("payload_digest", pa.string())])
        for batch in batches:
            for archive, records in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows, size, seen = [], 0, 0
                with store.open_input_stream(archive, compression=None) as stream:
                    for data in members(stream):
                        found = parse(data)
                        headers = found["headers"]
                        rows.append((
                            _number(headers["warc-record-id"]), headers["warc-target-uri"], headers["warc-type"],
                            _number(headers.get("warc-refers-to")), found["payload"], found["digest"],
                        ))
                        size, seen = size + len(data), seen + 1
                        if size >= 8 << 20:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), target, strict=True)],
                                schema=target)
                            rows, size = [], 0
                if seen != records:
                    raise ValueError(f"{archive} has {seen} records, not {records}")
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), target, strict=True)],
                        schema=target)

    # A stated number: rows this small would otherwise be put together into one task.
    tasks = max(1, min(archives.count(), READ_TASKS))
    spread = archives.select("archive", "records").repartition(tasks)
    return spread.mapInArrow(run, schema)


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``pages`` to archives, read them back: ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    A revisit takes the payload of the record it refers to.  Null html is an empty payload, null url an empty
    URI.  A null ``page_id`` is never the response of a group that has one with a number.  Rows that repeat
    the smallest ``page_id`` of a group are all responses.  Other columns are ignored; an empty table gives
    no rows.
    """
    ship(pages.sparkSession)
    folder = folder or scratch_path(pages.sparkSession, "warc")
    records = read_archives(write_archives(pages, folder), folder)
    records = durable(records.select(
        "page_id", "record_type", "refers_to", "payload_digest", F.octet_length("payload").cast("long").alias("bytes")
    ))
    known = records.where("record_type = 'response'").groupBy(
        F.col("page_id").alias("refers_to"), "payload_digest"
    ).agg(F.max("bytes").alias("referred"))
    revisits = records.where("record_type = 'revisit'").join(known, ["refers_to", "payload_digest"], "left")
    both = records.where("record_type = 'response'").withColumn("referred", F.col("bytes")).unionByName(revisits)
    return both.select(
        "page_id", F.col("referred").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"
    )
