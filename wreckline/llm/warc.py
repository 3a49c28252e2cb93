"""WARC archives: write, normalise a monolithic gzip file, read back by offset.

``write_archives`` writes one gzip stream per task over many records, the layout that
cannot be read at an offset. ``normalise_archives`` inflates each such file once, in
chunks, rewrites every record as a gzip member of its own and writes a sidecar index of
(offset, length, record id, type) beside it. ``read_archives`` opens members by the index.

Memory is bounded by one record plus one chunk. Every file is written under a temporary
name and renamed, so an attempt that dies or runs twice leaves no half file behind; the
list of files is what the writing job returned, never a folder listing. Files go to the
cluster's shared folder through ``pyarrow.fs`` (local and mounted paths, HDFS, S3).

Defined cases: a null payload is written as an empty one; equal payloads of at least
``min_revisit_bytes`` are one response (the smallest id) and revisits that refer to it; a
page with a null id is a response; rows that repeat the smallest id are all responses; an
empty table gives no archives; other columns are not stored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from .common import staged

CHUNK = 1 << 20
_FILES = "path string, records long"
_INDEX = "path string, offset long, length long, page_id long, record_type string"
_RECORDS = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "url string, digest_ok boolean"
)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(row: dict) -> bytes:
    """One WARC/1.1 record; a revisit carries headers only."""
    payload = row["payload"] or b""
    revisit = row["refers_to"] is not None
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{row['page_id']}>",
        "WARC-Target-URI: " + re.sub(r"[\x00-\x1f\x7f]", "", row["url"] or ""),
        f"WARC-Payload-Digest: sha1:{row['payload_digest']}",
        f"X-Payload-Length: {row['payload_bytes']}",
    ]
    if revisit:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{row['refers_to']}>",
        ]
    body = b"" if revisit else payload
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The store that holds a path, and the path within it."""
    if urlsplit(path).scheme in ("", "file"):
        return fs.LocalFileSystem(), urlsplit(path).path
    return fs.FileSystem.from_uri(path)


def _publish(store: fs.FileSystem, temporary: str, final: str) -> None:
    """Give a finished file its name; a second attempt replaces an equal file."""
    store.move(temporary, final)


def payload_roles(pages: DataFrame, page_id: str, url: str, html: str, min_revisit_bytes: int) -> DataFrame:
    """Every page with its payload, digest and, for revisits, the response's id.

    The smallest id per digest is found by a partial aggregation over digests alone; only
    digests that occur twice are joined back, and a payload that a third of all pages
    share is a skewed key of that join, which adaptive execution splits.
    """
    payload = F.encode(F.coalesce(F.col(f"`{html}`"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"), payload.alias("payload"))
    size = F.octet_length("payload").cast("long")
    rows = rows.withColumn("payload_bytes", size).withColumn("sha1", F.sha1("payload"))
    first = rows.where(F.col("payload_bytes") >= min_revisit_bytes).groupBy("sha1").agg(
        F.min("page_id").alias("first_id"), F.count("*").alias("copies"))
    first = staged(first.where("copies > 1").drop("copies"), "warc-digests")
    rows = rows.join(first, "sha1", "left")
    refers = F.when(F.col("first_id") != F.col("page_id"), F.col("first_id"))
    return rows.select("page_id", "url", "payload", "payload_bytes", "sha1", refers.alias("refers_to"))


def write_archives(
    pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
    min_revisit_bytes: int = 0,
) -> DataFrame:
    """Write each partition as one monolithic ``.warc.gz``; (path, records) of each file."""
    rows = payload_roles(pages, page_id, url, html, min_revisit_bytes)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _filesystem(folder)
        store.create_dir(base)
        name = uuid.uuid4().hex
        records, out, deflate = 0, None, zlib.compressobj(3, zlib.DEFLATED, 31)
        for batch in batches:
            for row in batch.to_pylist():
                row["payload_digest"] = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
                if out is None:
                    out = store.open_output_stream(f"{base}/.{name}.part", compression=None)
                out.write(deflate.compress(_record(row)))
                records += 1
        if out is not None:
            out.write(deflate.flush())
            out.close()
            _publish(store, f"{base}/.{name}.part", f"{base}/{name}.warc.gz")
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}.warc.gz"], "records": [records]})

    return staged(rows.mapInArrow(write, _FILES), "warc-files")


def inflate(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Inflate a gzip stream of one or many members, chunk by chunk."""
    machine = zlib.decompressobj(31)
    for chunk in chunks:
        while chunk:
            out = machine.decompress(chunk, CHUNK)
            if out:
                yield out
            if machine.eof:
                chunk, machine = machine.unused_data, zlib.decompressobj(31)
            else:
                chunk = machine.unconsumed_tail


def split_records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, whole record) of each record of an inflated stream."""
    buffer = bytearray()

    def need(n: int) -> bool:
        while len(buffer) < n:
            chunk = next(chunks, None)
            if chunk is None:
                return False
            buffer.extend(chunk)
        return True

    while need(1):
        end = buffer.find(b"\r\n\r\n")
        while end < 0:
            if not need(len(buffer) + 1):
                raise ValueError("truncated WARC header")
            end = buffer.find(b"\r\n\r\n")
        head = parse_head(bytes(buffer[:end]))
        whole = end + 4 + int(head["content-length"]) + 4
        if not need(whole):
            raise ValueError("truncated WARC record")
        yield head, bytes(buffer[:whole])
        del buffer[:whole]


def parse_head(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    pairs = (line.partition(":") for line in lines[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def _page(urn: str | None) -> int | None:
    digits = urn and urn.removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits and digits != "None" else None


def _chunks(stream: pa.NativeFile) -> Iterator[bytes]:
    while chunk := stream.read(CHUNK):
        yield chunk


def normalise_archives(files: DataFrame) -> DataFrame:
    """Rewrite each file record by record, with a sidecar ``.idx`` of JSON lines; the
    index as (path, offset, length, page_id, record_type)."""

    def normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, source = _filesystem(path)
                target, tag = source.removesuffix(".warc.gz") + ".members.warc.gz", uuid.uuid4().hex
                index, at = [], 0
                with store.open_input_stream(source, compression=None) as stream, \
                        store.open_output_stream(f"{target}.{tag}", compression=None) as out:
                    for head, record in split_records(inflate(_chunks(stream))):
                        deflate = zlib.compressobj(3, zlib.DEFLATED, 31)
                        member = deflate.compress(record) + deflate.flush()
                        out.write(member)
                        index.append((at, len(member), _page(head["warc-record-id"]), head["warc-type"]))
                        at += len(member)
                sidecar = target.removesuffix(".warc.gz") + ".idx"
                with store.open_output_stream(f"{sidecar}.{tag}", compression=None) as out:
                    for entry in index:
                        out.write(json.dumps(entry).encode() + b"\n")
                _publish(store, f"{target}.{tag}", target)
                _publish(store, f"{sidecar}.{tag}", sidecar)
                offsets, lengths, ids, kinds = zip(*index, strict=True)
                name = path.removesuffix(".warc.gz") + ".members.warc.gz"
                yield pa.RecordBatch.from_pydict({
                    "path": [name] * len(index), "offset": pa.array(offsets, pa.int64()),
                    "length": pa.array(lengths, pa.int64()), "page_id": pa.array(ids, pa.int64()),
                    "record_type": list(kinds)})

    n = max(files.count(), 1)
    one_each = files.repartition(n, "path")
    return staged(one_each.mapInArrow(normalise, _INDEX), "warc-index")


def read_archives(index: DataFrame) -> DataFrame:
    """Open every indexed member and return its record's fields; ``digest_ok`` says that a
    response's payload has the digest and length that its header states."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, stream = None, None
        for batch in batches:
            rows = []
            for e in batch.to_pylist():
                if e["path"] != path:
                    if stream is not None:
                        stream.close()
                    path = e["path"]
                    store, inner = _filesystem(path)
                    stream = store.open_input_file(inner)
                stream.seek(e["offset"])
                record = zlib.decompress(stream.read(e["length"]), 31)
                end = record.index(b"\r\n\r\n")
                head = parse_head(record[:end])
                payload = record[end + 4:-4]
                length, digest = int(head["x-payload-length"]), head["warc-payload-digest"].removeprefix("sha1:")
                kind = head["warc-type"]
                rows.append({
                    "page_id": _page(head["warc-record-id"]), "payload_bytes": length, "payload_digest": digest,
                    "record_type": kind, "refers_to": _page(head.get("warc-refers-to")), "url": head["warc-target-uri"],
                    "digest_ok": kind == "revisit" or (len(payload) == length and payload_digest(payload) == digest),
                })
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
        if stream is not None:
            stream.close()

    return index.mapInArrow(read, _RECORDS)


_ARROW = pa.schema([
    ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("digest_ok", pa.bool_())])


def archive_folder(spark: SparkSession) -> str:
    return shared_dir(spark, "warc")
