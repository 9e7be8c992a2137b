"""WARC archives as chunked record tables.

Writing: each task appends gzip members, one per record, to files of its own
in the shared folder; the manifest rows it returns are committed by Spark, so
files of a failed attempt are never listed. Payloads seen before are revisit
records without a body. Reading: files are streamed, never whole; a payload
becomes rows (record, chunk number) of at most ``CHUNK`` bytes, each with the
SHA-1 of all bytes up to its end.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm import textkit as tk
from strandloom.plans.snapshot import fresh_path, snapshot

CHUNK, FILE_BYTES, LEVEL = 1 << 20, 64 << 20, 1
#: Payloads of fewer bytes are never revisits.
REVISIT_LEAST = 1000
#: Revisit rows (16 bytes each) that may be broadcast to the pages; beyond it both sides are shuffled.
BROADCAST_ROWS = 1 << 22
#: Fixed values of the format.
DATE, PROFILE = "2024-01-01T00:00:00Z", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def _uri(url: str) -> str:
    return _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url)


def record_head(record_id: str, url: str | None, digest: bytes, size: int, refers_to: str | None) -> bytes:
    """Everything of a record before the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to else 'response'}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_uri(url)}")
    lines.append("WARC-Payload-Digest: sha1:" + base64.b32encode(digest).decode())
    if refers_to:
        lines += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + (0 if refers_to else size)}", "", ""]
    return "\r\n".join(lines).encode("utf-8", "replace") + http


def revisits(pages: DataFrame, page_id: str, payload: str) -> DataFrame:
    """(id, digest, refers_to) of pages whose payload a page of larger id has too."""
    p = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    d = pages.select(F.col(page_id).cast("long").alias("id"), F.sha2(p, 256).alias("digest"), F.octet_length(p).alias("n")).where(f"id is not null and n >= {REVISIT_LEAST}")
    many = d.groupBy("digest").agg(F.count("*").alias("k"), F.max("id").alias("refers_to")).where("k > 1").select("digest", "refers_to")
    return d.join(many, "digest").where("id <> refers_to").select("id", "digest", "refers_to").distinct()


def write_archives(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write a record per row; returns the manifest (path, records, bytes).

    A null payload is an empty one; a null id is written as ``urn:page:null``
    and is a response. Rows that repeat an id and payload give a record each.
    """
    spark = pages.sparkSession
    where = fresh_path(spark, "warc")
    # Ids that repeat with different payloads: the payload's own revisit row is meant, so the digest joins too.
    p = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    seen = snapshot(revisits(pages, page_id, payload), "warc-revisits")
    if seen.count() <= BROADCAST_ROWS:
        seen = F.broadcast(seen)
    rows = pages.select(F.col(page_id).cast("long").alias("page"), F.col(url).cast("string").alias("u"), p.alias("p"), F.sha2(p, 256).alias("d")).join(seen, (F.col("page") == F.col("id")) & (F.col("d") == F.col("digest")), "left").select("page", "u", "p", "refers_to")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(where)
        store.create_dir(root, recursive=True)
        out, path, size, n = None, None, 0, 0
        manifest: list[tuple[str, int, int]] = []
        for b in batches:
            for page, u, body, refers in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist(), strict=True):
                if out is None:
                    name = f"part-{tk.partition_id():06d}-{uuid.uuid4().hex}.warc.gz"
                    path, out, size, n = f"{where}/{name}", store.open_output_stream(f"{root}/{name}", compression=None), 0, 0
                view = memoryview(body.as_buffer())
                digest = hashlib.sha1(view).digest()
                z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                member = [z.compress(record_head(f"urn:page:{'null' if page is None else page}", u, digest, len(view), None if refers is None else f"urn:page:{refers}"))]
                for a in range(0, 0 if refers is not None else len(view), CHUNK):
                    member.append(z.compress(view[a : a + CHUNK]))
                member += [z.compress(b"\r\n\r\n"), z.flush()]
                for x in member:
                    size += out.write(x) or len(x)
                n += 1
                if size >= FILE_BYTES:
                    out.close()
                    manifest.append((path, n, size))
                    out = None
        if out is not None:
            out.close()
            manifest.append((path, n, size))
        if manifest:
            a, b, c = zip(*manifest, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b, pa.int64()), pa.array(c, pa.int64())], ["path", "records", "bytes"])

    return snapshot(rows.mapInArrow(write, "path string, records long, bytes long"), "warc-manifest")


class Unzipped(io.RawIOBase):
    """The bytes of all gzip members of a stream, as they come."""

    def __init__(self, source):
        self.source, self.z, self.raw, self.out = source, zlib.decompressobj(31), b"", b""

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        while not self.out:
            if self.z.eof:
                self.raw, self.z = self.z.unused_data, zlib.decompressobj(31)
            if not self.raw:
                self.raw = self.source.read(1 << 18)
                if not self.raw:
                    return 0
            self.out = self.z.decompress(self.raw, 1 << 20)
            self.raw = self.z.unconsumed_tail
            if self.z.eof:
                self.raw = b""
        n = min(len(into), len(self.out))
        into[:n] = self.out[:n]
        self.out = self.out[n:]
        return n


def read_records(stream, chunk: int = CHUNK) -> Iterator[tuple]:
    """(record_id, type, refers_to, uri, declared sha1 hex, payload bytes, chunk number, chunk, sha1 so far, last)."""
    f = io.BufferedReader(Unzipped(stream), 1 << 18)
    while True:
        line = f.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:40]!r}")
        head = {}
        while (line := f.readline()) not in (b"\r\n", b"\n", b""):
            k, _, v = line.decode("utf-8", "replace").partition(":")
            head[k.strip().lower()] = v.strip()
        left = int(head["content-length"])
        size = left
        if head.get("content-type", "").startswith("application/http"):
            while True:
                line = f.readline()
                left -= len(line)
                if line in (b"\r\n", b"\n", b""):
                    break
                if line.lower().startswith(b"content-length:"):
                    size = int(line.split(b":")[1])
        digest = head.get("warc-payload-digest", "").removeprefix("sha1:")
        digest = base64.b32decode(digest).hex() if digest else None
        common = (head["warc-record-id"].strip("<>"), head["warc-type"], head.get("warc-refers-to", "").strip("<>") or None, head.get("warc-target-uri"), digest, size)
        sha, number = hashlib.sha1(), 0
        while True:
            data = f.read(min(chunk, left))
            if left and not data:
                raise ValueError("a record ends early")
            left -= len(data)
            sha.update(data)
            yield *common, number, data, sha.copy().hexdigest(), left == 0
            number += 1
            if left == 0:
                break


_ROW = "record_id string, record_type string, refers_to string, target_uri string, declared_digest string, payload_bytes long, chunk int, payload binary, digest_so_far string, last boolean"


def read_archives(manifest: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The chunk table of all files of a manifest; an empty payload is one empty chunk."""
    files = manifest.count()
    if not files:
        return manifest.sparkSession.createDataFrame([], _ROW)
    kinds = [pa.string()] * 5 + [pa.int64(), pa.int32(), pa.binary(), pa.string(), pa.bool_()]
    names = [x.split()[0] for x in _ROW.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for b in batches:
            for path in b.column(0).to_pylist():
                store, at = fs.FileSystem.from_uri(path)
                with store.open_input_stream(at, compression=None) as f:
                    rows, size = [], 0
                    for r in read_records(f, chunk):
                        rows.append(r)
                        size += len(r[7])
                        if size > 4 << 20 or len(rows) >= 4096:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return manifest.select("path").repartition(files).mapInArrow(read, _ROW)
