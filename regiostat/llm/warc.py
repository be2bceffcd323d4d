"""Operator 3: web archives, one gzip member for each record.

The writer puts pages into WARC 1.1 files in the shared folder.  The reader
goes through an archive sequentially: it inflates one member after the other
in small pieces, takes the block by its content length and checks the block
and payload digests.  A page whose payload another page holds too is a
revisit without payload.

Defined cases: a null html is an empty payload, a null url is written as
``about:blank``; a null page_id is read back as null, and never is the one
that others revisit while another page has an id; pages that repeat the
largest page_id of equal payloads are all responses; an empty table gives no
rows; extra columns are not archived.  A file that a lost task left behind is
in no manifest and is never read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lookup, saved, scratch

#: Payloads of fewer bytes are always stored.
REVISIT_BYTES = 1000
#: A file is closed beyond so many compressed bytes.
FILE_BYTES = 64 << 20
PIECE = 1 << 16
#: The tables have no time of capture.
DATE = "1970-01-01T00:00:00Z"
# Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "urn:regiostat:page:"


class ArchiveError(ValueError):
    """An archive that breaks its framing or a digest."""


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI in a store that pyarrow knows (file, hdfs, s3, gs, abfs)."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, kind: str, refers_to: int | None) -> bytes:
    """One record as a gzip member."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if kind == "response" else http
    uri = quote(url, safe="%/:=&?~#+!$,;'@()*[]") if url else "about:blank"
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{RECORD}{'' if page_id is None else page_id}>"),
            ("WARC-Date", DATE), ("WARC-Target-URI", uri), ("Content-Type", "application/http;msgtype=response"),
            ("WARC-Block-Digest", _sha1(block)), ("WARC-Payload-Digest", _sha1(payload)),
            ("Content-Length", str(len(block)))]
    if kind == "revisit":
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{RECORD}{refers_to}>")]
    lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in head)
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n") + squeeze.flush()


def _writer(folder: str):
    def write(batches):
        store, base = opened(folder)
        store.create_dir(base, recursive=True)
        out, name, size, records = None, "", 0, 0

        def closed():
            out.close()
            return pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "bytes": [size], "records": [records]})

        for batch in batches:
            for page_id, url, html, kind, to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"  # a task that runs again writes a file of its own
                    out, size, records = store.open_output_stream(f"{base}/{name}"), 0, 0
                data = record(page_id, url, (html or "").encode(), kind, to)
                out.write(data)
                size, records = size + len(data), records + 1
                if size >= FILE_BYTES:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return write


class Member:
    """The inflated bytes of one gzip member, read in order from a stream."""

    def __init__(self, stream, rest: bytes):
        self.stream, self.input, self.ready = stream, rest, b""
        self.inflate = zlib.decompressobj(31)

    def more(self) -> bool:
        """Inflate another piece; false at the member's end."""
        while not self.inflate.eof:
            data = self.inflate.unconsumed_tail or self.input or self.stream.read(PIECE)
            self.input = b""
            if not data:
                raise ArchiveError("a member is cut short")
            try:
                piece = self.inflate.decompress(data, PIECE)
            except zlib.error as e:
                raise ArchiveError(str(e)) from e
            if piece:
                self.ready += piece
                return True
        return False

    def until(self, mark: bytes) -> bytes:
        while (at := self.ready.find(mark)) < 0:
            if not self.more():
                raise ArchiveError("no end of a header")
        out, self.ready = self.ready[:at], self.ready[at + len(mark):]
        return out

    def take(self, size: int):
        """The next ``size`` bytes, in pieces."""
        while size:
            if not self.ready and not self.more():
                raise ArchiveError("a block is shorter than its content length")
            piece, self.ready = self.ready[:size], self.ready[size:]
            size -= len(piece)
            yield piece

    def end(self) -> bytes:
        """Check the record's end; return the bytes of the next member read so far."""
        while self.more():
            pass
        if self.ready != b"\r\n\r\n":
            raise ArchiveError("a member holds more or less than one record")
        return self.inflate.unused_data


def _fields(lines: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in
            (x.partition(":") for x in lines.decode("utf-8").split("\r\n")) if k}


def _page(urn: str | None) -> int | None:
    number = (urn or "").strip("<>").removeprefix(RECORD)
    return int(number) if number else None


def read_archive(stream, with_payload: bool = False):
    """The records of an archive, one dictionary after the other."""
    rest = stream.read(PIECE)
    while rest:
        member = Member(stream, rest)
        if member.until(b"\r\n") != VERSION:
            raise ArchiveError("not a WARC record")
        head = _fields(member.until(b"\r\n\r\n"))
        block, payload, front, http, kept, size = hashlib.sha1(), hashlib.sha1(), b"", None, [], 0
        for piece in member.take(int(head["content-length"])):
            block.update(piece)
            if http is None:
                front += piece
                if b"\r\n\r\n" not in front:
                    continue
                status, piece = front.split(b"\r\n\r\n", 1)
                http = _fields(status.partition(b"\r\n")[2])
            payload.update(piece)
            size += len(piece)
            if with_payload:
                kept.append(piece)
        if http is None:
            raise ArchiveError("no HTTP header")
        digest = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:"))
        if block.digest() != base64.b32decode(head["warc-block-digest"].removeprefix("sha1:")):
            raise ArchiveError(f"block digest of {head['warc-record-id']}")
        stated, kind = int(http["content-length"]), head["warc-type"]
        if kind == "response" and (payload.digest() != digest or size != stated):
            raise ArchiveError(f"payload digest of {head['warc-record-id']}")
        yield {"page_id": _page(head["warc-record-id"]), "url": head["warc-target-uri"], "record_type": kind,
               "payload_bytes": stated, "payload_digest": digest.hex(), "refers_to": _page(head.get("warc-refers-to")),
               "payload": b"".join(kept) if with_payload and kind == "response" else None}
        rest = member.end() or stream.read(PIECE)


_READ = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                   ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
                   ("payload", pa.binary())])
READ_SCHEMA = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
               "refers_to long, payload binary")


def _reader(with_payload: bool):
    def read(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, name = opened(path)
                rows, held = [], 0
                with store.open_input_stream(name) as stream:
                    for r in read_archive(stream, with_payload):
                        rows.append(r)
                        held += 200 + len(r["payload"] or b"")
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, _READ)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _READ)

    return read


def with_types(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """page_id, url, html, record_type, refers_to.

    Only digests and ids are grouped; the table of repeated payloads is
    broadcast if it is small, else pages are dealt by digest and Spark splits
    what is skewed.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", "html", F.sha1(payload).alias("digest"), F.octet_length(payload).alias("size"))
    repeated = rows.where(F.col("size") >= least).groupBy(F.col("digest").alias("same")).agg(
        F.max("page_id").alias("keeper"), F.count("*").alias("n")).where("n > 1").select("same", "keeper")
    out = lookup(rows, saved(repeated, "warc-repeated"), {"digest": "same"})
    revisit = F.col("keeper").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("keeper")))
    return out.select("page_id", "url", "html", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                      F.when(revisit, F.col("keeper")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the archives; return their manifest: path, bytes, records."""
    folder = folder or scratch(pages.sparkSession, "warc")
    manifest = with_types(pages).mapInArrow(_writer(folder), "path string, bytes long, records long")
    return saved(manifest, "warc-manifest")  # written once: holds the files of the tasks that counted


def read_archives(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """Every record of the archives; a file is read by one task."""
    files = manifest.select("path")
    return files.repartition(max(1, files.count())).mapInArrow(_reader(with_payload), READ_SCHEMA)


def round_trip(pages: DataFrame) -> DataFrame:
    read = read_archives(write_archives(pages))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")
