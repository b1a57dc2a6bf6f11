"""Operator 9: WARC archives, one gzip member per record, written and read sequentially.

Records with equal payloads of at least ``MIN_REVISIT`` bytes are stored once: the record
with the largest page_id is the response, the others are revisits that name it.  Every
task writes its own archives below the shared folder and reports them in a manifest,
which Spark commits; files of lost or repeated attempts are in no manifest and so are
never read.  The reader inflates an archive in small steps, frames each record by its
content length and verifies the digests, so a task holds one record at a time.

Edge cases.  A null html is an empty payload.  A null page_id can be a revisit but never
the record others refer to, unless the whole group has null ids: then all are
responses.  Rows that repeat the largest page_id of a group are all responses.  Null urls
are written as an empty target.  An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.storage import Scratch

MIN_REVISIT = 1000
READERS = 1 << 16  # tasks that read archives, at most
ARCHIVE_BYTES = 64 << 20
STEP = 1 << 16
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_MANIFEST = "path string, records bigint, bytes bigint"
_RECORD = ("page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, "
           "payload_digest string, verified boolean, payload binary")


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _header_value(value: str | None) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in value or "")


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record as a gzip member."""
    block = _HTTP if refers_to is not None else _HTTP + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url}')}>"),
        ("WARC-Target-URI", _header_value(url)),
        ("WARC-Payload-Digest", _sha1(payload)),
        ("WARC-Block-Digest", _sha1(block)),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
        ("X-Page-ID", "" if page_id is None else str(page_id)),
    ]
    if refers_to is not None:
        fields += [("WARC-Profile", _PROFILE), ("X-Refers-To-Page-ID", str(refers_to))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def _writer(root: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = _open(root)
        out, path, records, size = None, "", 0, 0

        def close():
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([records], pa.int64()), pa.array([size], pa.int64())],
                                              names=["path", "records", "bytes"])
        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, html, refers_to = (batch.column(k)[i].as_py() for k in range(4))
                if out is None:
                    files.create_dir(folder, recursive=True)
                    name = f"pages-{uuid.uuid4().hex}.warc.gz"
                    path, out, records, size = f"{root}/{name}", files.open_output_stream(f"{folder}/{name}", compression=None), 0, 0
                data = record_bytes(page_id, url, (html or "").encode(), refers_to)
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= ARCHIVE_BYTES:
                    yield close()
                    out = None
        if out is not None:
            yield close()
    return write


def write_archives(pages: DataFrame, root: str, scratch: Scratch) -> DataFrame:
    """Write (page_id, url, html, refers_to) as archives below ``root``; returns the stored manifest."""
    rows = pages.select("page_id", "url", "html", "refers_to")
    return scratch.store(rows.mapInArrow(_writer(root), _MANIFEST), "manifest")


def members(stream) -> Iterator[bytes]:
    """Contents of the gzip members of a binary stream, inflated step by step."""
    left = b""
    while True:
        inflate, parts = zlib.decompressobj(31), []
        while not inflate.eof:
            data = left or stream.read(STEP)
            left = b""
            if not data:
                if parts:
                    raise ValueError("archive ends inside a record")
                return
            parts.append(inflate.decompress(data))
        left = inflate.unused_data
        yield b"".join(parts)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and the block, framed by its content length."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not found or not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError("content length and record end disagree")
    return fields, rest[:length]


def _number(value: str | None) -> int | None:
    return int(value) if value else None


def _reader(with_payload: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "verified", "payload"]
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.binary()]

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, name = _open(path)
                rows, held = [], 0
                with files.open_input_stream(name, compression=None) as stream:
                    for data in members(stream):
                        fields, block = parse_record(data)
                        kind = fields["warc-type"]
                        ok = fields["warc-block-digest"] == _sha1(block)
                        payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
                        if payload is not None:
                            ok = ok and fields["warc-payload-digest"] == _sha1(payload)
                        digest = base64.b32decode(fields["warc-payload-digest"].partition(":")[2]).hex()
                        rows.append((_number(fields.get("x-page-id")), fields["warc-target-uri"], kind,
                                     _number(fields.get("x-refers-to-page-id")), None if payload is None else len(payload),
                                     digest, ok, payload if with_payload else None))
                        held += len(data) if with_payload else 200
                        if held > 1 << 22:
                            yield out(rows)
                            rows, held = [], 0
                if rows:
                    yield out(rows)
    return read


def read_archives(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """One row per record of the archives in ``manifest``; ``verified`` says that its digests agree.

    The number of archives (which are cut by size; at most ``READERS``) sets that of the tasks: a manifest is small,
    whatever its archives hold, so a number left open would be merged into one task.
    """
    tasks = max(1, min(READERS, manifest.count()))
    return manifest.select("path").repartition(tasks, "path").mapInArrow(_reader(with_payload), _RECORD)


def archive_pages(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write the pages (page_id, url, html) to archives and read them back.

    Returns page_id, payload_bytes, payload_digest, record_type, refers_to, verified.
    """
    scratch = Scratch(pages.sparkSession, "warc")
    pages = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    big = F.octet_length("html") >= min_revisit
    keyed = pages.select("page_id", F.when(big, F.sha2(F.encode("html", "UTF-8"), 256)).alias("same"))
    groups = scratch.store(keyed.where("same is not null").groupBy("same")
                           .agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("keeper"))
                           .where("n > 1 and keeper is not null").select("same", "keeper"), "groups")
    marked = (pages.withColumn("same", F.when(big, F.sha2(F.encode("html", "UTF-8"), 256))).join(groups, "same", "left")
              .withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper"))))
    manifest = write_archives(marked, f"{scratch.root}/archives", scratch)
    records = scratch.store(read_archives(manifest).drop("payload", "url"), "records")
    kept = (records.where("record_type = 'response' and page_id is not null")
            .groupBy("page_id", "payload_digest").agg(F.max("payload_bytes").alias("full_bytes"), F.min("verified").alias("full_ok")))
    targets = scratch.store(kept.join(groups.select(F.col("keeper").alias("page_id")).distinct(), "page_id", "left_semi")
                            .withColumnsRenamed({"page_id": "refers_to"}), "targets")
    return (records.join(targets, ["refers_to", "payload_digest"], "left")
            .select("page_id", F.coalesce("payload_bytes", "full_bytes").alias("payload_bytes"), "payload_digest",
                    "record_type", "refers_to",
                    (F.col("verified") & ((F.col("record_type") == "response") | F.coalesce("full_ok", F.lit(False)))).alias("verified")))
