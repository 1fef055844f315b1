"""WARC archives: a writer with revisit records and a splittable reader.

Every record is a gzip member of its own. The reader turns an archive into byte ranges; a
task searches its range for the gzip magic, takes a place for a member only if its start
decodes to a WARC header, and owns the records that start inside, reading past the end of the
range for the last one. No index is needed and a record of any size has one owner.

Writing: records of equal payload (by SHA-256, at least ``min_bytes`` long) are one response,
of the row with the largest page_id, and revisits that refer to it. Files get unique names and
count only through the manifest, a table Spark commits, so failed or repeated tasks leave no
records. Archives go to the shared folder of the checkpoints.

Rules: a null html is an empty payload; rows tying at the largest page_id are all responses;
a null page_id is written without id and read back as null, and is a response only where its
whole group has no id; line breaks in a url are percent-encoded; a null url gives no target
header; an empty table writes nothing and reads as no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from leaseflow.sources.scratch import materialize, scratch_path

MAGIC = b"\x1f\x8b\x08"
FILE_BYTES, RANGE_BYTES, READ_BYTES = 256 << 20, 8 << 20, 256 << 10
LEVEL = 4
# Fixed values of the WARC format.
VERSION = b"WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:page:"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One uncompressed record; a revisit (``refers_to``) leaves its payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    name = f"{ID_PREFIX}{page_id}" if page_id is not None else f"urn:uuid:{uuid.uuid4()}"
    head = [VERSION.decode(), f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <{name}>", "WARC-Date: 1970-01-01T00:00:00Z",
            f"WARC-Payload-Digest: sha1:{payload_digest(payload)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <{ID_PREFIX}{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def parse(raw: bytes) -> dict:
    """Fields of a record, payload included; a response's digest is computed afresh."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = _headers(head)
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields["warc-type"]

    def page(name: str) -> int | None:
        value = fields.get(name, "").strip("<>")
        return int(value[len(ID_PREFIX):]) if value.startswith(ID_PREFIX) else None

    response = kind == "response"
    return {"page_id": page("warc-record-id"), "url": fields.get("warc-target-uri"),
            "record_type": kind, "refers_to": page("warc-refers-to"),
            "payload_bytes": len(payload) if response else int(_headers(http)["content-length"]),
            "payload_digest": payload_digest(payload) if response
            else fields["warc-payload-digest"].removeprefix("sha1:"),
            "payload": payload if response else None}


# --- writing ------------------------------------------------------------------------------

def _writer(folder: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = fs.FileSystem.from_uri(folder)
        out, path, size, count = None, "", 0, 0
        done: list[tuple[str, int, int]] = []
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "html", "refers_to")]
            for i in range(batch.num_rows):
                page_id, url, html, refers = (c[i].as_py() for c in columns)
                if out is None:
                    where.create_dir(root, recursive=True)
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    path, size, count = f"{folder}/{name}", 0, 0
                    out = where.open_output_stream(f"{root}/{name}", compression=None)
                squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                raw = record(page_id, url, (html or "").encode(), refers)
                member = squeeze.compress(raw) + squeeze.flush()
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= file_bytes:
                    out.close()
                    done.append((path, size, count))
                    out = None
        if out is not None:
            out.close()
            done.append((path, size, count))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)],
                                             ["path", "bytes", "records"])
    return run


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, page_id: str = "page_id",
                   url: str = "url", html: str = "html", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes all rows; returns the stored manifest (path, bytes, records)."""
    rows = pages.select(
        F.col(page_id).cast("bigint").alias("page_id"), F.col(url).alias("url"),
        F.coalesce(F.col(html), F.lit("")).alias("html")).withColumn(
        "digest", F.unhex(F.sha2("html", 256)))
    copied = rows.filter(F.octet_length("html") >= min_bytes).groupBy("digest").agg(
        F.max("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    typed = rows.join(copied.drop("n"), "digest", "left").select(
        "page_id", "url", "html",
        F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")),
               F.col("first")).alias("refers_to"))
    return materialize(typed.mapInArrow(_writer(folder, file_bytes),
                                        "path string, bytes bigint, records bigint"), "manifest")


# --- reading ------------------------------------------------------------------------------

def members(source, size: int, start: int, end: int) -> Iterator[bytes]:
    """Decoded records that start in [start, end) of a seekable source of ``size`` bytes."""
    held, low = bytearray(), start  # bytes from place ``low`` on

    def more() -> bool:
        """Reads on; False at the end of the file."""
        at = low + len(held)
        if at >= size:
            return False
        source.seek(at)
        got = source.read(min(READ_BYTES, size - at))
        held.extend(got)
        return bool(got)

    at = start
    while at < end:
        found = held.find(MAGIC, at - low)
        if found < 0 or low + found >= end:
            if found >= 0 or low + len(held) >= end + len(MAGIC) - 1:
                return
            keep = max(len(held) - len(MAGIC) + 1, at - low, 0)
            del held[:keep]
            low += keep
            at = max(at, low)
            if not more():
                return
            continue
        at = low + found
        del held[:found]
        low = at
        raw, used = _member(held, more)
        if raw is None:
            at += 1
        else:
            yield raw
            at += used


def _member(held: bytearray, more) -> tuple[bytes | None, int]:
    """The record at the start of ``held`` and its compressed length, or (None, 0)."""
    inflate, parts, fed, valid = zlib.decompressobj(31), [], 0, False
    try:
        while not inflate.eof:
            if fed == len(held) and not more():
                return None, 0
            step = bytes(held[fed:fed + READ_BYTES])
            parts.append(inflate.decompress(step))
            fed += len(step)
            if not valid and sum(map(len, parts)) >= len(VERSION):
                if not b"".join(parts).startswith(b"WARC/"):
                    return None, 0
                valid = True
    except zlib.error:
        return None, 0
    raw = b"".join(parts)
    return (raw, fed - len(inflate.unused_data)) if raw.startswith(b"WARC/") else (None, 0)


def _reader(with_payload: bool):
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    if with_payload:
        names, kinds = [*names, "payload"], [*kinds, pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                where, path = fs.FileSystem.from_uri(row["path"])
                rows: list[dict] = []
                held = 0
                with where.open_input_file(path) as source:
                    for raw in members(source, row["bytes"], row["start"], row["end"]):
                        rows.append(parse(raw))
                        held += len(raw)
                        if held > 16 << 20:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True)], names)
                            rows, held = [], 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True)], names)
    return run


def read_archives(spark: SparkSession, manifest: DataFrame, range_bytes: int = RANGE_BYTES,
                  with_payload: bool = False) -> DataFrame:
    """Records of the listed archives (path, bytes): page_id, url, record_type, refers_to,
    payload_bytes, payload_digest and, if asked for, payload (null for revisits)."""
    ranges = manifest.filter("bytes > 0").select("path", "bytes", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.col("bytes") - 1, F.lit(range_bytes).cast("bigint"))).alias("start"))
    ranges = ranges.withColumn("end", F.least(F.col("start") + range_bytes, F.col("bytes")))
    schema = ("page_id bigint, url string, record_type string, refers_to bigint, "
              "payload_bytes bigint, payload_digest string" + ", payload binary" * with_payload)
    return ranges.repartition("path", "start").mapInArrow(_reader(with_payload), schema)


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives in the shared checkpoint folder, as a URI or absolute path."""
    return scratch_path(spark, "warc")
