"""Legacy archives to WARC: ARC files, their parsing, and the WARC records made of them.

An ARC file opens with a version block that names the fields of its header lines (version
1: five, version 2: ten); each record is a header line with a declared length and that
many bytes. Archives are rows with a binary column here, so Spark's own writers and
readers carry them and lost tasks are repeated without leftovers.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow.sources.layers import new_path

# --- fixed values: the header lines and names of the two public formats ---------------------
ARC_FIELDS = {
    1: b"URL IP-address Archive-date Content-type Archive-length",
    2: b"URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
WARC_VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# --------------------------------------------------------------------------------------------

ARCHIVE_BYTES = 4 << 20
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the public namespace of URLs


@dataclass(frozen=True)
class Capture:
    """What pages lack: where and when they were fetched."""

    address: str = "0.0.0.0"
    date: str = "20240101000000"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line_safe(url: str | None) -> str:
    """A URL as one word of a header line; white space is escaped, no URL is a dash."""
    return "".join(f"%{ord(c):02X}" if c.isspace() or ord(c) < 32 else c for c in url or "") or "-"


def arc_archives(pages: DataFrame, capture: Capture = Capture()) -> DataFrame:
    """(archive, content): the pages as ARC files of about ARCHIVE_BYTES, versions taking turns.

    The page number travels as an HTTP header line. Null html is an empty payload.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId(), 0
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            nonlocal held, size, count
            version = 1 + count % 2
            name = f"arc-{part:06d}-{count:05d}.arc"
            intro = b"%d 0 ebbflow\n%s\n" % (version, ARC_FIELDS[version])
            about = f"filedesc://{name} {capture.address} {capture.date} text/plain"
            tail = f" 200 - - 0 {name}" if version == 2 else ""
            parts, at = [f"{about}{tail} {len(intro)}\n".encode() + intro + b"\n"], 0
            at = len(parts[0])
            for url, body in held:
                mid = f" 200 {hashlib.md5(body).hexdigest()} - {at} {name}" if version == 2 else ""
                head = f"{url} {capture.address} {capture.date} text/html{mid} {len(body)}\n".encode()
                parts.append(head + body + b"\n")
                at += len(parts[-1])
            count += 1
            held, size = [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([b"".join(parts)], pa.binary())], names=["archive", "content"]
            )

        for batch in batches:
            for page, url, html in zip(*(c for c in batch.columns)):
                payload = (html.as_py() or "").encode("utf-8")
                number = "" if page.as_py() is None else f"X-Page-Id: {page.as_py()}\r\n"
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{number}Content-Length: {len(payload)}\r\n\r\n"
                held.append((_line_safe(url.as_py()), head.encode() + payload))
                size += len(payload)
                if size >= ARCHIVE_BYTES:
                    yield flush()
        if held:
            yield flush()

    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    return rows.mapInArrow(write, "archive string, content binary")


def parse_arc(content: bytes) -> Iterator[dict]:
    """Records of an ARC file by the header fields of its version and declared lengths."""
    stream = io.BytesIO(content)
    fields: list[str] = []
    while line := stream.readline():
        if line == b"\n":
            continue
        words = line.decode("utf-8").rstrip("\n").split(" ")
        offset = stream.tell() - len(line)
        body = stream.read(int(words[-1]))
        if len(body) < int(words[-1]):
            raise ValueError(f"record at {offset} is shorter than declared")
        if not fields:
            if not words[0].startswith("filedesc://"):
                raise ValueError("an ARC file starts with its version block")
            version = int(body.split(b" ", 1)[0])
            names = body.split(b"\n")[1]
            if ARC_FIELDS.get(version) != names:
                raise ValueError(f"unknown ARC version block {body[:80]!r}")
            fields = names.decode().split(" ")
            continue
        if len(words) != len(fields):
            raise ValueError(f"{len(words)} header fields at {offset}, {len(fields)} expected")
        yield {**dict(zip(fields, words)), "offset": offset, "body": body}


def split_http(body: bytes) -> tuple[bytes, bytes]:
    """HTTP head (with its empty line) and payload; a body without a head is all payload."""
    end = body.find(b"\r\n\r\n")
    return (body[: end + 4], body[end + 4 :]) if body.startswith(b"HTTP/") and end >= 0 else (b"", body)


def _header(head: bytes, name: str) -> str | None:
    for line in head.split(b"\r\n"):
        key, colon, value = line.partition(b":")
        if colon and key.decode("latin-1").lower() == name.lower():
            return value.decode("utf-8").strip()
    return None


def arc_records(archives: DataFrame) -> DataFrame:
    """Parsed ARC records with what a WARC record needs.

    page_id, url, address, date (WARC form), record_id, head, payload, digest. Identifiers
    are derived from the archive, the place in it and the URL, so reruns agree.
    """
    schema = pa.schema(
        [
            ("page_id", pa.int64()),
            ("url", pa.string()),
            ("address", pa.string()),
            ("date", pa.string()),
            ("record_id", pa.string()),
            ("head", pa.binary()),
            ("payload", pa.binary()),
            ("digest", pa.string()),
        ]
    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                rows = []
                for r in parse_arc(content.as_py()):
                    head, payload = split_http(r["body"])
                    number = _header(head, "X-Page-Id")
                    d = r["Archive-date"]
                    place = f"{name.as_py()}#{r['offset']} {r['URL']} {d}"
                    rows.append(
                        {
                            "page_id": None if number is None else int(number),
                            "url": r["URL"],
                            "address": r["IP-address"],
                            "date": f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z",
                            "record_id": f"<urn:uuid:{uuid.uuid5(NAMESPACE, place)}>",
                            "head": head,
                            "payload": payload,
                            "digest": payload_digest(payload),
                        }
                    )
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    kinds = "page_id bigint, url string, address string, date string, record_id string, head binary, payload binary, digest string"
    return archives.mapInArrow(parse, kinds)


def warc_record(r: dict) -> bytes:
    """One WARC record as a gzip member. A revisit keeps the HTTP head and no payload."""
    revisit = r["first_id"] is not None
    block = r["head"] if revisit else r["head"] + r["payload"]
    lines = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", r["record_id"]),
        ("WARC-Date", r["date"]),
        ("WARC-Target-URI", r["url"]),
        ("WARC-IP-Address", r["address"]),
        ("WARC-Payload-Digest", f"sha1:{r['digest']}"),
        ("WARC-Block-Digest", f"sha1:{payload_digest(block)}"),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    if revisit:
        lines += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", r["first_id"]),
            ("WARC-Refers-To-Target-URI", r["first_url"]),
            ("WARC-Refers-To-Date", r["first_date"]),
            ("X-Refers-To-Page-Id", str(r["first_page"])),
        ]
    lines.append(("Content-Length", str(len(block))))
    head = WARC_VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n"
    return gzip.compress(head + block + b"\r\n\r\n", 6, mtime=0)


def convert(archives: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Write the ARC archives as WARC archives (archive, content) to `path`.

    Of records with equal payloads of `least_bytes` or more the one with the smallest page
    number is the response, others revisit it; rows that repeat its number are responses,
    too, and a page without a number is never referred to. Payloads are shuffled once, on
    their digest, against one row for each digest; adaptive execution splits the digest
    of a large group of copies.
    """
    records = arc_records(archives)
    firsts = records.filter("page_id is not null").groupBy("digest").agg(
        F.min(F.struct("page_id", "record_id", "url", "date")).alias("first")
    )
    joined = records.join(firsts, "digest", "left")
    other = (F.col("page_id").isNull() & F.col("first").isNotNull()) | (F.col("page_id") != F.col("first.page_id"))
    repeats = other & (F.octet_length("payload") >= least_bytes)
    first = lambda field: F.when(repeats, F.col(f"first.{field}"))
    rows = joined.select(
        "url",
        "address",
        "date",
        "record_id",
        "head",
        F.when(repeats, F.lit(b"")).otherwise(F.col("payload")).alias("payload"),
        "digest",
        first("record_id").alias("first_id"),
        first("url").alias("first_url"),
        first("date").alias("first_date"),
        first("page_id").alias("first_page"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId(), 0
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            nonlocal held, size, count
            name = f"warc-{part:06d}-{count:05d}.warc.gz"
            info = f"software: ebbflow\r\nformat: {WARC_VERSION.decode()}\r\n".encode()
            head = (
                f"WARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid5(NAMESPACE, name)}>\r\n"
                f"WARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Filename: {name}\r\n"
                f"Content-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n"
            ).encode()
            opening = gzip.compress(WARC_VERSION + b"\r\n" + head + info + b"\r\n\r\n", mtime=0)
            out = pa.array([opening + b"".join(held)], pa.binary())
            count += 1
            held, size = [], 0
            return pa.RecordBatch.from_arrays([pa.array([name]), out], names=["archive", "content"])

        for batch in batches:
            for at in range(batch.num_rows):
                held.append(warc_record(batch.slice(at, 1).to_pylist()[0]))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield flush()
        if held:
            yield flush()

    out = rows.mapInArrow(write, "archive string, content binary")
    out.write.option("compression", "uncompressed").parquet(path)


def parse_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a gzipped archive."""
    with gzip.GzipFile(fileobj=io.BytesIO(content)) as stream:
        while line := stream.readline():
            if line in (b"\r\n", b"\n"):
                continue
            if line.rstrip() != WARC_VERSION:
                raise ValueError(f"no WARC record at {line[:40]!r}")
            headers: dict[str, str] = {}
            while (line := stream.readline().rstrip(b"\r\n")):
                name, _, value = line.decode("utf-8").partition(":")
                headers[name] = value.strip()
            yield headers, stream.read(int(headers["Content-Length"]))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per response or revisit record: page_id, url, payload_bytes, payload_digest,
    record_type, refers_to, record_id.

    Size and digest of a response are taken from its payload, those of a revisit from the
    HTTP head and the declared digest of the full payload.
    """
    schema = pa.schema(
        [
            ("page_id", pa.int64()),
            ("url", pa.string()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
            ("record_id", pa.string()),
        ]
    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for headers, block in parse_warc(content.as_py()):
                    kind = headers["WARC-Type"]
                    if kind not in ("response", "revisit"):
                        continue
                    head, payload = split_http(block)
                    number, refers = _header(head, "X-Page-Id"), headers.get("X-Refers-To-Page-Id")
                    full = kind == "response"
                    digest = payload_digest(payload) if full else headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    size = len(payload) if full else int(_header(head, "Content-Length") or 0)
                    rows.append(
                        {
                            "page_id": None if number is None else int(number),
                            "url": headers["WARC-Target-URI"],
                            "payload_bytes": size,
                            "payload_digest": digest,
                            "record_type": kind,
                            "refers_to": None if refers is None else int(refers),
                            "record_id": headers["WARC-Record-ID"],
                        }
                    )
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    kinds = (
        "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
        "refers_to bigint, record_id string"
    )
    table = spark.read.schema("archive string, content binary").parquet(path)
    return table.select("content").mapInArrow(parse, kinds)


def new_archive_set(spark: SparkSession) -> str:
    return new_path(spark, "warc")
