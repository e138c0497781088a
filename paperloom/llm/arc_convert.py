"""Legacy archive converter: ARC records, of either version, to equivalent WARC records."""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from base64 import b32decode, b32encode
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm.shared import unused, with_place
from paperloom.scratch import scratch_path

#: Payloads of fewer bytes are never recorded as revisits.
LEAST_REVISIT = 1000
#: Bytes of an archive file, which one task reads whole; a record that is larger has a file of its own.
FILE_BYTES = 32 << 20
#: What Spark's text files put after each value. After a gzip member, a zero byte is padding, which readers skip.
_PADDING = "\0"

#: Fields of a record's header line, for each version that a file's first record may name.
FIELDS = {
    1: ("url", "ip", "date", "type", "length"),
    2: ("url", "ip", "date", "type", "code", "checksum", "location", "offset", "filename", "length"),
}
_NAMES = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}


@dataclass
class ArcRecord:
    """One document of an ARC file: the fields of its header line by name, and its bytes."""

    fields: dict[str, str]
    body: bytes
    offset: int


def write_arc(records: Iterable[tuple[str, str, str, bytes]], version: int, name: str) -> bytes:
    """An ARC file of (url, date as 14 digits, type, body), led by its own description record."""
    head = f"{version} {version - 1} paperloom\n{_NAMES[version]}\n".encode()
    first = {"url": f"filedesc://{name}", "ip": "0.0.0.0", "date": "20000101000000", "type": "text/plain", "code": "200", "checksum": "-", "location": "-", "offset": "0", "filename": name}
    out = bytearray()

    def put(fields: dict[str, str], body: bytes) -> None:
        line = " ".join({**fields, "length": str(len(body)), "offset": str(len(out))}[f] for f in FIELDS[version])
        out.extend(line.encode() + b"\n" + body + b"\n")

    put(first, head)
    for url, date, kind, body in records:
        put({**first, "url": url, "date": date, "type": kind}, body)
    return bytes(out)


def read_arc(data: bytes) -> Iterator[ArcRecord]:
    """The document records of an ARC file.

    The first record tells the version. A header line has that version's fields,
    the last being the length of what follows; lengths are trusted, so that
    bodies may hold anything. Blank lines between records are skipped. A line
    with another number of fields, or a length beyond the file's end, is an
    error.
    """
    version, at = 1, 0
    while at < len(data):
        end = data.find(b"\n", at)
        end = len(data) if end < 0 else end
        line = data[at:end].rstrip(b"\r")
        if not line:
            at = end + 1
            continue
        parts = line.decode("utf-8", "surrogateescape").split(" ")
        described = parts[0].startswith("filedesc://")
        size = int(parts[-1]) if parts[-1].isdigit() else -1
        body = data[end + 1 : end + 1 + size] if size >= 0 else b""
        if described:
            version = int(body.split(b" ", 1)[0])
            if version not in FIELDS:
                raise ValueError(f"ARC version {version} at byte {at}")
        if len(parts) != len(FIELDS[version]) or len(body) != size:
            raise ValueError(f"not an ARC version {version} record at byte {at}")
        if not described:
            yield ArcRecord(dict(zip(FIELDS[version], parts, strict=True)), body, at)
        at = end + 1 + size


def record_id(url: str, date: str, body_digest: str, key: str = "") -> str:
    """A WARC identifier that only depends on the record and its ``key``, so that a repeated run gives the same."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join((url, date, body_digest, key)))}>"


def warc_date(date: str) -> str:
    """An ARC date of 4 to 14 digits as a WARC date; missing or unusable parts become the earliest."""
    digits = "".join(c for c in date if c.isdigit())[:14]
    digits += "19700101000000"[len(digits) :]
    try:
        when = datetime.strptime(digits, "%Y%m%d%H%M%S").replace(tzinfo=timezone.utc)
    except ValueError:
        when = datetime(1970, 1, 1, tzinfo=timezone.utc)
    return when.strftime("%Y-%m-%dT%H:%M:%SZ")


def payload_of(body: bytes) -> tuple[bytes, bytes]:
    """An HTTP response's head (with its blank line) and payload; the head is empty where there is none."""
    if body.startswith(b"HTTP/"):
        end = body.find(b"\r\n\r\n")
        if end >= 0:
            return body[: end + 4], body[end + 4 :]
    return b"", body


def to_warc(record: ArcRecord, extra: dict[str, str], refers_to: dict[str, str] | None = None, key: str = "") -> bytes:
    """The WARC record of an ARC record, without the two line ends that follow it.

    With ``refers_to`` (WARC header fields of the record it repeats) it is a
    revisit and keeps the HTTP head alone.
    """
    head, payload = payload_of(record.body)
    digest = hashlib.sha1(payload).digest()
    block = record.body if refers_to is None else head
    kind = "revisit" if refers_to is not None else "response" if head else "resource"
    fields = {
        "WARC-Type": kind,
        "WARC-Record-ID": record_id(record.fields["url"], record.fields["date"], digest.hex(), key),
        "WARC-Date": warc_date(record.fields["date"]),
        "WARC-Target-URI": record.fields["url"],
        "WARC-IP-Address": record.fields["ip"],
        "WARC-Payload-Digest": "sha1:" + b32encode(digest).decode(),
        "WARC-Block-Digest": "sha1:" + b32encode(hashlib.sha1(block).digest()).decode(),
        **(refers_to or {}),
        **extra,
        "Content-Type": "application/http; msgtype=response" if head else record.fields["type"],
        "Content-Length": str(len(block)),
    }
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    return b"WARC/1.1\r\n" + lines.encode("utf-8", "surrogateescape") + b"\r\n" + block


def read_warc(stream: BinaryIO | bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record; the declared lengths are trusted. One record is in memory at a time."""
    stream = io.BytesIO(stream) if isinstance(stream, bytes) else stream
    while version := stream.readline():
        if not version.startswith(b"WARC/1."):
            raise ValueError("not a WARC record")
        fields: dict[str, str] = {}
        while line := stream.readline().removesuffix(b"\r\n"):
            name, _, value = line.decode("utf-8", "surrogateescape").partition(":")
            fields[name] = value.removeprefix(" ")
        size = int(fields["Content-Length"])
        block = stream.read(size)
        if len(block) != size or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {fields.get('WARC-Record-ID')} ends early")
        yield fields, block


_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n\r\n"


def _clean_url(url: str | None) -> str:
    """A URL without white space or control characters, as a header line needs it."""
    return "".join(c if c > " " and c != "\x7f" else "%" + format(ord(c), "02X") for c in url or "") or "urn:none"


def _arc_date(page_id: int | None) -> str:
    return datetime.fromtimestamp(946_684_800 + abs(page_id or 0) % 600_000_000, timezone.utc).strftime("%Y%m%d%H%M%S")


def _records(rows: list[dict]) -> Iterator[bytes]:
    """Pages to ARC files of both versions, and these to WARC records."""
    for version in (1, 2):
        own = [r for r in rows if (r["page_id"] or 0) % 2 + 1 == version]
        arc = write_arc(((_clean_url(r["url"]), _arc_date(r["page_id"]), "text/html", _HEAD + r["html"]) for r in own), version, "pages.arc")
        for row, record in zip(own, read_arc(arc), strict=True):
            extra = {"X-Page-Id": "" if row["page_id"] is None else str(row["page_id"])}
            extra["X-Payload-Length"] = str(len(row["html"]))
            refers = None
            if row["original"] is not None:
                digest = hashlib.sha1(row["html"]).hexdigest()
                there, date = _clean_url(row["original_url"]), _arc_date(row["original"])
                refers = {
                    "WARC-Refers-To": record_id(there, date, digest, row["original_place"]),
                    "WARC-Refers-To-Target-URI": there,
                    "WARC-Refers-To-Date": warc_date(date),
                    "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                    "X-Refers-To-Page-Id": str(row["original"]),
                }
            yield to_warc(record, extra, refers, row["place"]) + b"\r\n\r\n"


def _convert(batches: Iterator[pa.RecordBatch], file_bytes: int) -> Iterator[pa.RecordBatch]:
    """Archive files: gzip members, one for each record, up to ``file_bytes``."""
    members: list[bytes] = []
    out = lambda: pa.RecordBatch.from_arrays([pa.array([b"".join(members)], pa.binary())], ["archive"])
    for batch in batches:
        for at in range(0, batch.num_rows, 16):
            for record in _records(batch.slice(at, 16).to_pylist()):
                member = gzip.compress(record, 6, mtime=0)
                if members and sum(map(len, members)) + len(member) > file_bytes:
                    yield out()
                    members.clear()
                members.append(member)
    if members:
        yield out()


def _payload(html: Column) -> Column:
    return F.coalesce(html, F.lit("")).cast("binary")


def write_archives(pages: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> None:
    """Write a WARC record for each row of ``pages(page_id, url, html)`` to files under ``path``.

    A file is a sequence of gzip members, one for each record, of about
    ``file_bytes`` at most; Spark gives it a text file's name. Of rows with equal
    payloads of LEAST_REVISIT bytes or more, that with the largest page_id is a
    response and those with smaller ones revisit it; rows that share the largest
    id are responses all. A row without a page_id is a response. Only payloads
    that may be revisits move, to meet the original of their digest.
    """
    placed = with_place(pages, unused(pages.columns, "warc_file"), unused(pages.columns, "warc_row"), "warc-input")
    place = F.concat_ws(":", *[F.col(c).cast("string") for c in placed.columns[-2:]])
    rows = placed.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), _payload(F.col("html")).alias("html"), place.alias("place"))
    able = (F.octet_length("html") >= LEAST_REVISIT) & F.col("page_id").isNotNull()
    keyed = rows.where(able).withColumn("digest", F.sha1("html"))
    one = F.struct("page_id", "url", "place")
    last = keyed.groupBy("digest").agg(F.max(one).alias("o"), F.min("page_id").alias("least"))
    last = last.where("least < o.page_id").select("digest", F.col("o.page_id").alias("original"), F.col("o.url").alias("original_url"), F.col("o.place").alias("original_place"))
    more = ("original", "original_url", "original_place")
    repeats = F.col("original") > F.col("page_id")
    told = keyed.join(last, "digest", "left").select("page_id", "url", "html", "place", *[F.when(repeats, F.col(c)).alias(c) for c in more])
    others = rows.where(~F.coalesce(able, F.lit(False))).select("*", *[F.lit(None).cast("long" if c == "original" else "string").alias(c) for c in more])
    archives = told.unionByName(others).mapInArrow(lambda b: _convert(b, file_bytes), "archive binary").select(F.col("archive").cast("string").alias("value"))
    archives.write.option("lineSep", _PADDING).option("compression", "none").option("maxRecordsPerFile", 1).text(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "target_uri", "warc_date"]
    for batch in batches:
        for content in batch.column("content"):
            rows = []
            for fields, block in read_warc(gzip.GzipFile(fileobj=io.BytesIO(content.as_py()))):
                digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                own = payload_of(block)[1]
                kind = fields["WARC-Type"]
                if kind != "revisit" and b32encode(hashlib.sha1(own).digest()).decode() != digest:
                    raise ValueError(f"damaged payload in {fields['WARC-Record-ID']}")
                number = lambda k: int(fields[k]) if fields.get(k) else None  # noqa: B023, E731
                size = number("X-Payload-Length") if kind == "revisit" else len(own)
                rows.append((number("X-Page-Id"), size, _hex(digest), kind, number("X-Refers-To-Page-Id"), fields["WARC-Record-ID"], fields["WARC-Target-URI"], fields["WARC-Date"]))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
            columns = zip(*rows, strict=True) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)


def _hex(base32: str) -> str:
    return b32decode(base32).hex()


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row for each record of the archives under ``path``; responses' digests are checked."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(_read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, target_uri string, warc_date string")


def convert(pages: DataFrame, path: str | None = None) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to, record_id, target_uri, warc_date)``
    of each row of ``pages``, read back from the archives written under ``path``.

    Null html is an empty payload, and a null url is ``urn:none``. Repeated rows
    have a record each, with its own identifier. Payloads and URLs are kept
    whole, whatever their length. Other columns are ignored; an empty table
    writes no record.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(pages, path)
    return read_archives(spark, path)
