"""WARC archives: a writer for pages and a salvaging reader.

The writer builds records with column functions and lets Spark's text writer
put them on the shared file system, so a lost task is written again by the
commit protocol. Archives are plain by default, so a damaged byte costs the one
record that holds it; a gzip archive of that writer is a single member, whose
records behind the damage are lost. Of records with equal payloads of at least
``REVISIT_MIN_BYTES`` the smallest page_id is a response and the others are
revisits without the payload.

The reader checks each record (version line, header, length, trailer, payload
digest). After a failed check it looks for the next gzip member or version
line that passes, goes on from there and logs the bytes between as a gap. It
reads plain archives, one gzip member for each record, or members that hold
many records; what could be inflated before a damaged byte is read as well.

Defined results: a null html is an empty payload, a null url gives no target
header, a null page_id reads back as null; equal small payloads are all
responses; repeated rows of the response are responses; rows whose group has
no page_id at all are responses; an empty table gives an empty archive; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import bound_batches
from gridloom.session import materialize

#: Payloads below this size are never written as revisits.
REVISIT_MIN_BYTES = 100
#: Bounds the size of an archive, and so the memory of the task that reads it: records at most, and bytes on average.
RECORDS_PER_ARCHIVE = 5000
ARCHIVE_BYTES = 64 << 20

# Names of the WARC format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
GZIP_MAGIC = b"\x1f\x8b\x08"

_VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")


def with_record_types(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload"),
                        F.octet_length(payload).cast("long").alias("payload_bytes"),
                        F.sha2(payload.cast("binary"), 256).alias("payload_digest"))
    first = (rows.filter(F.col("payload_bytes") >= REVISIT_MIN_BYTES)
             .groupBy("payload_digest").agg(F.min("page_id").alias("first_page"), F.count("*").alias("copies"))
             .filter("copies > 1").drop("copies"))
    # Only digests with copies meet the pages again. They are written first, so that Spark knows their bytes: a few are
    # broadcast and no payload is shuffled; with many, a hot digest is split by the skew join.
    first = materialize(first)
    again = F.col("first_page").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_page"))
    return rows.join(first, "payload_digest", "left").select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first_page")).alias("refers_to"))


def _header(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _urn(page_id: str) -> Column:
    return F.concat(F.lit("<urn:page:"), F.col(page_id).cast("string"), F.lit(">"))


def record(revisit: Column) -> Column:
    """The whole record as a string, without its last newline (the writer adds it)."""
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    return F.concat(
        F.lit(f"{VERSION}\r\n"), _header("WARC-Type", F.col("record_type")),
        F.coalesce(_header("WARC-Record-ID", _urn("page_id")), F.lit("")),
        _header("WARC-Target-URI", url), F.lit(f"WARC-Date: {DATE}\r\n"),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        _header("WARC-Payload-Length", F.col("payload_bytes").cast("string")),
        F.when(revisit, F.concat(_header("WARC-Refers-To", _urn("refers_to")),
                                 F.lit(f"WARC-Profile: {REVISIT_PROFILE}\r\n"))).otherwise(F.lit("")),
        F.lit("Content-Type: text/html; charset=utf-8\r\n"),
        _header("Content-Length", F.octet_length(body).cast("string")),
        F.lit("\r\n"), body, F.lit("\r\n\r"))


def write_archives(pages: DataFrame, path: str, compression: str = "none") -> None:
    """One archive per write task, or several of at most ``RECORDS_PER_ARCHIVE`` records and about ``ARCHIVE_BYTES``."""
    mean = pages.agg(F.avg(F.octet_length("html")).alias("n")).first().n or 0.0
    records = int(min(RECORDS_PER_ARCHIVE, max(1, ARCHIVE_BYTES // (mean + 1))))
    (with_record_types(pages).select(record(F.col("record_type") == "revisit").alias("value"))
     .write.option("lineSep", "\n").option("compression", compression)
     .option("maxRecordsPerFile", records).text(path))


@dataclass
class Item:
    """A record, or a quarantined gap with its reason; offsets are those of the archive's bytes.

    Inside a gzip member that holds several records, ``inner`` is the offset in the inflated bytes.
    """

    kind: str
    offset: int
    length: int
    inner: int = 0
    headers: dict[str, str] = field(default_factory=dict)
    payload: bytes = b""
    reason: str = ""


def _parse(data: bytes, at: int) -> tuple[dict[str, str], bytes, int] | str:
    """The record at this offset and its end, or what is wrong with it."""
    line = _VERSION_LINE.match(data, at)
    if not line:
        return "no version line"
    stop = data.find(b"\r\n\r\n", line.end() - 2)
    if stop < 0:
        return "header has no end"
    headers: dict[str, str] = {}
    for raw in data[line.end():stop].split(b"\r\n"):
        name, colon, value = raw.partition(b":")
        if raw and not colon:
            return "bad header line"
        headers[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    size = headers.get("content-length", "")
    if not re.fullmatch("[0-9]{1,18}", size):
        return "bad length"
    body = stop + 4
    end = body + int(size)
    if data[end:end + 4] != b"\r\n\r\n":
        return "bad trailer"
    payload = data[body:end]
    digest = headers.get("warc-payload-digest", "")
    if headers.get("warc-type") != "revisit" and digest.startswith("sha256:") \
            and hashlib.sha256(payload).hexdigest() != digest[7:]:
        return "bad digest"
    return headers, payload, end + 4


def _records(data: bytes, base: int = 0, member: tuple[int, int] | None = None) -> Iterator[Item]:
    """Records of plain bytes. A failed record is skipped up to the next version line that passes."""
    at = gap = 0
    reason = ""

    def place(lo: int, hi: int) -> dict:
        return {"offset": member[0], "length": member[1], "inner": lo} if member else {"offset": base + lo, "length": hi - lo}

    while at < len(data):
        got = _parse(data, at)
        if isinstance(got, str):
            reason = reason or got
            later = _VERSION_LINE.search(data, at + 1)
            at = later.start() if later else len(data)
            continue
        if gap < at:
            yield Item("gap", **place(gap, at), reason=reason)
        headers, payload, end = got
        yield Item("record", **place(at, end), headers=headers, payload=payload)
        at = gap = end
        reason = ""
    if gap < len(data):
        yield Item("gap", **place(gap, len(data)), reason=reason)


def _inflate(data: bytes, at: int) -> tuple[bytes, int, str]:
    """Bytes of the member at this offset, its end, and what is wrong with it."""
    engine = zlib.decompressobj(31)
    out = []
    # Small steps keep what comes before a damaged byte.
    for lo in range(at, len(data), 1 << 14):
        try:
            out.append(engine.decompress(data[lo:lo + (1 << 14)]))
        except zlib.error as error:
            return b"".join(out), at, str(error)
        if engine.eof:
            return b"".join(out), min(lo + (1 << 14), len(data)) - len(engine.unused_data), ""
    return b"".join(out), at, "member has no end"


def read_archive(data: bytes) -> Iterator[Item]:
    """All records of an archive in order, and the gaps between them."""
    at = 0
    while at < len(data):
        if data.startswith(GZIP_MAGIC, at):
            plain, end, wrong = _inflate(data, at)
            if not wrong:
                yield from _records(plain, member=(at, end - at))
                at = end
                continue
            # Whole records before the damage are good; the rest up to the next member is lost.
            for item in _records(plain, member=(at, 0)):
                if item.kind == "record":
                    yield item
            later = _next_start(data, at + 1)
            yield Item("gap", at, later - at, reason=wrong)
            at = later
        elif _VERSION_LINE.match(data, at):
            stop = _next_member(data, at)
            yield from _records(data[at:stop], base=at)
            at = stop
        else:
            later = _next_start(data, at + 1)
            yield Item("gap", at, later - at, reason="no version line")
            at = later


def _next_member(data: bytes, at: int) -> int:
    """Start of the next gzip member that inflates to a record."""
    while (at := data.find(GZIP_MAGIC, at)) >= 0:
        engine = zlib.decompressobj(31)
        try:
            if _VERSION_LINE.match(engine.decompress(data[at:at + 4096], 64)):
                return at
        except zlib.error:
            pass
        at += 1
    return len(data)


def _next_start(data: bytes, at: int) -> int:
    line = _VERSION_LINE.search(data, at)
    return min(line.start() if line else len(data), _next_member(data, at))


def _page(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?[0-9]+)>", urn or "")
    return int(found[1]) if found else None


READ_SCHEMA = ("archive string, offset long, length long, inner long, kind string, reason string, "
               "record_type string, page_id long, url string, payload_bytes long, payload_digest string, "
               "refers_to long, payload binary")


def read_archives(spark: SparkSession, path: str, payloads: bool = True, glob: str = "part-*") -> DataFrame:
    """A row per record (kind ``record``) and per quarantined gap (kind ``gap``)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    schema = to_arrow_schema(_parse_datatype_string(READ_SCHEMA))

    def row(name: str, item: Item) -> dict:
        h = item.headers
        revisit = h.get("warc-type") == "revisit"
        record = item.kind == "record"
        length = h.get("warc-payload-length", "0")
        return {"archive": name, "offset": item.offset, "length": item.length, "inner": item.inner,
                "kind": item.kind, "reason": item.reason or None, "record_type": h.get("warc-type"),
                "page_id": _page(h.get("warc-record-id")), "url": h.get("warc-target-uri"),
                "payload_bytes": (int(length) if revisit else len(item.payload)) if record else None,
                "payload_digest": (h.get("warc-payload-digest", "")[7:] if revisit
                                   else hashlib.sha256(item.payload).hexdigest()) if record else None,
                "refers_to": _page(h.get("warc-refers-to")),
                "payload": item.payload if payloads and record else None}

    def read(batches):
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows: list[dict] = []
                size = 0
                for item in read_archive(data.as_py()):
                    rows.append(row(name, item))
                    size += len(item.payload) if payloads else 0
                    if len(rows) >= 1000 or size >= 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content"))
    return bound_batches(files).mapInArrow(read, READ_SCHEMA)
