"""Operator 8: legacy ARC archives converted to WARC.

The converter reads ARC files of both versions: the version block names the
fields of the header lines that follow (five in version 1, ten in version
2), and each header line declares the length of its document. From these it
synthesises WARC records: ids (a UUID from the digest of the record's
identity, so a retried task writes the same ones), timestamps (14 digits to
ISO), types and digests. Of records with equal payloads of ``REVISIT_BYTES``
and more, the one with the smallest page id is the response; the others are
revisits that refer to it (by record id, and by page id in an extension
field) and carry no payload. Archives begin with a warcinfo record.

A record whose block is an HTTP message becomes a response; any other (a
``dns:`` lookup, a file) a resource with its block as payload and its own
content type. Blocks and payloads are bytes from end to end: a page in
Latin-1 or an image comes out as it went in.

Archives are written through Spark's own text sink (a binary column passes
it unchanged), one archive of about ``ARCHIVE_BYTES`` a file,
gzip-compressed, and read with its binary-file source, so any store that
Spark reaches will do.

Hot payloads: groups are found on (digest, id) with map-side minima, and met
again by a salted join, so a third of all pages being equal loads no task.

Defined cases: a null html is an empty payload; a null url is
``about:blank``; blanks, controls and non-ASCII in urls are percent-encoded;
a null page id is written as an empty field and read back as null (it sorts
last in its group); of repeated rows with the smallest id one is the
response; an empty table gives an empty result; other columns are ignored. A
damaged archive raises an error that names the file and the offset. A page
larger than an archive is an archive of its own; equal payloads tie by the
smallest page id, then by file and place.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REVISIT_BYTES = 100
ARCHIVE_BYTES = 16 << 20
SALTS = 16
CAPTURED = "20240101000000"
UNKNOWN_IP = "0.0.0.0"

#: Header-line fields by ARC version (fixed values of the format).
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = ("url string, date string, ip string, mime string, page_id long, http string, raw binary, payload_bytes long, payload_digest string, "
          "record_id string, file string, at long")


# -- archives as files ------------------------------------------------------

def _write_archives(records: DataFrame, path: str, build: Callable[[Iterator[dict]], Iterator[bytes]]) -> None:
    """Run ``build`` on each partition's rows; it yields whole archives."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for k in range(0, batch.num_rows, 256) for row in batch.slice(k, 256).to_pylist())
        for archive in build(rows):
            # the sink adds the last line break
            yield pa.RecordBatch.from_arrays([pa.array([archive.removesuffix(b"\n")], pa.binary())], ["value"])

    records.mapInArrow(run, "value binary").select(F.col("value").cast("string")).write.option("maxRecordsPerFile", 1).option("compression", "gzip").text(path)


def _read_archives(spark: SparkSession, path: str, parse: Callable[[str, bytes], Iterable[dict]], schema: str) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content")):
                held, size = [], 0
                for row in parse(name.as_py().rsplit("/", 1)[-1], gzip.decompress(content.as_py())):
                    held.append({n: row[n] for n in arrow.names})
                    size += len(row.get("raw") or b"")
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(held, arrow)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, arrow)

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content").mapInArrow(run, schema)


# -- ARC --------------------------------------------------------------------

def _arc_line(version: int, url: str, mime: str, length: int, at: int, name: str, status: str, checksum: str) -> str:
    if version == 1:
        return f"{url} {UNKNOWN_IP} {CAPTURED} {mime} {length}\n"
    return f"{url} {UNKNOWN_IP} {CAPTURED} {mime} {status} {checksum} - {at} {name} {length}\n"


def _arc_start(version: int, name: str) -> str:
    block = f"{version} 0 access-lake\n{ARC_FIELDS[version]}\n"
    return _arc_line(version, f"filedesc://{name}", "text/plain", len(block), 0, name, "200", "-") + block + "\n"


def write_arc(pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write pages (page_id, url, html) as ARC files, versions 1 and 2 in
    turn. The page id travels as a field of the archived HTTP header."""
    def build(rows: Iterator[dict]) -> Iterator[bytes]:
        from pyspark import TaskContext

        part, count = TaskContext.get().partitionId(), 0
        out: list[bytes] = []
        size = 0
        for row in rows:
            if not out:
                version, name = 1 + (part + count) % 2, f"pages-{part:06d}-{count:05d}.arc"
                out.append(_arc_start(version, name).encode())
                size = len(out[0])
            html = (row["html"] or "").encode()
            n = len(html)
            page = "" if row["page_id"] is None else row["page_id"]
            head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\nX-Page-Id: {page}\r\n\r\n"
            url = quote(row["url"], safe="!#$%&'()*+,/:;=?@[]~") if row["url"] else "about:blank"
            line = _arc_line(version, url, "text/html", len(head) + n, size, name, "200", "-")
            out.append(line.encode() + head.encode() + html + b"\n")
            size += len(line) + len(head) + n + 1
            if size >= archive_bytes:
                yield b"".join(out)
                out, count = [], count + 1
        if out:
            yield b"".join(out)

    _write_archives(pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")), path, build)


def parse_arc(name: str, data: bytes) -> Iterator[dict]:
    """Records of one ARC file, by its version's header lines and the
    declared lengths."""
    fields: list[str] = []
    at = 0
    while at < len(data):
        if data[at:at + 1] == b"\n":  # between records
            at += 1
            continue
        end = data.find(b"\n", at)
        # header lines are ASCII; what is not (old urls) is percent-encoded byte by byte
        line = "".join(c if c < "\x80" else f"%{ord(c):02X}" for c in data[at:end if end >= 0 else len(data)].decode("latin-1"))
        if not fields:
            # the version block: its own line ends with its length
            if not line.startswith("filedesc://"):
                raise ValueError(f"{name}: no version block")
            size = int(line.rsplit(" ", 1)[1])
            version, names = data[end + 1:end + 1 + size].decode().split("\n")[:2]
            fields = ARC_FIELDS[int(version.split()[0])].split()
            if names.split() != fields:
                raise ValueError(f"{name}: unknown fields {names!r}")
            at = end + 1 + size
            continue
        values = line.rsplit(" ", len(fields) - 1)
        if end < 0 or len(values) != len(fields) or not values[-1].isdigit():
            raise ValueError(f"{name}: bad header line at {at}")
        record = dict(zip(fields, values))
        start, size = end + 1, int(record["Archive-length"])
        block = data[start:start + size]
        if len(block) < size:
            raise ValueError(f"{name}: the record at {at} is cut short")
        head, payload = http_parts(block)
        digest = hashlib.sha256(payload).hexdigest()
        page = page_of(head)
        identity = hashlib.sha256("\n".join([record["URL"], record["Archive-date"], digest, "" if page is None else str(page), name, str(at)]).encode()).digest()
        yield {"url": record["URL"], "date": record["Archive-date"], "ip": record["IP-address"], "mime": record["Content-type"], "page_id": page,
               "http": head, "raw": payload, "payload": as_text(payload), "payload_bytes": len(payload), "payload_digest": digest,
               "record_id": f"urn:uuid:{uuid.UUID(bytes=identity[:16], version=5)}", "file": name, "at": at}
        at = start + size


def http_parts(block: bytes) -> tuple[str | None, bytes]:
    """(header, payload) of an HTTP message; (None, block) of anything else.
    Header bytes are kept one to one, as Latin-1."""
    if not block.startswith(b"HTTP/"):
        return None, block
    head, _, payload = block.partition(b"\r\n\r\n")
    return head.decode("latin-1"), payload


def page_of(head: str | None) -> int | None:
    page = http_field(head or "", "X-Page-Id")
    return int(page) if page.lstrip("-").isdigit() else None


def as_text(payload: bytes) -> str | None:
    """The payload as text; null where it is not UTF-8."""
    try:
        return payload.decode()
    except UnicodeDecodeError:
        return None


def http_field(head: str, name: str) -> str:
    return next((line.split(":", 1)[1].strip() for line in head.split("\r\n") if line.lower().startswith(name.lower() + ":")), "")


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    return _read_archives(spark, path, parse_arc, RECORD)


# -- WARC -------------------------------------------------------------------

def typed(records: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """Adds ``response_id``, ``response_url`` and ``response_page``: the
    response that a record revisits, else null."""
    identity = F.struct(F.col("page_id").isNull().alias("unnamed"), "page_id", "file", "at", "record_id", "url")
    firsts = (records.filter(F.col("payload_bytes") >= least).groupBy("payload_digest")
              .agg(F.min(identity).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
              .select("payload_digest", F.col("first.record_id").alias("response_id"), F.col("first.url").alias("response_url"), F.col("first.page_id").alias("response_page"),
                      F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    salted = records.withColumn("salt", F.pmod(F.xxhash64("record_id"), F.lit(SALTS)).cast("int"))
    met = salted.join(firsts, ["payload_digest", "salt"], "left")
    own = (F.col("payload_bytes") >= least) & (F.col("response_id") != F.col("record_id"))
    found = {c: F.when(own, F.col(c)) for c in ("response_id", "response_url", "response_page")}
    return met.withColumns(found).drop("salt")


def iso_date(digits: str) -> str:
    d = digits.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_bytes(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", len(block))])
    return f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def warc_record(fields: list[tuple[str, object]], block: str) -> str:
    """A record whose block is text."""
    return warc_bytes(fields, block.encode()).decode()


def _warc_of(row: dict) -> bytes:
    revisit, http = row["response_id"] is not None, row["http"] is not None
    block = (row["http"].encode("latin-1") + b"\r\n\r\n" if http else b"") + (b"" if revisit else row["raw"])
    fields = [("WARC-Type", "revisit" if revisit else "response" if http else "resource"), ("WARC-Target-URI", row["url"]), ("WARC-Date", iso_date(row["date"])),
              ("WARC-Record-ID", f"<{row['record_id']}>"), ("Content-Type", "application/http;msgtype=response" if http else row["mime"]),
              ("WARC-Payload-Digest", f"sha256:{row['payload_digest']}"), ("X-Payload-Length", row["payload_bytes"]),
              ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}")]
    if row["ip"] != UNKNOWN_IP:
        fields.append(("WARC-IP-Address", row["ip"]))
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{row['response_id']}>"), ("WARC-Refers-To-Target-URI", row["response_url"]),
                   ("X-Refers-To-Page-Id", "" if row["response_page"] is None else row["response_page"])]
    return warc_bytes(fields, block)


def write_warc(records: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    def build(rows: Iterator[dict]) -> Iterator[bytes]:
        from pyspark import TaskContext

        part, count = TaskContext.get().partitionId(), 0
        out: list[bytes] = []
        size = 0
        for row in rows:
            if not out:
                # the sink names the file, so the record cannot
                ident = uuid.UUID(bytes=hashlib.sha256(f"{row['record_id']} {part} {count}".encode()).digest()[:16], version=5)
                out, size = [warc_record([("WARC-Type", "warcinfo"), ("WARC-Date", iso_date(row["date"])), ("WARC-Record-ID", f"<urn:uuid:{ident}>"),
                                          ("Content-Type", "application/warc-fields")], "software: access-lake\r\nformat: WARC File Format 1.1\r\n").encode()], 0
            out.append(_warc_of(row))
            size += len(out[-1])
            if size >= archive_bytes:
                yield b"".join(out)
                out, count = [], count + 1
        if out:
            yield b"".join(out)

    _write_archives(records, path, build)


def parse_warc(name: str, data: bytes) -> Iterator[dict]:
    """Response and revisit records of one WARC file; digests are verified."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            raise ValueError(f"{name}: no header end after {at}")
        head = data[at:end].decode("utf-8", "replace")
        if not head.startswith("WARC/"):
            raise ValueError(f"{name}: no record at {at}")
        size = int(http_field(head, "Content-Length"))
        block = data[end + 4:end + 4 + size]
        if data[end + 4 + size:end + 8 + size] != b"\r\n\r\n":
            raise ValueError(f"{name}: the record at {at} does not end where it says")
        kind = http_field(head, "WARC-Type")
        if kind in ("response", "revisit", "resource"):
            http, payload = http_parts(block) if kind != "resource" else (None, block)
            digest = http_field(head, "WARC-Payload-Digest").removeprefix("sha256:")
            n = int(http_field(head, "X-Payload-Length"))
            if kind != "revisit" and (len(payload) != n or hashlib.sha256(payload).hexdigest() != digest):
                raise ValueError(f"{name}: the payload at {at} does not match its digest")
            first = http_field(head, "X-Refers-To-Page-Id")
            yield {"record_id": http_field(head, "WARC-Record-ID").strip("<>"), "record_type": kind, "url": http_field(head, "WARC-Target-URI"),
                   "date": http_field(head, "WARC-Date"), "page_id": page_of(http), "payload_bytes": n, "payload_digest": digest,
                   "refers_to_id": http_field(head, "WARC-Refers-To").strip("<>") or None, "refers_to": int(first) if first else None,
                   "payload": as_text(payload) if kind != "revisit" else None, "raw": payload if kind != "revisit" else None}
        at = end + 8 + size


WARC_ROW = ("record_id string, record_type string, url string, date string, page_id long, payload_bytes long, payload_digest string, "
            "refers_to_id string, refers_to long, payload string, raw binary")


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Records other than warcinfo. ``raw`` is the payload; ``payload`` the
    same as text, null where it is not UTF-8; both are null for revisits."""
    if with_payload:
        return _read_archives(spark, path, parse_warc, WARC_ROW)
    return _read_archives(spark, path, parse_warc, WARC_ROW.split(", payload string", 1)[0])


def convert(spark: SparkSession, arc_path: str, warc_path: str, least: int = REVISIT_BYTES) -> None:
    """Convert all ARC files of a folder to WARC files in another."""
    write_warc(typed(read_arc(spark, arc_path), least), warc_path)
