"""Legacy web archives turned into WARC.

ARC files (versions 1 and 2) are read record by record: a header line whose
fields depend on the version, then as many bytes as it declares. Each record
becomes a WARC record with an identifier, timestamp, type and digests made from
what the ARC record holds. Records whose payload another one already carries
become revisits.

Archives are made of gzip members, one per record, and are written through
Spark's own text writer, so they go to any store Spark can write to and a lost
task leaves nothing behind. The writer ends a file with a separator of our
choice; every archive therefore closes with an empty gzip member, whose last
byte is the NUL that the writer supplies. An archive holds ``archive_bytes`` of
records, or one larger record: no task ever has more than that in memory.

Payloads are shuffled once, compressed; what decides about revisits is a table
of digests.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import partial
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import cut_lineage, scratch_path

ARCHIVE_BYTES = 16 << 20
LEAST_REVISIT_BYTES = 1000
CAPTURED = "20010101000000"
LEVEL = 6

# The header fields of the two ARC versions and the WARC names used.
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"),
}
WARC_VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_URL = "about:blank"
PAGE_HEADER = "X-Page-Id"

# An empty gzip member without its last byte, which is NUL.
_GZIP_END = zlib.compressobj(9, zlib.DEFLATED, 31).flush()[:-1]
_SEPARATOR = "\u0000"


class ArcRecord(NamedTuple):
    offset: int
    url: str
    ip: str
    date: str
    content: bytes
    truncated: bool


# --- archives as bytes -------------------------------------------------------------------------


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def inflate(data: bytes, step: int = 1 << 16) -> bytes:
    """The content of all gzip members; data that is not gzip is returned as it is."""
    if data[:2] != b"\x1f\x8b":
        return data
    view, at, out = memoryview(data), 0, []
    while at < len(view):
        member = zlib.decompressobj(31)
        while not member.eof and at < len(view):
            piece = view[at : at + step]
            out.append(member.decompress(piece))
            at += len(piece) - len(member.unused_data)
        out.append(member.flush())
    return b"".join(out)


def arc_version_block(name: str, version: int) -> bytes:
    body = f"{version} 0 ledgerloom\n{' '.join(ARC_FIELDS[version])}\n".encode()
    values = {"URL": f"filedesc://{name}", "IP-address": "0.0.0.0", "Archive-date": CAPTURED, "Content-type": "text/plain", "Archive-length": str(len(body))}
    return " ".join(values.get(f, "-") for f in ARC_FIELDS[version]).encode() + b"\n" + body


def arc_record(url: str | None, content: bytes, version: int, offset: int, name: str) -> bytes:
    values = {
        "URL": re.sub(r"\s", "%20", url or NO_URL), "IP-address": "0.0.0.0", "Archive-date": CAPTURED, "Content-type": "text/html",
        "Result-code": "200", "Offset": str(offset), "Filename": name, "Archive-length": str(len(content)),
    }
    return b"\n" + " ".join(values.get(f, "-") for f in ARC_FIELDS[version]).encode() + b"\n" + content


def read_arc(data: bytes) -> Iterator[ArcRecord]:
    """Records of an ARC file, plain or gzip. A new version block may come at any place.

    A record that declares more bytes than the file has left is ``truncated``.
    A header line without its version's fields is an error.
    """
    data, at, version = inflate(data), 0, 1
    while True:
        while data[at : at + 1] in (b"\n", b"\r"):
            at += 1
        if at >= len(data):
            return
        end = data.find(b"\n", at)
        end = len(data) if end < 0 else end
        line = data[at:end].decode("utf-8", "replace").rstrip("\r")
        if line.startswith("filedesc://"):
            version = int(data[end + 1 : end + 2] or b"1")
        if version not in ARC_FIELDS:
            raise ValueError(f"ARC version {version} at byte {at}")
        # Only the URL may hold blanks, so fields are counted from the right.
        values = line.rsplit(" ", len(ARC_FIELDS[version]) - 1)
        if len(values) != len(ARC_FIELDS[version]) or not values[-1].isdigit():
            raise ValueError(f"no ARC version {version} header at byte {at}: {line[:80]!r}")
        fields = dict(zip(ARC_FIELDS[version], values))
        length = int(fields["Archive-length"])
        content = data[end + 1 : end + 1 + length]
        if not line.startswith("filedesc://"):
            yield ArcRecord(at, fields["URL"], fields["IP-address"], fields["Archive-date"], content, len(content) < length)
        at = end + 1 + length


def split_http(content: bytes) -> tuple[bytes, bytes]:
    """Head and payload of an HTTP response; what has no status line is all payload."""
    if content.startswith(b"HTTP/"):
        head, blank, payload = content.partition(b"\r\n\r\n")
        return head + blank, payload
    return b"", content


def http_header(head: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^" + re.escape(name.encode()) + rb":[ \t]*([^\r\n]*)", head)
    return found[1].decode("utf-8", "replace") if found else None


def warc_record(headers: Iterable[tuple[str, str]], block: bytes) -> bytes:
    lines = [WARC_VERSION, *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def warc_date(date: str) -> str:
    """ARC dates have 14 digits; shorter ones are filled up, others give the epoch."""
    digits = (date + "19700101000000"[len(date) :])[:14] if date.isdigit() and len(date) >= 4 else "19700101000000"
    return f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}T{digits[8:10]}:{digits[10:12]}:{digits[12:14]}Z"


def digest_text(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def record_id(path: str, offset: int) -> str:
    return uuid.uuid5(uuid.NAMESPACE_URL, f"{path}#{offset}").urn


def read_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record, by declared lengths."""
    data, at = inflate(data), 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = dict(line.split(": ", 1) for line in lines)
        start = end + 4
        stop = start + int(headers["Content-Length"])
        yield headers, data[start:stop]
        at = stop + 4


# --- archives as tables ------------------------------------------------------------------------


def _archives(records: Iterable[bytes], opening, archive_bytes: int) -> Iterator[bytes]:
    """Archives of about ``archive_bytes``. ``records`` get the archive's number and offset when asked."""
    number, held, size = 0, [], 0
    for make in records:
        if not held:
            held, size = [gzip_member(first := opening(number))], len(first)
        raw, member = make(number, size)
        held.append(member)
        size += raw
        if size >= archive_bytes:
            yield b"".join([*held, _GZIP_END])
            number, held, size = number + 1, [], 0
    if held:
        yield b"".join([*held, _GZIP_END])


def _write(archives: DataFrame, path: str) -> str:
    """One file for each row."""
    archives.select(F.col("archive").cast("string")).write.option("lineSep", _SEPARATOR).option("maxRecordsPerFile", 1).text(path)
    return path


def _as_batches(archives: Iterator[bytes]) -> Iterator[pa.RecordBatch]:
    for archive in archives:
        yield pa.RecordBatch.from_arrays([pa.array([archive], pa.binary())], ["archive"])


def write_arc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> str:
    """Store pages as ARC files under ``path``, versions 1 and 2 by turns. Null ids, addresses and bodies are allowed."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        version = lambda number: 1 + number % 2
        name = lambda number: f"{number:06d}.arc.gz"

        def packed(url, content, number, offset):
            record = arc_record(url, content, version(number), offset, name(number))
            return len(record), gzip_member(record)

        def records():
            for batch in batches:
                for page, url, body in zip(*(c.to_pylist() for c in batch.columns)):
                    payload = (body or "").encode()
                    known = "" if page is None else f"{PAGE_HEADER}: {page}\r\n"
                    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{known}Content-Length: {len(payload)}\r\n\r\n"
                    yield partial(packed, url, head.encode() + payload)

        yield from _as_batches(_archives(records(), lambda n: arc_version_block(name(n), version(n)), archive_bytes))

    rows = pages.select(F.col(id_col).cast("bigint"), F.col(url_col).cast("string"), F.col(body_col).cast("string"))
    return _write(rows.mapInArrow(build, "archive binary"), path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def _each_file(files: DataFrame, read, schema: str, rows_at_once: int = 256) -> DataFrame:
    """Rows that ``read(path, bytes)`` yields as tuples, a few at a time."""
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    types = [kinds[c.split()[1]] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pack(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for batch in batches:
            for i in range(batch.num_rows):
                rows, size = [], 0
                for row in read(batch.column(0)[i].as_py(), batch.column(1)[i].as_py()):
                    rows.append(row)
                    size += sum(len(v) for v in row if isinstance(v, bytes))
                    if len(rows) >= rows_at_once or size >= 4 << 20:
                        yield pack(rows)
                        rows, size = [], 0
                if rows:
                    yield pack(rows)

    return files.mapInArrow(run, schema)


def _index_arc(path: str, data: bytes):
    for record in read_arc(data):
        head, payload = split_http(record.content)
        page = http_header(head, PAGE_HEADER)
        yield record_id(path, record.offset), None if page is None else int(page), hashlib.sha1(payload).hexdigest(), len(payload), zlib.crc32(payload)


def _convert_arc(path: str, data: bytes):
    """Both forms a record may take: the finished response, and the head a revisit keeps."""
    for record in read_arc(data):
        head, payload = split_http(record.content)
        identity = record_id(path, record.offset)
        shared = [
            ("WARC-Record-ID", f"<{identity}>"),
            ("WARC-Date", warc_date(record.date)),
            ("WARC-Target-URI", record.url),
            ("WARC-IP-Address", record.ip),
            ("WARC-Payload-Digest", digest_text(hashlib.sha1(payload).digest())),
            ("Content-Type", "application/http;msgtype=response" if head else "application/octet-stream"),
        ]
        kind = "response" if head else "resource"
        extra = [("WARC-Type", kind), ("WARC-Block-Digest", digest_text(hashlib.sha1(record.content).digest()))]
        cut = [("WARC-Truncated", "length")] if record.truncated else []
        full = warc_record([*extra, *shared, *cut], record.content)
        yield identity, "\n".join(f"{k}: {v}" for k, v in shared), head, len(full), gzip_member(full)


def convert(spark: SparkSession, arc_path: str, warc_path: str, least_bytes: int = LEAST_REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> str:
    """Convert the ARC files under ``arc_path`` to WARC files under ``warc_path``.

    Of records with the same payload of at least ``least_bytes`` the one with the
    largest page id is the response (a null id is the smallest; of equal ids, the
    larger record id), and the others become revisits of it.
    """
    index = cut_lineage(_each_file(_files(spark, arc_path), _index_arc, "record string, page bigint, digest string, bytes bigint, crc bigint", 4096))
    payload = ["digest", "bytes", "crc"]
    large = index.filter(F.col("bytes") >= least_bytes)
    kept = large.groupBy(*payload).agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("page", "record")).alias("best")).filter("n > 1")
    kept = cut_lineage(kept.select(*payload, F.col("best.record").alias("response")))
    revisits = large.join(kept, payload).filter(F.col("record") != F.col("response")).select("record", "response")
    both = _each_file(_files(spark, arc_path), _convert_arc, "record string, shared string, head binary, size bigint, response_gz binary", 64)
    decided = both.join(revisits, "record", "left").select(
        "shared", "head", "response", "size", F.when(F.col("response").isNull(), F.col("response_gz")).alias("response_gz")
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def member(shared, head, response, size, gz, *_):
            if response is None:
                return size, gz
            named = [tuple(line.split(": ", 1)) for line in shared.split("\n")]
            block = digest_text(hashlib.sha1(head).digest())
            revisit = [("WARC-Type", "revisit"), ("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{response}>"), ("WARC-Block-Digest", block)]
            record = warc_record([*revisit, *named], head)
            return len(record), gzip_member(record)

        def records():
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns)):
                    yield partial(member, *row)

        def opening(_):
            about = b"software: ledgerloom\r\nformat: WARC File Format 1.1\r\n"
            headers = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<{uuid.uuid4().urn}>"), ("WARC-Date", warc_date(CAPTURED)), ("Content-Type", "application/warc-fields")]
            return warc_record(headers, about)

        yield from _as_batches(_archives(records(), opening, archive_bytes))

    return _write(decided.mapInArrow(build, "archive binary"), warc_path)


def _read_back(path: str, data: bytes):
    for headers, block in read_warc(data):
        kind = headers["WARC-Type"]
        if kind == "warcinfo":
            continue
        head, payload = split_http(block)
        page = http_header(head, PAGE_HEADER)
        digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:"))
        if kind == "revisit":
            size = int(http_header(head, "Content-Length") or 0)
        else:
            size = len(payload)
            if hashlib.sha1(payload).digest() != digest:
                raise ValueError(f"payload digest of {headers['WARC-Record-ID']} does not match")
        refers = headers.get("WARC-Refers-To")
        yield headers["WARC-Record-ID"], None if page is None else int(page), headers["WARC-Target-URI"], size, digest.hex(), kind, refers


def read_back(spark: SparkSession, warc_path: str) -> DataFrame:
    """Records of WARC files: record_id, page_id, url, payload_bytes, payload_digest, record_type, refers_to_record."""
    schema = "record_id string, page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to_record string"
    return _each_file(_files(spark, warc_path), _read_back, schema, 4096)


def pages_through_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", least_bytes: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """Write pages as ARC, convert to WARC, read those back.

    One row per page: page_id, payload_bytes, payload_digest, record_type,
    refers_to (page id of the response, for revisits), url. A null body is an
    empty payload, a null address is ``about:blank``, a null id stays null; of
    rows that repeat in full one is the response. Empty tables give an empty
    result; other columns are not carried.
    """
    spark = pages.sparkSession
    arc = write_arc(pages, scratch_path(spark, "arc"), id_col, url_col, body_col)
    if not _has_files(spark, arc):
        return spark.createDataFrame([], "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string")
    warc = convert(spark, arc, scratch_path(spark, "warc"), least_bytes)
    records = cut_lineage(read_back(spark, warc))
    referred = records.filter("refers_to_record IS NOT NULL").select(F.col("refers_to_record").alias("record_id")).distinct()
    targets = cut_lineage(records.join(referred, "record_id").select(F.col("record_id").alias("refers_to_record"), F.col("page_id").alias("refers_to")))
    return records.join(targets, "refers_to_record", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"
    )


def _has_files(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(hadoop_path)
    return any(not f.getPath().getName().startswith(("_", ".")) for f in files)


#: DuckDB SQL for the query's rows.
SQL = """
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages
), r AS (
  SELECT *, count(*) OVER w AS copies, max(page_id) OVER w AS best FROM p WINDOW w AS (PARTITION BY html)
)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN payload_bytes >= 1000 AND copies > 1 AND page_id <> best THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND copies > 1 AND page_id <> best THEN best END AS refers_to,
       coalesce(url, 'about:blank') AS url
FROM r
"""
