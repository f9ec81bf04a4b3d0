"""WARC archives: one gzip member per record, written by Spark's own file writer and read by byte ranges.

Writing: each task turns pages into gzip members. A member of under 16 MiB ends in a zero byte (the high byte of its length), so the
text writer can put members down with that byte as line separator; a longer one is followed by an empty member, which ends in zeros
too. Files are thus committed by Spark like any other output, and lost executors leave no half-written archive.

Reading: files are cut into byte ranges without looking inside. A task looks for the gzip magic from its range's start, tries to
decode the record header behind each candidate, and owns the records that start inside its range; it reads past the end to finish
the last one. Bytes come through ``pyarrow.fs`` by the file's own URI.

Defined cases: a null html is an empty payload; a null url leaves out the target; a null page id is written as "none", read as null
and is response only where all equal payloads have null ids; pages repeated with the smallest id of their payload are all response;
a damaged member gives one row with ``error`` set, and reading goes on at the next sound member; an empty table or folder gives none.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import scratch, settle, whole_text

MAGIC = b"\x1f\x8b\x08"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
CHUNK = 1 << 20
RECORD = "page_id long, record_type string, target_uri string, refers_to long, payload_digest string, payload_bytes long, file string, offset long, error string"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(value: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", value or "")
    return int(found[1]) if found else None


def encode_record(page_id: int | None, url: str | None, payload: bytes, first: int | None) -> bytes:
    """The gzip member(s) of one record, ending in a zero byte. ``first`` is the page a revisit refers to."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if first is not None else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if first is not None:
        head += [f"WARC-Refers-To: {record_id(first)}", f"WARC-Profile: {REVISIT}"]
    member = _gzip("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")
    return member if member[-1] == 0 else member + _gzip(b"")


def _gzip(data: bytes) -> bytes:
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Write ``pages`` (page_id, url, html). Of equal payloads of ``least_bytes`` or more, the smallest page_id is response."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", whole_text("html").alias("html"))
    digest = F.unhex(F.sha1(F.col("html").cast("binary")))
    firsts = settle(rows.select("page_id", digest.alias("digest")).groupBy("digest").agg(F.min("page_id").alias("first")), "payloads")
    # A payload that a third of all pages share is one key here: both sides are plain scans, which adaptive execution splits.
    linked = rows.withColumn("digest", digest).join(firsts, "digest").select(
        "page_id", "url", F.col("html").cast("binary").alias("payload"),
        F.when((F.octet_length("html") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("first"),
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i) for i in range(4)]
            for at in range(0, batch.num_rows, 256):
                part = [c.slice(at, 256).to_pylist() for c in columns]
                members = [encode_record(*r)[:-1] for r in zip(*part, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], ["value"])

    linked.mapInArrow(encode, "value binary").select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\x00").text(path)


class RangeReader:
    """Bytes of one file by offset, read in chunks."""

    def __init__(self, uri: str):
        store, path = pafs.FileSystem.from_uri("file://" + uri[5:] if re.match("file:/[^/]", uri) else uri)
        self.file = store.open_input_file(path)
        self.size = self.file.size()

    def at(self, offset: int, n: int) -> bytes:
        return self.file.read_at(max(0, min(n, self.size - offset)), offset) if offset < self.size else b""

    def close(self) -> None:
        self.file.close()


def header_at(data: bytes) -> bool | None:
    """Whether a record's member begins ``data``: decodes its header, of any length. None: it decodes so far, more bytes are needed."""
    if data[:3] != MAGIC or len(data) < 4 or data[3] & 0xE0:
        return False
    unzip = zlib.decompressobj(31)
    text, blank = bytearray(), -1
    try:
        while blank < 0 and not unzip.eof and (more := unzip.decompress(unzip.unconsumed_tail if text else data, 1 << 16)):
            text += more
            if not b"WARC/".startswith(text[:5]):
                return False
            blank = text.find(b"\r\n\r\n", max(0, len(text) - len(more) - 3))
    except zlib.error:
        return False
    if blank >= 0:
        return b"\r\nContent-Length:" in text[:blank]
    return False if unzip.eof else None


def next_member(file: RangeReader, at: int, end: int) -> int | None:
    """Offset of the first record in [at, end)."""
    while at < end:
        data = file.at(at, min(CHUNK, end - at) + len(MAGIC) - 1)
        found = data.find(MAGIC)
        while found >= 0:
            need = 2048
            while (good := header_at(file.at(at + found, need))) is None and at + found + need < file.size:
                need *= 4
            if good:
                return at + found
            found = data.find(MAGIC, found + 1)
        at += CHUNK
    return None


def read_member(file: RangeReader, at: int) -> tuple[bytes, int]:
    """The decoded member at ``at`` and the offset behind it."""
    unzip, parts, pos = zlib.decompressobj(31), [], at
    while not unzip.eof:
        data = file.at(pos, CHUNK >> 4)
        if not data:
            raise ValueError("the file ends inside a record")
        parts.append(unzip.decompress(data))
        pos += len(data)
    return b"".join(parts), pos - len(unzip.unused_data)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes, int]:
    """Header fields (lower-case names), payload, and the payload length that the HTTP header states."""
    head, rest = data.split(b"\r\n\r\n", 1)
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])}
    block = rest[: int(fields["content-length"])]
    if len(block) < int(fields["content-length"]):
        raise ValueError("the record is shorter than it states")
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", http)
    return fields, payload, int(stated[1]) if stated else len(payload)


def records_in(uri: str, start: int, end: int) -> Iterator[tuple]:
    """Rows of RECORD, each with the payload behind it, for the records that start in [start, end)."""
    file = RangeReader(uri)
    try:
        at = next_member(file, start, end)
        while at is not None and at < end:
            try:
                data, after = read_member(file, at)
                fields, payload, stated = parse_record(data)
                kind, digest = fields.get("warc-type"), fields.get("warc-payload-digest", "").removeprefix("sha1:")
                error = None
                if kind != "revisit":
                    stated, measured = len(payload), sha1_base32(payload)
                    digest, error = measured, None if digest in ("", measured) else "the payload has another digest than stated"
                yield (
                    page_of(fields.get("warc-record-id")), kind, fields.get("warc-target-uri"), page_of(fields.get("warc-refers-to")), digest, stated,
                    uri, at, error, payload,
                )
            except (zlib.error, ValueError, KeyError) as broken:
                yield None, None, None, None, None, None, uri, at, str(broken), None
                after = at + 1
            if header_at(file.at(after, 2048)):
                at = after
            else:
                at = next_member(file, after, end)
    finally:
        file.close()


def read_archives(spark: SparkSession, path: str, range_bytes: int = 16 << 20, payload: bool = True) -> DataFrame:
    """One row per record of all files below ``path``; ``payload`` adds the payload bytes (empty for revisits)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where("length > 0").select("path", "length")
    ranges = files.select("path", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(range_bytes).cast("bigint"))).alias("start"), "length")
    ranges = ranges.select("path", "start", F.least(F.col("start") + range_bytes, "length").alias("end"))
    tasks = ranges.count()
    schema = RECORD + (", payload binary" if payload else "")
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    names = [x.split()[0] for x in (RECORD + ", payload binary").split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        width = len(names) if payload else len(names) - 1
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], types[i]) for i in range(width)], names[:width])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows, held = [], 0
                for row in records_in(uri, start, end):
                    rows.append(row)
                    held += len(row[-1] or b"") if payload else 0
                    if len(rows) >= 2000 or held > 8 << 20:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return ranges.repartition(max(1, tasks)).mapInArrow(read, schema)


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "archives")
    write_archives(spark.read.parquet(f"{folder}/pages.parquet"), path)
    return read_archives(spark, path, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri", "error")


OP2_SQL = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
h AS (SELECT *, sha1(html) AS d, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((('0x' || substr(d, (5 * (i // 4) + 1)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31), 1)), '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to, url AS target_uri, NULL::VARCHAR AS error
FROM h
"""
