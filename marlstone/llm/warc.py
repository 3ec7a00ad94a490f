"""WARC archives: written with revisit records, read by byte ranges.

Writing: one gzip member per record. Which of several equal payloads is stored is decided
on (digest, id) alone; the members then go through Spark's text writer, whose commit
protocol keeps a lost or repeated task from leaving half a file. That writer ends every
row with a separator, so the separator is a NUL byte and a member leaves out its own last
byte where that is NUL (the high byte of its size: any record under 16 MB); behind a larger
record the NUL is padding, which gzip allows between members.

Reading: files are cut into byte ranges. A task scans its range for the gzip magic, takes a
candidate for a record if what it inflates to starts as a WARC header, and owns the
records that start inside its range, reading beyond its end where the last one does.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.common import join_heavy

MAGIC, VERSION, CRLF = b"\x1f\x8b\x08", b"WARC/1.1", b"\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_SCHEMA = "path string, position bigint, record_type string, record_id string, target_uri string, refers_to_id string, payload_bytes bigint, payload_digest string, payload binary"
#: Bytes read at a time; what a task holds beside the record it decodes.
BLOCK = 1 << 20


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(text: str | None) -> bytes:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in text or "").encode()


def record(kind: str, record_id: str, uri: str | None, payload: bytes, digest: str, refers_to: str | None = None, level: int = 4) -> bytes:
    """One gzip member. A revisit carries the response's HTTP head but not its payload."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if kind == "response":
        block += payload
    head = [VERSION, b"WARC-Type: " + kind.encode(), b"WARC-Record-ID: <" + record_id.encode() + b">", b"WARC-Target-URI: " + _uri(uri), b"WARC-Date: 1970-01-01T00:00:00Z", b"WARC-Payload-Digest: sha1:" + digest.encode()]
    if refers_to is not None:
        head += [b"WARC-Profile: " + PROFILE.encode(), b"WARC-Refers-To: <" + refers_to.encode() + b">"]
    head += [b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block), b""]
    deflate = zlib.compressobj(level, zlib.DEFLATED, 31)
    return deflate.compress(CRLF.join(head) + CRLF + block + CRLF * 2) + deflate.flush()


def write(pages: DataFrame, path: str, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html", least_revisit_bytes: int = 0, level: int = 4) -> None:
    """Writes a record per row to ``path``, a new folder that all executors share.

    The payload is the string's UTF-8 (null: empty). Among rows of equal payloads of at
    least ``least_revisit_bytes`` that with the smallest id is the response and the others
    revisit it; smaller payloads are all responses. Rows that repeat the smallest id with
    the same payload are all responses; a null id sorts last, and is a response if no other
    row with that payload has an id. An empty table writes no records.
    """
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{uri_col}`").alias("uri"), F.coalesce(F.col(f"`{payload_col}`"), F.lit("")).alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    # a row per digest and task leaves a task, and the rows of a payload that very many share
    # stay where they are, so such a payload is no burden
    first = rows.where(F.octet_length("payload") >= least_revisit_bytes).groupBy("sha").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    rows = join_heavy(rows, first, ["sha"], "n", "left")

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for id_, uri, payload, sha, first_id in zip(*(batch.column(c).to_pylist() for c in ("id", "uri", "payload", "sha", "first")), strict=True):
                revisit = first_id is not None and id_ != first_id
                data = record("revisit" if revisit else "response", f"urn:record:{'' if id_ is None else id_}", uri, payload.encode(), base64.b32encode(bytes.fromhex(sha)).decode(), f"urn:record:{first_id}" if revisit else None, level)
                out.append(data[:-1] if data[-1] == 0 else data)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])

    rows.mapInArrow(members, "member binary").select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\0").option("compression", "none").text(path)


def _opener(path: str) -> BinaryIO:
    """A file that can be read from any place: local, or of a store that pyarrow knows (s3,
    gs, abfss, hdfs and viewfs where libhdfs is installed)."""
    if path.startswith("file:"):
        from urllib.parse import unquote

        return open("/" + unquote(path[5:]).lstrip("/"), "rb")
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))
    return system.open_input_file(inner)


def _inflate(stream: BinaryIO, at: int, first_of: Callable[[bytes], bool]) -> tuple[bytes, int] | None:
    """The member at ``at`` and the position behind it; None if it isn't one, or if its
    beginning isn't what first_of wants."""
    stream.seek(at)
    inflate, parts, told = zlib.decompressobj(31), [], False
    size, pos = 0, at
    try:
        while not inflate.eof:
            block = stream.read(64 << 10 if pos == at else BLOCK)
            if not block:
                return None
            pos += len(block)
            data = inflate.decompress(block)
            parts.append(data)
            size += len(data)
            if not told and (size >= len(VERSION) or inflate.eof):
                if not first_of(b"".join(parts)):
                    return None
                told = True
    except zlib.error:
        return None
    return b"".join(parts), pos - len(inflate.unused_data)


def _parse(data: bytes) -> dict | None:
    head, mark, body = data.partition(CRLF * 2)
    lines = head.split(CRLF)
    if not mark or not lines[0].startswith(b"WARC/"):
        return None
    fields: dict[bytes, bytes] = {}
    last = b""
    for line in lines[1:]:
        if line[:1] in (b" ", b"\t") and last:  # goes on from the line before
            fields[last] += b" " + line.strip()
            continue
        name, colon, value = line.partition(b":")
        if colon:  # other lines say nothing
            last = name.strip().lower()
            fields[last] = value.strip()
    length = fields.get(b"content-length", b"")
    if not re.fullmatch(rb"[0-9]{1,18}", length) or b"warc-type" not in fields or int(length) > len(body):
        return None
    return fields | {b"block": body[: int(length)]}


def scan_range(stream: BinaryIO, start: int, end: int) -> Iterator[tuple[int, dict]]:
    """Records whose member starts in [start, end), with their positions."""
    at, held, held_at = start, b"", start
    while at < end:
        if not held_at <= at < held_at + len(held) - len(MAGIC) + 1:
            stream.seek(at)
            held, held_at = stream.read(min(BLOCK, end - at + len(MAGIC) - 1)), at
            if len(held) < len(MAGIC):
                return
        found = held.find(MAGIC, at - held_at)
        if found < 0:
            at = held_at + len(held) - len(MAGIC) + 1
            held = b""
            continue
        at = held_at + found
        if at >= end:
            return
        member = _inflate(stream, at, lambda data: data.startswith(b"WARC/"))
        fields = _parse(member[0]) if member else None
        if fields is None:
            at += 1
            continue
        yield at, fields
        at = member[1]


def _strip(value: bytes | None) -> str | None:
    return None if value is None else value.decode("utf-8", "replace").strip("<>")


def _length_of(http: bytes) -> int | None:
    """The Content-Length of an HTTP head; null where it has none or none that is a number
    of at most 18 digits."""
    for line in http.split(CRLF):
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length":
            return int(value) if re.fullmatch(rb"\s*[0-9]{1,18}\s*", value) else None
    return None


def read(spark: SparkSession, path: str, range_bytes: int = 8 << 20, keep_payload: bool = True, most_tasks: int = 100_000) -> DataFrame:
    """One row per record of the archives below ``path`` (see RECORD_SCHEMA): its file and
    position, type, ids, target, and its payload's size and bare base32 SHA-1. The payload
    is what follows the HTTP head, of records without one the whole block. Both are
    computed from it; for a revisit they are what its head says of the full payload, which
    itself is null, as is the size where its head has no number. Header lines without a colon are passed over. Bytes between members are skipped. Files are only
    listed, never read whole; an empty folder gives no rows.
    """
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "length")
    ranges = files.select("path", "length", F.explode(F.sequence(F.lit(0), F.col("length") - 1, F.lit(range_bytes))).alias("start"))
    ranges = ranges.select("path", "start", F.least(F.col("start") + range_bytes, "length").alias("end"))
    # rows this small would be coalesced into one task; a stated number of partitions is not
    ranges = ranges.repartition(max(1, min(ranges.count(), most_tasks)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split(" ")[0] for x in RECORD_SCHEMA.split(", ")]
        types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
        rows: list[tuple] = []
        held = 0

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

        for batch in batches:
            for file, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with _opener(file) as stream:
                    for at, fields in scan_range(stream, start, end):
                        kind = fields[b"warc-type"].decode("utf-8", "replace")
                        http, payload = b"", fields[b"block"]
                        if fields.get(b"content-type", b"").lower().startswith(b"application/http") or kind == "revisit":
                            http, _, payload = payload.partition(CRLF * 2)
                        if kind == "revisit":
                            size = _length_of(http)
                            digest, payload = fields.get(b"warc-payload-digest", b"").decode("utf-8", "replace").removeprefix("sha1:"), None
                        else:
                            size, digest = len(payload), digest32(payload)
                        rows.append((file, at, kind, _strip(fields.get(b"warc-record-id")), _strip(fields.get(b"warc-target-uri")), _strip(fields.get(b"warc-refers-to")), size, digest, payload if keep_payload else None))
                        held += (size or 0) * keep_payload
                        if len(rows) >= 5000 or held > BLOCK * 8:
                            yield batch_of()
                            rows, held = [], 0
        yield batch_of()

    return ranges.mapInArrow(run, RECORD_SCHEMA)


def page_records(records: DataFrame) -> DataFrame:
    """Records written by write(), by page: page_id, payload_bytes, payload_digest,
    record_type, refers_to (the response's id for revisits, else null)."""
    number = lambda c: F.expr(f"cast(nullif(substring_index({c}, ':', -1), '') as bigint)")
    return records.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to_id").alias("refers_to"))
