"""WARC archives: writing with revisits and segments, and segment reassembly.

Writing: of equal payloads of at least ``REVISIT_BYTES`` the page with the
largest id is stored as a response, the others as revisits of it. The HTTP
message is framed with chunked transfer coding, cut into segments of
``SEGMENT_BYTES`` (a first record and continuation records) and written as
gzipped archive files of at most ``RECORDS_PER_FILE`` records by Spark's text
writer, whose line separator is the blank lines that end a record.

Reading: each archive file is split into records by their lengths. Whole
records are decoded at once; only segments are shuffled, by the id of their
origin record, and put together in the order of their number. The segments
must be 1..n, the last must state the total length, and the sum must meet it;
then the chunked framing is decoded. A message that fails says why in
``status`` and has no payload; nothing is dropped.

Edge cases: a null html is an empty payload, a null url an empty target; a
null page id is never a response to others; rows that repeat a page id get
records of their own, and of equal payloads all rows with the largest id are
responses. An empty table gives empty archives. Extra columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.llm.common import scratch_path, small_batches, store

REVISIT_BYTES = 1000
SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10
RECORDS_PER_FILE = 4096
#: Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
_END = b"\r\n\r\n"


# -------------------------------------------------------------------- framing


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """``payload`` in chunked transfer coding."""
    parts = [b"%x\r\n%s\r\n" % (len(payload[i : i + size]), payload[i : i + size]) for i in range(0, len(payload), size)]
    return b"".join(parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """Payload of a chunked body; ``ValueError`` if the framing is broken."""
    parts, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        if line < 0:
            raise ValueError("chunk without a size line")
        size_text = body[at:line].split(b";", 1)[0].strip()
        if not re.fullmatch(rb"[0-9a-fA-F]{1,16}", size_text):
            raise ValueError("chunk size is not a number")
        size, at = int(size_text, 16), line + 2
        if size == 0:
            return b"".join(parts)
        if at + size + 2 > len(body) or body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk is cut off")
        parts.append(body[at : at + size])
        at += size + 2


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One record without the blank lines that end it."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return VERSION + b"\r\n" + head.encode() + b"\r\n" + block


def segmented(fields: list[tuple[str, str]], record_id: str, block: bytes, size: int) -> Iterator[bytes]:
    """A record, or its first segment and the continuations."""
    own = ("WARC-Record-ID", f"<{record_id}>")
    if len(block) <= size:
        yield record([own, *fields], block)
        return
    n = -(-len(block) // size)
    yield record([own, *fields, ("WARC-Segment-Number", "1")], block[:size])
    for k in range(2, n + 1):
        more = [
            ("WARC-Record-ID", f"<{record_id}:{k}>"),
            ("WARC-Type", "continuation"),
            ("WARC-Date", DATE),
            ("WARC-Segment-Origin-ID", f"<{record_id}>"),
            ("WARC-Segment-Number", str(k)),
        ]
        if k == n:
            more.append(("WARC-Segment-Total-Length", str(len(block))))
        yield record(more, block[(k - 1) * size : k * size])


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of each record of an archive."""
    at = 0
    while at < len(data):
        head_end = data.find(_END, at)
        if head_end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {at}")
        lines = data[at:head_end].decode("utf-8", "replace").split("\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        start = head_end + len(_END)
        length = int(fields["content-length"])
        if start + length > len(data):
            raise ValueError(f"record at byte {at} is cut off")
        yield fields, data[start : start + length]
        at = start + length + len(_END)


# -------------------------------------------------------------------- writing


def mark_revisits(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, digest, refers_to, repeated`` of every page."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumns({"digest": F.sha1(F.col("html").cast("binary")), "length": F.octet_length("html")})
    long_ones = rows.filter(F.col("length") >= REVISIT_BYTES).groupBy("digest", "length")
    shared = long_ones.agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("refers_to")).filter("n > 1 and refers_to is not null")
    # Written first, so that its size is known when the join is planned.
    shared = store(shared.drop("n"), "warc-shared")
    repeated = store(rows.groupBy("page_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("page_id", F.lit(True).alias("repeated")), "warc-repeated")
    joined = rows.join(shared, ["digest", "length"], "left")
    again = repeated.withColumnRenamed("page_id", "_page")
    joined = joined.join(again, F.col("page_id").eqNullSafe(F.col("_page")), "left")
    other = F.when(~F.col("page_id").eqNullSafe(F.col("refers_to")), F.col("refers_to"))
    return joined.select("page_id", "url", "html", "digest", other.alias("refers_to"), F.coalesce("repeated", F.lit(False)).alias("repeated"))


def write_archives(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write every page as WARC records into archive files below ``path``."""
    small_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, part = 0, TaskContext.get().partitionId()
        for b in batches:
            out = []
            for page_id, url, html, digest, refers_to, repeated in zip(*(c.to_pylist() for c in b.columns), strict=True):
                name = f"urn:page:{'' if page_id is None else page_id}" + (f":{part}-{row}" if repeated or page_id is None else "")
                row += 1
                payload = html.encode()
                fields = [
                    ("WARC-Type", "response" if refers_to is None else "revisit"),
                    ("WARC-Date", DATE),
                    ("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", "", url or "")),
                    ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
                    ("Content-Type", "application/http;msgtype=response"),
                ]
                head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                if refers_to is None:
                    block = (head + "Transfer-Encoding: chunked\r\n\r\n").encode() + chunked(payload)
                else:
                    fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
                    block = (head + f"Content-Length: {len(payload)}\r\n\r\n").encode()
                out.extend(segmented(fields, name, block, segment_bytes))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    records = mark_revisits(pages).mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value"))
    writer = records.write.option("lineSep", _END.decode()).option("compression", "gzip")
    writer.option("maxRecordsPerFile", records_per_file).text(path)


# -------------------------------------------------------------------- reading

_RECORDS = (
    "record_id string, record_type string, target_uri string, payload_digest string, refers_to string, segment int, "
    "total_length bigint, block binary"
)
_ROW_TYPES = [pa.string()] * 5 + [pa.int32(), pa.int64(), pa.binary()]
_BATCH_BYTES = 8 << 20


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives below ``path``; continuations have their origin's id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                data = content.as_py()
                if data[:2] == b"\x1f\x8b":
                    data = gzip.decompress(data)
                rows, held = [], 0
                for f, block in parse(data):
                    rows.append(
                        (
                            f.get("warc-segment-origin-id", f.get("warc-record-id", "")).strip("<>"),
                            f.get("warc-type"),
                            f.get("warc-target-uri"),
                            f.get("warc-payload-digest"),
                            f.get("warc-refers-to", "").strip("<>") or None,
                            int(f["warc-segment-number"]) if "warc-segment-number" in f else None,
                            int(f["warc-segment-total-length"]) if "warc-segment-total-length" in f else None,
                            block,
                        )
                    )
                    held += len(block)
                    if held > _BATCH_BYTES:
                        yield as_batch(rows)
                        rows, held = [], 0
                yield as_batch(rows)

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[]] * 8
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _ROW_TYPES, strict=True)], [c.split()[0] for c in _RECORDS.split(", ")])

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, _RECORDS)


def http_payload(block: bytes, kind: str) -> tuple[bytes, int, str | None]:
    """Payload, its full length and the error of an HTTP message block."""
    head, blank, body = block.partition(_END)
    if not blank:
        return b"", 0, "no HTTP header"
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])}
    if kind == "revisit":
        return b"", int(fields.get("content-length", 0)), None
    if fields.get("transfer-encoding", "").lower() == "chunked":
        try:
            body = dechunked(body)
        except ValueError as e:
            return b"", 0, str(e)
    return body, len(body), None


def joined_segments(rows: list[tuple[int, int | None, bytes]]) -> tuple[bytes, str | None]:
    """Block of ``(segment, total_length, block)`` rows in order, or the error."""
    if [r[0] for r in rows] != list(range(1, len(rows) + 1)):
        return b"", "segments are not 1..n"
    block = b"".join(r[2] for r in rows)
    if rows[-1][1] is None:
        return b"", "last segment is missing"
    if rows[-1][1] != len(block):
        return b"", f"total length is {rows[-1][1]}, segments have {len(block)}"
    return block, None


_MESSAGES = "record_id string, record_type string, target_uri string, payload_digest string, refers_to string, payload binary, payload_bytes bigint, status string"


def messages(records: DataFrame, keep_payload: bool = True) -> DataFrame:
    """One row per record: segments put together, framing decoded, digest verified.

    ``payload_digest`` is the SHA-1 as lower-case hex: of the decoded payload
    for responses, as stated for revisits. ``status`` is ``ok`` or the error.
    """
    names = [c.split()[0] for c in _MESSAGES.split(", ")]
    types = [pa.string()] * 5 + [pa.binary(), pa.int64(), pa.string()]

    def decoded(first: tuple, block: bytes, error: str | None) -> tuple:
        record_id, kind, uri, stated, refers_to = first[:5]
        payload, length = b"", 0
        if error is None:
            payload, length, error = http_payload(block, kind)
        digest = base64.b32decode(stated.removeprefix("sha1:")).hex() if stated else None
        if kind != "revisit" and error is None:
            own = hashlib.sha1(payload, usedforsecurity=False).hexdigest()
            if digest is not None and own != digest:
                error = "payload digest differs"
            digest = own
        failed = error is not None
        return record_id, kind, uri, digest, refers_to, payload if keep_payload and not failed else None, None if failed else length, error or "ok"

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[]] * 8
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield as_batch([decoded(r, r[7], None) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)])

    def together(rows: list[tuple]) -> tuple:
        block, error = joined_segments([r[5:8] for r in rows])
        if rows[0][5] != 1:
            error = "first segment is missing"
        return decoded(rows[0], block, error)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for b in batches:
            out = []
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if held and r[0] != held[0][0]:
                    out.append(together(held))
                    held = []
                held.append(r)
            yield as_batch(out)
        if held:
            yield as_batch([together(held)])

    dealt = records.filter("segment is not null").repartition("record_id").sortWithinPartitions("record_id", "segment")
    return records.filter("segment is null").mapInArrow(whole, _MESSAGES).unionByName(dealt.mapInArrow(parts, _MESSAGES))


def archive_round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write the pages, read the archives back: ``page_id, payload_bytes, payload_digest, record_type, refers_to, status``."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(pages, path)
    # Two plans read the archives (whole records, segments): each parses them.
    read = messages(read_records(spark, path), keep_payload=False)

    def page(name: str) -> F.Column:
        return F.expr(f"try_cast(split_part({name}, ':', 3) as bigint)")

    return read.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"), "status")
