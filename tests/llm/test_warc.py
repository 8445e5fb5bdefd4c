from __future__ import annotations

import base64
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from snapmart.llm import warc
from tests.llm.spark_fixture import with_clashing_columns

PAGES = "page_id bigint, url string, html string"


def rows_of(df):
    return sorted(map(tuple, df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "status").collect()), key=str)


def expected(pages):
    newest = {}
    for i, _, h in pages:
        if i is not None and len((h or "").encode()) >= 1000:
            newest[h] = max(i, newest.get(h, i))
    out = []
    for i, _, h in pages:
        raw = (h or "").encode()
        to = newest.get(h)
        to = None if to == i else to
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "response" if to is None else "revisit", to, "ok"))
    return sorted(out, key=str)


def planted():
    rnd = random.Random(8)
    long = "é\r\n\r\nWARC/1.1\r\n0\r\n\r\n" * 9000
    pages = [(i, f"http://h/{i}", "".join(rnd.choices("ab\r\né\U0001f600<>", k=rnd.randrange(3000)))) for i in range(60)]
    pages += [(100 + i, "http://x/", "same " * 300) for i in range(5)] + [(110, None, None), (111, "a b\r\nc", ""), (112, "u", long), (113, "u", long)]
    pages += [(114, "u", "s" * 999), (115, "u", "s" * 999), (116, "u", "s" * 1000), (116, "u", "s" * 1000), (7, "again", "another text" * 3000), (None, "n", "same " * 300), (None, None, None)]
    return pages


def test_round_trip(spark):
    pages = planted()
    df = with_clashing_columns(spark.createDataFrame(pages, PAGES)).repartition(3)
    assert rows_of(warc.archive_round_trip(df)) == expected(pages)
    assert rows_of(warc.archive_round_trip(df.limit(0))) == []


def test_payloads_survive(spark, scratch):
    pages = [p for p in planted() if p[0] is not None]
    warc.write_archives(spark.createDataFrame(pages, PAGES), f"{scratch}/w", segment_bytes=700, records_per_file=5)
    got = warc.messages(warc.read_records(spark, f"{scratch}/w")).filter("record_type = 'response'").collect()
    texts = {bytes(r.payload).decode() for r in got}
    assert texts == {h or "" for _, _, h in pages}
    assert {r.status for r in got} == {"ok"}


def test_broken_messages_say_why(spark):
    block = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + warc.chunked(b"some payload", 5)
    digest = "sha1:" + base64.b32encode(hashlib.sha1(b"some payload").digest()).decode()
    third = len(block) // 3
    cut = [block[:third], block[third : 2 * third], block[2 * third :]]

    def segments(name, blocks, total):
        return [(name, "response" if k == 1 else "continuation", None, digest if k == 1 else None, None, k, total if k == 3 else None, b) for k, b in blocks]

    every = list(enumerate(cut, 1))
    rows = segments("good", every[::-1], len(block)) + segments("gap", [every[0], every[2]], len(block))
    rows += segments("short", every, len(block) + 1) + segments("headless", every[1:], len(block)) + segments("endless", every[:2], None)
    rows += [("digest", "response", None, digest[:-1] + "A", None, None, None, block), ("chunk", "response", None, digest, None, None, None, block[:-9]), ("http", "response", None, digest, None, None, None, b"x")]
    got = {r.record_id: r.status for r in warc.messages(spark.createDataFrame(rows, warc._RECORDS)).collect()}
    assert got["good"] == "ok"
    assert got["gap"] == "segments are not 1..n"
    assert got["short"].startswith("total length is")
    assert got["headless"] == "first segment is missing"
    assert got["endless"] == "last segment is missing"
    assert got["chunk"].startswith("chunk") and got["http"] == "no HTTP header" and got["digest"] == "payload digest differs"


def test_framing():
    for payload in (b"", b"x", b"\r\n0\r\n\r\n" * 100):
        assert warc.dechunked(warc.chunked(payload, 7)) == payload
    for bad in (b"", b"zz\r\n", b"5\r\nabc", b"3\r\nabcXX0\r\n\r\n"):
        with pytest.raises(ValueError):
            warc.dechunked(bad)


def test_revisits_by_largest_id(spark):
    pages = spark.createDataFrame([(i, "u", "z" * 1000) for i in range(50)], PAGES)
    got = warc.mark_revisits(pages)
    assert got.filter(F.col("refers_to") == 49).count() == 49
