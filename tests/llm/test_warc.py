"""Archive round trip: original bytes, payloads stored once, tampering found."""

import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from tabula.llm import warc
from tabula.session import shared_path

ROWS = [(3, "http://a/", "<p>x</p>"), (1, "http://b/", "<p>x</p>"), (2, None, None), (5, "http://c/", ""),
        (7, "http://d/ e\r\nf", "é" * 100000), (7, "http://d/ e\r\nf", "é" * 100000), (9, "http://e/", "\r\n\r\nWARC/1.1"),
        (None, "http://f/", "<p>x</p>"), (None, "http://g/", "no id")] + [(100 + i, "http://h/", "hot") for i in range(300)]


def archive(spark, rows, **kw):
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, digest string")
    return warc.write_archive(pages, shared_path(spark, "t-warc"), "page_id", "url", "html", **kw)


def test_records_and_columns(spark):
    path = archive(spark, ROWS)
    got = sorted(map(tuple, warc.read_archive(spark, path).drop("url").collect()), key=repr)
    want = []
    for i, _, html in ROWS:
        data = (html or "").encode()
        ids = [j for j, _, h in ROWS if (h or "") == (html or "") and j is not None]
        first = min(ids) if ids else None
        want.append((i, "response" if i == first else "revisit", len(data),
                     base64.b32encode(hashlib.sha1(data).digest()).decode(), None if i == first else first))
    assert got == sorted(want, key=repr)
    payloads = spark.read.parquet(f"{path}/payloads")
    assert payloads.count() == payloads.select("digest").distinct().count() == len({h or "" for _, _, h in ROWS})


def test_original_bytes_come_back(spark):
    path = archive(spark, ROWS[:6])
    seen = 0
    for r in warc.read_records(spark, path).collect():
        record, header = bytes(r["record"]), bytes(r["header"])
        assert record.startswith(header) and record.endswith(b"\r\n\r\n")
        body = record[len(header):-4]
        if b"WARC-Type: response" in header:
            seen += 1
            assert body.decode() in {h or "" for _, _, h in ROWS}
            assert f"Content-Length: {len(body)}\r\n".encode() in header
        else:
            assert body == b""
    assert seen == 4  # both rows of id 7 are that response


def test_small_payloads_are_never_revisited(spark):
    path = archive(spark, ROWS, min_bytes=4)
    kinds = {r["record_type"] for r in warc.read_archive(spark, path).filter("payload_bytes < 4").collect()}
    assert kinds == {"response"}


def test_changed_payload_is_found(spark):
    path = archive(spark, ROWS[:4])
    bad = spark.read.parquet(f"{path}/payloads").withColumn("digest", F.unhex(F.sha2("digest", 256)))
    headers = spark.read.parquet(f"{path}/headers").withColumn("digest", F.unhex(F.sha2("digest", 256)))
    other = shared_path(spark, "t-warc-bad")
    bad.write.parquet(f"{other}/payloads")
    headers.write.parquet(f"{other}/headers")
    with pytest.raises(Exception, match="does not match its digests"):
        warc.read_records(spark, other).collect()


def test_empty(spark):
    assert warc.read_archive(spark, archive(spark, [])).count() == 0
