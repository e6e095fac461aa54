"""Content-addressed WARC archive.

``write_archive`` keeps two tables in a folder: ``payloads`` holds the bytes
of every distinct payload once, under its SHA-256 (zstandard frames), and
``headers`` holds the exact header bytes of every record with the digest of
its payload. The first record of a payload (smallest id) is a ``response``;
later ones are ``revisit`` records without a body that name it. Payloads
below ``min_bytes`` are never revisited.

``read_records`` joins headers and payloads again, checks the digests of the
bytes, and returns the original records; ``read_archive`` parses those
records into columns.

A payload reaches the shuffle compressed and after a partial aggregate by
digest, so copies travel once per task. Payloads whose SHA-256 agrees but
whose SHA-1 or length differs stop the write.

Defined results: NULL payloads count as empty; NULL ids are written as empty
ids and read back as NULL (such a record is a revisit if any copy has an id);
rows that repeat an id give one record each; an empty table gives an empty
archive; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.llm.common import WS, blocks
from tabula.session import shared_path
from tabula.sources.tables import read_table

CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAYLOADS = "digest binary, frame binary"
HEADERS = "digest binary, body boolean, header binary"


def _base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _facts(rows: DataFrame) -> DataFrame:
    """Digests and length of every payload (the bytes stay behind)."""
    def run(batches):
        for batch in batches:
            data = [(x or "").encode() for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([hashlib.sha256(x).digest() for x in data], pa.binary()),
                 pa.array([_base32_sha1(x) for x in data], pa.string()), pa.array(map(len, data), pa.int64())],
                names=["id", "url", "digest", "sha1", "length"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, url string, digest binary, sha1 string, length long")


def _frames(rows: DataFrame) -> DataFrame:
    """Payloads under their digest; copies inside one block are left out."""
    def run(batches):
        packer = zstandard.ZstdCompressor(level=3)
        for block in blocks(batches, "payload"):
            found = {}
            for x in block.column(0).to_pylist():
                data = (x or "").encode()
                key = hashlib.sha256(data).digest()
                if key not in found:
                    found[key] = packer.compress(data)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.binary())], names=["digest", "frame"])

    return rows.select("payload").mapInArrow(run, PAYLOADS)


def write_archive(records: DataFrame, path: str, id_col: str, url_col: str, payload_col: str,
                  min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> str:
    """Write the archive below ``path`` and return that path."""
    rows = records.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                          F.col(payload_col).cast("string").alias("payload"))
    facts = _facts(rows)
    facts.write.parquet(f"{path}/facts")
    facts = records.sparkSession.read.schema(facts.schema).parquet(f"{path}/facts")
    groups = facts.groupBy("digest").agg(
        F.min("id").alias("first"),
        F.when((F.min("sha1") != F.max("sha1")) | (F.min("length") != F.max("length")),
               F.raise_error(F.lit("payloads differ under one digest"))).alias("differs"))
    named = lambda c: F.concat(F.lit("<urn:x-record:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    whole = F.col("id").eqNullSafe(F.col("first")) | (F.col("length") < min_bytes)
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.when(whole, F.lit("response")).otherwise(F.lit("revisit"))),
        line("WARC-Record-ID", named(F.col("id"))),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", F.regexp_replace("url", WS, "%20")), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(whole, F.lit("")).otherwise(F.concat(line("WARC-Profile", F.lit(PROFILE)),
                                                    line("WARC-Refers-To", named(F.col("first"))))),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(whole, F.col("length")).otherwise(F.lit(0)).cast("string")),
        F.lit(CRLF))
    (facts.join(groups, "digest").filter(F.col("differs").isNull())
     .select("digest", whole.alias("body"), header.cast("binary").alias("header"))
     .write.option("compression", "zstd").parquet(f"{path}/headers"))
    (_frames(rows).groupBy("digest").agg(F.any_value("frame").alias("frame"))
     .write.option("compression", "none").parquet(f"{path}/payloads"))
    return path


def _parse(header: bytes) -> dict[str, str]:
    lines = header.decode().split(CRLF)
    if not lines[0].startswith("WARC/") or lines[-2:] != ["", ""]:
        raise ValueError(f"not a record header: {lines[0][:40]!r}")
    return dict(x.split(": ", 1) for x in lines[1:-2])


def read_records(spark, path: str) -> DataFrame:
    """The original records: ``digest``, ``header`` and the whole ``record``
    bytes (header, body, two line ends), rebuilt by a join and verified."""
    headers = spark.read.schema(HEADERS).parquet(f"{path}/headers")
    payloads = spark.read.schema(PAYLOADS).parquet(f"{path}/payloads")

    def rebuild(batches):
        unpack = zstandard.ZstdDecompressor()
        for block in blocks(batches, "frame", 1 << 20):
            out = []
            for digest, header, frame in zip(*(block.column(k).to_pylist() for k in range(3))):
                body = unpack.decompress(frame)
                fields = _parse(header)
                if hashlib.sha256(body).digest() != digest or len(body) != int(fields["Content-Length"]) or \
                        fields["WARC-Payload-Digest"] != f"sha1:{_base32_sha1(body)}":
                    raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digests")
                out.append(header + body + b"\r\n\r\n")
            yield pa.RecordBatch.from_arrays(
                [block.column(0), block.column(1), pa.array(out, pa.large_binary()).cast(pa.binary())],
                names=["digest", "header", "record"])

    whole = (headers.filter("body").join(payloads, "digest").select("digest", "header", "frame")
             .mapInArrow(rebuild, "digest binary, header binary, record binary"))
    bare = headers.filter("NOT body").select(
        "digest", "header", F.concat("header", F.lit(b"\r\n\r\n")).alias("record"))
    return whole.unionByName(bare)


def read_archive(spark, path: str, id_type: str = "long") -> DataFrame:
    """One row per record: ``id``, ``url``, ``record_type``, ``payload_bytes``,
    ``payload_digest`` (bare base32 SHA-1) and ``refers_to``."""
    def parse(batches):
        for block in blocks(batches, "record", 1 << 20):
            out = []
            for digest, record in zip(block.column(0).to_pylist(), block.column(1).to_pylist()):
                end = record.index(b"\r\n\r\n") + 4
                f = _parse(record[:end])
                name = lambda k: f[k][len("<urn:x-record:"):-1] or None if k in f else None
                out.append((digest, name("WARC-Record-ID"), f.get("WARC-Target-URI"), f["WARC-Type"],
                            len(record) - end - 4, f["WARC-Payload-Digest"].removeprefix("sha1:"),
                            name("WARC-Refers-To")))
            kinds = [pa.binary(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                names=["digest", "id", "url", "record_type", "body_bytes", "payload_digest", "refers_to"])

    schema = ("digest binary, id string, url string, record_type string, body_bytes long, "
              "payload_digest string, refers_to string")
    parsed = read_records(spark, path).select("digest", "record").mapInArrow(parse, schema)
    place = shared_path(spark, "warc-index")
    parsed.write.option("compression", "zstd").parquet(place)
    parsed = spark.read.schema(schema).parquet(place)
    # a revisit's payload is that of the response it refers to
    sizes = (parsed.filter("record_type = 'response'").groupBy("digest")
             .agg(F.max("body_bytes").alias("payload_bytes")))
    return parsed.join(sizes, "digest").select(
        F.col("id").cast(id_type).alias("id"), "url", "record_type", "payload_bytes", "payload_digest",
        F.col("refers_to").cast(id_type).alias("refers_to"))


def op10(spark, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    path = write_archive(pages, shared_path(spark, "warc"), "page_id", "url", "html", min_bytes=0)
    return read_archive(spark, path).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


OP10_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS h,
             min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + CAST((CAST('0x' || substr(h, CAST(5 * (i // 4) + 1 AS INT), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INT),
           1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""
