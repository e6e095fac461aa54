"""Derived fixture frames shared by queries, each with its SQL twin.

The driver's tables have no missing cells and no planted signal, so some
queries read a deterministic derivation (for example, every seventh event's
value set to NULL). Each derivation is written once for Spark and once as
SQL text so the oracle reads exactly the same input.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table


def t(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    return read_table(spark, sf_dir, name, columns)


def events_missing(spark, sf_dir) -> DataFrame:
    """events with NULL values (event_id % 7 = 0), NaN values (% 11 = 0),
    NULL event types (% 13 = 0) and NULL props (% 5 = 0)."""
    e = t(spark, sf_dir, "events")
    eid = F.col("event_id")
    return e.select(
        "event_id", "ts", "user_id",
        F.when(eid % 13 == 0, F.lit(None)).otherwise(F.col("event_type")).alias("event_type"),
        F.when(eid % 7 == 0, F.lit(None).cast("double"))
         .when(eid % 11 == 0, F.lit(float("nan")))
         .otherwise(F.col("value")).alias("value"),
        F.when(eid % 5 == 0, F.lit(None)).otherwise(F.col("props")).alias("props"))


SQL_EVENTS_MISSING = """(SELECT event_id, ts, user_id,
    CASE WHEN event_id % 13 = 0 THEN NULL ELSE event_type END AS event_type,
    CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 11 = 0 THEN CAST('NaN' AS DOUBLE)
         ELSE value END AS value,
    CASE WHEN event_id % 5 = 0 THEN NULL ELSE props END AS props
  FROM events)"""


def events_null(spark, sf_dir) -> DataFrame:
    """events with value NULL on every seventh row (no NaN)."""
    e = t(spark, sf_dir, "events")
    return e.withColumn("value", F.when(F.col("event_id") % 7 == 0, F.lit(None).cast("double"))
                        .otherwise(F.col("value")))


SQL_EVENTS_NULL = """(SELECT event_id, ts, user_id, event_type,
    CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value, props FROM events)"""


def lineitem_label(spark, sf_dir) -> DataFrame:
    """lineitem with a regression label of known coefficients:
    ``y = 3 * l_quantity - 2 * l_discount * 100 + noise(key)``; the noise is
    a keyed integer hash in [-5, 5)."""
    li = t(spark, sf_dir, "lineitem")
    noise = (F.pmod(F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104729
                    + F.col("l_partkey") * 15485863, F.lit(1000)).cast("double") / 100.0) - 5.0
    return li.withColumn("y", 3.0 * F.col("l_quantity") - 200.0 * F.col("l_discount") + noise)


SQL_LINEITEM_LABEL = """(SELECT *, 3.0 * l_quantity - 200.0 * l_discount
    + ((((l_orderkey * 7919 + l_linenumber * 104729 + l_partkey * 15485863) % 1000 + 1000) % 1000)
       / 100.0 - 5.0) AS y FROM lineitem)"""


def doc_scores(spark, sf_dir) -> DataFrame:
    """labels joined with documents plus a deterministic score in [0, 1):
    a made-up classifier output that leans towards the true class."""
    lab = t(spark, sf_dir, "labels")
    doc = t(spark, sf_dir, "documents", ["doc_id", "n_chars", "lang"])
    base = F.pmod(F.col("doc_id") * 2654435761 % 1000003, F.lit(1000)).cast("double") / 1000.0
    score = F.round(0.6 * base + 0.4 * F.col("quality"), 4)
    return lab.join(doc, "doc_id").withColumn("score", score)


SQL_DOC_SCORES = """(SELECT l.doc_id, l.quality, l.toxic, d.n_chars, d.lang,
    round(0.6 * (CAST((((l.doc_id * 2654435761) % 1000003) % 1000 + 1000) % 1000 AS DOUBLE) / 1000.0)
          + 0.4 * l.quality, 4) AS score
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def png_bytes(pixels: np.ndarray) -> bytes:
    """8-bit greyscale PNG of a 2-d uint8 array."""
    h, w = pixels.shape
    raw = b"".join(b"\x00" + pixels[r].tobytes() for r in range(h))

    def chunk(kind, data):
        body = kind + data
        return struct.pack(">I", len(data)) + body + struct.pack(">I", zlib.crc32(body) & 0xFFFFFFFF)

    ihdr = struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)
    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", ihdr) + chunk(b"IDAT", zlib.compress(raw))
            + chunk(b"IEND", b""))


def write_png_folders(df: DataFrame, root: str, label: str, key: str, pixels: str, side: int) -> None:
    """Write each row's ``pixels`` (0-255 values, row-major) as
    ``root/<label>/<key>.png``: by the executors, into whichever file system
    the shared folder is on. A repeated task writes the same bytes again."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri().toString()
    uri = uri.removeprefix("file:")  # a plain path for a mounted folder

    def write(batches):
        store, base = fs.FileSystem.from_uri(uri)
        for p in batches:
            for lab in p[label].unique():
                store.create_dir(f"{base}/{lab}", recursive=True)
            for lab, k, px in zip(p[label], p[key], p[pixels]):
                grey = np.rint(np.clip(np.asarray(px, dtype=np.float64), 0, 255)).astype(np.uint8)
                with store.open_output_stream(f"{base}/{lab}/{k}.png") as out:
                    out.write(png_bytes(grey.reshape(side, side)))
        yield from ()

    df.select(label, key, pixels).mapInPandas(write, "done int").collect()
