"""Registered queries: scalar/array functions and JSON sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..sources import json_io as J
from .fixtures import t
from .registry import query

# The class names of the digit labels 0-9.
DIGIT_NAMES = ["zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine"]


@query("one_hot_array", """
SELECT vec_id, list_transform(range(0, 10), lambda i: CAST(i = label AS INTEGER)) AS one_hot
FROM embeddings""")
def q_one_hot_array(spark, sf):
    e = t(spark, sf, "embeddings", ["vec_id", "label"])
    return e.select("vec_id", S.one_hot_array("label", 10).alias("one_hot"))


@query("rescale_array", """
SELECT vec_id, list_transform(embedding, lambda x: (CAST(x AS DOUBLE) - 127.5) / 255.0) AS scaled
FROM embeddings""")
def q_rescale_array(spark, sf):
    e = t(spark, sf, "embeddings", ["vec_id", "embedding"])
    return e.select("vec_id", S.rescale_array("embedding", 127.5, 255.0).alias("scaled"))


@query("label_map_lookup", "SELECT vec_id, label, (" + "[" + ", ".join(f"'{n}'" for n in DIGIT_NAMES)
       + "])[label + 1] AS class_name FROM embeddings")
def q_label_map_lookup(spark, sf):
    e = t(spark, sf, "embeddings", ["vec_id", "label"])
    return e.select("vec_id", "label",
                    S.label_map("label", dict(enumerate(DIGIT_NAMES))).alias("class_name"))


@query("threshold_flag", "SELECT event_id, CAST(value > 50 AS INTEGER) AS flag FROM events")
def q_threshold_flag(spark, sf):
    e = t(spark, sf, "events", ["event_id", "value"])
    return e.select("event_id", S.threshold_flag("value", 50).alias("flag"))


@query("read_split_json", """
SELECT n_regionkey, CAST(n_nationkey AS BIGINT) AS "index", n_nationkey, n_name FROM nation""")
def q_read_split_json(spark, sf):
    n = t(spark, sf, "nation")
    docs = J.to_split_json(n, "n_regionkey", ["n_nationkey", "n_name"], "n_nationkey")
    return J.read_split_json(docs, "payload", [("n_nationkey", "int"), ("n_name", "string")],
                             keep=["n_regionkey"])


@query("write_records_json", """
SELECT event_id, to_json({'event_id': event_id, 'event_type': event_type, 'user_id': user_id})
  AS record FROM events""")
def q_write_records_json(spark, sf):
    e = t(spark, sf, "events", ["event_id", "event_type", "user_id"])
    return J.records_json(e, ["event_id", "event_type", "user_id"]).select("event_id", "record")


@query("read_json_props", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def q_read_json_props(spark, sf):
    e = t(spark, sf, "events", ["event_id", "props"])
    return e.select("event_id", F.from_json("props", "k INT")["k"].alias("k"))


def _image_root(spark, sf):
    """8 x 8 grey images derived from the embeddings (first 64 values mapped
    to 0-255), one folder per label, written by the executors."""
    from ..session import shared_path
    from .fixtures import write_png_folders
    e = t(spark, sf, "embeddings")
    px = F.transform("embedding", lambda x: F.floor(F.least(F.greatest(
        (x.cast("double") + 1.0) * 127.5, F.lit(0.0)), F.lit(255.0))))
    root = shared_path(spark, "images")
    write_png_folders(e.select("vec_id", "label", px.alias("px")), root, "label", "vec_id", "px", 8)
    return root


_IMG_SQL = """
SELECT CAST(label AS VARCHAR) AS label, count(DISTINCT vec_id) AS n_images,
  round(avg((floor(least(greatest((CAST(x AS DOUBLE) + 1.0) * 127.5, 0.0), 255.0)) - 127.5) / 255.0), 9)
    AS mean_pixel
FROM (SELECT vec_id, label, unnest(embedding) AS x FROM embeddings) GROUP BY label"""


@query("read_image_folders", _IMG_SQL)
def q_read_image_folders(spark, sf):
    from ..sources.images import read_image_folders
    images, _ = read_image_folders(spark, _image_root(spark, sf), image_size=8, min_per_class=10)
    return images.select("label", "path", F.explode("pixels").alias("p")).groupBy("label").agg(
        F.count_distinct("path").alias("n_images"), F.round(F.avg("p"), 9).alias("mean_pixel"))


@query("cache_per_class", """
SELECT label, count(*) AS n_images FROM embeddings GROUP BY label""")
def q_cache_per_class(spark, sf):
    from ..session import shared_path
    from ..sources.images import cache_per_class, read_image_folders
    images, _ = read_image_folders(spark, _image_root(spark, sf), image_size=8)
    path = shared_path(spark, "image-cache")
    cache_per_class(images, path)
    cache_per_class(images.limit(0), path)  # present: kept, not rewritten
    back = spark.read.parquet(path)
    return back.groupBy(F.col("label").cast("int").alias("label")).agg(
        F.count(F.lit(1)).alias("n_images"))
