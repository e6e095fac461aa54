"""Image folders in, per-class Parquet cache out.

``read_image_folders`` reads one folder per class with Spark's ``image``
source (decoding happens in the executors; unreadable files are dropped),
takes the class from the folder name, checks every image's shape and each
class's count with aggregates, and rescales pixels to
``(x - depth / 2) / depth``. ``cache_per_class`` writes the decoded arrays
partitioned by class; an existing cache is kept unless forced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_image_folders(spark: SparkSession, root: str, image_size: int = 28,
                       min_per_class: int = 1, pixel_depth: float = 255.0):
    """``read_image_folders``: returns ``(images, stats)``.

    ``images``: ``label, path, pixels`` (grey values rescaled, row-major).
    ``stats``: one row with the count, mean and population std of all pixels.
    Raises when an image has the wrong shape or a class has too few images.
    """
    raw = (spark.read.format("image").option("dropInvalid", True)
           .option("recursiveFileLookup", True).load(root))
    img = raw.select(
        F.regexp_extract("image.origin", r"/([^/]+)/[^/]+$", 1).alias("label"),
        F.col("image.origin").alias("path"), F.col("image.height").alias("h"),
        F.col("image.width").alias("w"), F.col("image.nChannels").alias("c"),
        F.col("image.data").alias("data")).persist(StorageLevel.MEMORY_AND_DISK)  # read and decoded once
    checks = img.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(((F.col("h") != image_size) | (F.col("w") != image_size)).cast("int")).alias("bad"))
    res = checks.collect()  # one row per class
    bad = [r["label"] for r in res if r["bad"]]
    if bad:
        raise ValueError(f"unexpected image shape in classes {bad}")
    few = [r["label"] for r in res if r["n"] < min_per_class]
    if few:
        raise ValueError(f"fewer than {min_per_class} images in classes {few}")

    @F.pandas_udf("array<double>")
    def grey(data: pd.Series, channels: pd.Series) -> pd.Series:
        # the first channel byte of each pixel (OpenCV order)
        return pd.Series([(np.frombuffer(d, dtype=np.uint8)[::c].astype(np.float64) - pixel_depth / 2) / pixel_depth
                          for d, c in zip(data, channels)])

    images = img.select("label", "path", grey("data", "c").alias("pixels"))
    stats = images.select(F.explode("pixels").alias("p")).agg(
        F.count(F.lit(1)).alias("n_pixels"), F.avg("p").alias("mean"), F.stddev_pop("p").alias("std"))
    return images, stats


def cache_per_class(images: DataFrame, path: str, force: bool = False) -> None:
    """``cache_per_class``: Parquet partitioned by class; existing data is
    kept unless ``force``."""
    images.write.mode("overwrite" if force else "ignore").partitionBy("label").parquet(path)
