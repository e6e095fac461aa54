"""Robust covariance and the column guard of the detectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabula.operators import anomaly as A


@pytest.mark.parametrize("p,d,want", [(0.5, 1, 0.454936), (0.975, 1, 5.023886), (0.5, 3, 2.365974), (0.975, 3, 9.348404),
                                      (0.975, 10, 20.483177), (0.5, 64, 63.334)])
def test_chi_square_quantile(p, d, want):
    assert A.chi_square_quantile(p, d) == pytest.approx(want, rel=1e-5)


def test_guard_counts_exactly(spark):
    cells = [F.floor(F.rand(i) * 0 + F.col("id") % (30 + i % 2)).cast("double").alias(f"c{i}") for i in range(40)]
    frame = spark.range(4000).select("id", *cells, (F.col("id") * 1.5).alias("many"), F.lit(None).cast("double").alias("none"))
    got = A._wide_features(frame, [f"c{i}" for i in range(40)] + ["many", "none"], 30)
    assert got == [f"c{i}" for i in range(40) if i % 2] + ["many"]


@pytest.mark.parametrize("share,seed", [(0.3, 1), (0.35, 2)])
def test_planted_location_is_found(spark, share, seed):
    """A tight far cluster pulls the mean and the full-sample start along."""
    rng = np.random.default_rng(seed)
    n, d = 3000, 3
    shape = np.array([[2.0, 0.8, 0.0], [0.8, 1.0, 0.3], [0.0, 0.3, 0.5]])
    good = rng.multivariate_normal([10, -5, 1000], shape, int(n * (1 - share)))
    bad = rng.multivariate_normal([22, 9, 1012], 0.05 * np.eye(d), n - len(good))
    x = np.concatenate([good, bad])
    frame = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "k long, a double, b double, c double")
    base = frame.select("k", F.array("a", "b", "c").alias("_x"))
    mean, cov = A.robust_covariance(base, "k", n, d)
    assert np.abs(mean - [10, -5, 1000]).max() < 0.15
    assert np.abs(cov - shape).max() < 0.35
    out = {r["k"]: r["is_outlier"] for r in A.outliers_elliptic(frame, ["a", "b", "c"], "k", share).collect()}
    assert np.mean([out[i] for i in range(len(good), n)]) > 0.98
    assert sum(out.values()) == pytest.approx(share * n, abs=2)


def test_small_and_flat_inputs(spark):
    frame = spark.createDataFrame([(i, float(i), float(i % 37)) for i in range(60)], "k long, a double, b double")
    out = A.outliers_elliptic(frame, ["a", "b"], "k", 0.1)
    assert out.filter("is_outlier").count() in (5, 6)
    line = frame.withColumn("b", F.col("a") * 2)  # no determinant above zero
    assert A.outliers_elliptic(line, ["a", "b"], "k", 0.1).count() == 60
