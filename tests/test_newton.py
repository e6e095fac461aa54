"""Logistic fits by shared Newton steps against Spark ML, fit by fit."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from tabula.operators import models as MD
from tabula.operators.newton import Fit, accuracies, newton, standardised

FEATURES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(7)
    x = rng.standard_normal((1500, 4)) * [1, 5, 0.2, 3] + [0, 10, 1, -2]
    p = 1 / (1 + np.exp(-(0.3 + 1.5 * x[:, 0] - 0.4 * (x[:, 1] - 10) + 2 * (x[:, 2] - 1))))
    rows = [(i, *map(float, r), int(u < q), i % 3) for i, (r, u, q) in enumerate(zip(x, rng.random(1500), p))]
    return spark.createDataFrame(rows, "k long, a double, b double, c double, d double, y int, fold int")


def test_coefficients_equal_spark_ml(frame):
    data = standardised(frame, FEATURES, "y", ["fold"])
    wanted = [([0, 1, 2, 3], None), ([0, 2], "0=1"), ([3], "0=2")]
    fits = newton(data, [Fit(c, g) for c, g in wanted])
    for fit, (columns, group) in zip(fits, wanted):
        rows = data.filter(F.col("fold") != int(group[-1])) if group else data
        model = LogisticRegression(maxIter=200, tol=1e-12).fit(MD.assemble(
            rows.select("y", *[F.col("x")[i].alias(FEATURES[i]) for i in columns]), [FEATURES[i] for i in columns], "y"))
        assert fit.coefs[0] == pytest.approx(model.intercept, abs=1e-6)
        assert fit.coefs[1:] == pytest.approx(model.coefficients.toArray(), abs=1e-6)
    held = accuracies(data, fits)
    assert held[0] > 0.7 and all(0 <= a <= 1 for a in held)


def test_elimination_keeps_the_signal(frame, spark):
    got = MD.rfe_logistic(frame.withColumn("none", F.lit(1.0)), [*FEATURES, "none"], "y", "k", min_features=2, folds=3).collect()
    assert [r["n_features"] for r in got] == [5, 4, 3, 2]
    assert got[1]["features"] == "a,b,c,d" and got[2]["features"] == "a,b,c"
    assert got[2]["accuracy"] > 0.75


def test_separable_classes_end(spark):
    frame = spark.createDataFrame([(i, float(i), float(i % 3), int(i >= 20)) for i in range(40)], "k long, a double, b double, y int")
    got = MD.rfe_logistic(frame, ["a", "b"], "y", "k", min_features=1, folds=2).collect()
    assert got[-1]["features"] == "a" and got[-1]["accuracy"] > 0.9
