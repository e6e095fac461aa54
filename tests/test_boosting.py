"""Quantile boosting: loss, coverage and stopping."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabula.operators import models as MD
from tabula.operators.boosting import boost_quantile, pinball


@pytest.fixture(scope="module")
def wave(spark):
    rng = np.random.default_rng(3)
    a, b = rng.uniform(-3, 3, 6000), rng.uniform(0, 1, 6000)
    y = 4 * np.sin(2 * a) + (0.3 + np.abs(a)) * rng.standard_normal(6000)
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(zip(a, b, y))], "k long, a double, b double, y double")


def test_beats_the_linear_bounds_and_covers(wave):
    train, test = MD.holdout(wave, "k")
    boosted = MD.intervals_quantile_boosted(train, test, ["a", "b"], "y", "k", 0.9, keep=["k", "y"], rounds=30, learning_rate=0.3)
    linear = MD.intervals_quantile(train, test, ["a", "b"], "y", 0.9, keep=["k", "y"])
    loss = {}
    for name, out in (("boosted", boosted), ("linear", linear)):
        r = out.agg(F.avg(pinball(F.col("y"), F.col("lower_PI"), 0.05) + pinball(F.col("y"), F.col("upper_PI"), 0.95)).alias("loss"),
                    F.avg(((F.col("y") >= F.col("lower_PI")) & (F.col("y") <= F.col("upper_PI"))).cast("double")).alias("cover")).first()
        loss[name] = r["loss"]
        if name == "boosted":
            assert r["cover"] == pytest.approx(0.9, abs=0.03)
    assert loss["boosted"] < 0.9 * loss["linear"]


def test_stops_where_the_history_says_and_resumes(wave):
    data = MD.assemble(wave.withColumn("held", F.col("k") % 4 == 0), ["a", "b"], "y", ["held"])
    model = boost_quantile(data, 0.5, rounds=25, learning_rate=1.0, validation=F.col("held"), patience=3, min_gain=0.002)
    held = [h for _, h in model.history]
    best, at, since, stopped = None, 0, 0, len(held)
    start = data.filter("held").agg(F.avg(pinball(F.col("label"), F.lit(model.start), 0.5))).first()[0]
    best = start
    for i, h in enumerate(held):
        if h < best * (1 - 0.002):
            best, at, since = h, i + 1, 0
        else:
            since += 1
            if since == 3:
                stopped = i + 1
                break
    assert len(model.stages) == at and len(held) == stopped
    on = boost_quantile(data, 0.5, rounds=2, learning_rate=0.1, validation=F.col("held"), resume=model)
    assert on.stages[:at] == model.stages and len(on.history) == len(held) + 2


def test_empty_and_constant(spark):
    none = MD.assemble(spark.createDataFrame([], "a double, y double"), ["a"], "y")
    assert boost_quantile(none, 0.5).stages == []
    flat = MD.assemble(spark.createDataFrame([(float(i), 2.0) for i in range(30)], "a double, y double"), ["a"], "y")
    model = boost_quantile(flat, 0.9, rounds=2)
    assert model.start == 2.0 and all(s == 0 for _, steps in model.stages for s in steps)
