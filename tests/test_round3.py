"""Stored splits, joint quantile fits, sized lookups, bracketed cuts."""

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from tabula.operators import anomaly, models, text, window
from tabula.operators.sample import split_kfold
from tabula.plans import scale
from tabula.sources import images


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def planned(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def line(spark, rows=300):
    return spark.range(rows).select("id", (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 11 + 3 * (F.col("id") % 7)).cast("double").alias("y"))


def test_holdout_parts_read_a_stored_split(spark):
    train, test = models.holdout(line(spark), "id")
    assert "InMemoryRelation" in plan(train) and "InMemoryRelation" in plan(test)
    assert (train.count(), test.count()) == (210, 90)


def test_folds_score_as_the_cross_validator(spark):
    data = models.assemble(line(spark), ["x"], "y", ["id"])
    est, ev = LinearRegression(), RegressionEvaluator(metricName="rmse")
    grid = ParamGridBuilder().addGrid(est.regParam, [0.0, 5.0]).build()
    model, got = models.cross_validate(est, data, ev, "id", 3, grid=grid)
    folded = split_kfold(data, "id", 3, 46).withColumnRenamed("fold", "_fold")
    want = CrossValidator(estimator=est, estimatorParamMaps=grid, evaluator=ev, foldCol="_fold", numFolds=3).fit(folded.drop("id"))
    assert model.avgMetrics == pytest.approx(want.avgMetrics) and model.stdMetrics == pytest.approx(want.stdMetrics)
    assert model.bestModel.coefficients[0] == pytest.approx(want.bestModel.coefficients[0])
    assert got.count() == 2


def test_a_fold_without_rows_is_an_error(spark):
    data = models.assemble(line(spark), ["x"], "y").withColumn("part", F.lit(0))
    with pytest.raises(ValueError):
        models.cross_validate(LinearRegression(), data, RegressionEvaluator(), "part", 3, fold_col="part")


def test_quantiles_are_fitted_in_the_same_scans(spark, monkeypatch):
    data = models.assemble(line(spark), ["x"], "y")
    alone = [models.quantile_fit(data, tau) for tau in (0.1, 0.9)]
    scans, once = [], models.one_row
    monkeypatch.setattr(models, "one_row", lambda *a: scans.append(1) or once(*a))
    both = models.quantile_fits(data, [0.1, 0.9])
    for (b1, l1), (b2, l2) in zip(alone, both):
        assert b1 == pytest.approx(b2) and l1 == pytest.approx(l2)
    together = len(scans)
    scans.clear()
    for tau in (0.1, 0.9):
        models.quantile_fit(data, tau)
    assert together < len(scans)


def test_few_groups_do_not_move_the_rows(spark):
    rows = spark.range(3_000_000).select("id", (F.col("id") % 3).alias("g"), F.lit(1.0).alias("v"))
    out = window.share_of_group(rows, "v", "g")
    assert "BroadcastHashJoin" in planned(out)
    assert out.filter("abs(v_share - 1e-6) > 1e-12").count() == 0


def test_weights_of_few_words_move_texts_once(spark):
    docs = spark.createDataFrame([(1, "one two two"), (1, "two"), (2, "one"), (3, None)], "d long, t string")
    out = text.tfidf(docs, "d", "t")
    # the counts are stored by document: no exchange of them after that
    top = out._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
    assert "Exchange hashpartitioning" not in top.replace("BroadcastExchange", "")
    got = {(r["d"], r["term"]): r["tfidf"] for r in out.collect()}
    idf = np.log(3 / np.array([2, 1])) + 1
    w = idf * [1, 3]
    assert got[1, "two"] == pytest.approx(w[1] / np.sqrt((w * w).sum())) and got[2, "one"] == pytest.approx(1.0)
    assert len(got) == 3


def test_bracketed_quantile_is_exact(spark, monkeypatch):
    monkeypatch.setattr(scale, "BRACKET_ROWS", 1000)
    frames = {"spread": F.hash("id").cast("double"), "ties": (F.col("id") % 5).cast("double"),
              "hot": F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.rand(3))}
    for name, value in frames.items():
        df = spark.range(20_001).select(value.alias("v")).checkpoint()
        for p in (0.0, 0.123, 0.5, 0.9999, 1.0):
            assert scale.bracketed_quantile(df, "v", p) == scale.quantiles(df, "v", [p])[0], (name, p)
    assert scale.bracketed_quantile(spark.createDataFrame([], "v double"), "v", 0.5) is None


def test_one_slice_is_spread_and_small_frames_are_not(spark, monkeypatch):
    monkeypatch.setattr(scale, "SPREAD_ROWS", 100)
    df = spark.range(0, 1000, 1, 1)
    assert scale.spread(df, 1000).rdd.getNumPartitions() > 1
    assert scale.spread(df, 50).rdd.getNumPartitions() == 1


def test_leaf_sizes_are_measured_once_a_node(monkeypatch):
    calls, c = [], anomaly._c
    monkeypatch.setattr(anomaly, "_c", lambda n: calls.append(n) or c(n))
    tree = tuple(map(np.array, ([0, -1, -1], [0.5, 0.0, 0.0], [1, -1, -1], [2, -1, -1], [5, 3, 2])))
    got = anomaly._path_lengths(np.array([[0.0], [1.0]] * 50), tree)
    assert len(calls) <= 3
    assert got.tolist() == [1 + c(3), 1 + c(2)] * 50


def test_cells_survive_slices_and_missing_entries(spark):
    df = spark.createDataFrame([(i, [float(i), None if i == 3 else 1.0]) for i in range(9)], "k long, _x array<double>")
    n, mean, cov = anomaly._moments(df, 2, F.col("k") > 4)
    assert n == 4 and mean.tolist() == [6.5, 1.0] and cov[0, 0] == pytest.approx(1.25)


def test_images_are_decoded_once(spark, tmp_path):
    from tabula.plans.fixtures import png_bytes
    for label in ("0", "1"):
        (tmp_path / label).mkdir()
        for i in range(3):
            (tmp_path / label / f"{i}.png").write_bytes(png_bytes(np.full((8, 8), 40 * i, np.uint8)))
    found, _ = images.read_image_folders(spark, str(tmp_path), image_size=8)
    assert "InMemoryRelation" in plan(found)
    assert found.count() == 6
