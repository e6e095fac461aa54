"""Kernel models over random Fourier features, k-NN predictions, leaderboards."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabula.operators import kernel as K
from tabula.operators import models as MD
from tabula.session import shared_path


def _frame(spark, x, y):
    pdf = pd.DataFrame({f"x{i}": x[:, i] for i in range(x.shape[1])}).assign(y=y, k=np.arange(len(x)))
    return spark.createDataFrame(pdf)


FEATURES = ["x0", "x1"]


@pytest.fixture(scope="module")
def bump(spark):
    x = np.random.default_rng(3).uniform(-3, 3, (900, 2))
    return MD.holdout(_frame(spark, x, 4 * np.exp(-(x ** 2).sum(1))), "k")


def test_features_approximate_the_kernel(spark):
    x = np.random.default_rng(1).normal(size=(40, 3))
    frame = MD.assemble(_frame(spark, x, 0.0), ["x0", "x1", "x2"])
    stage = K.RandomFourierFeatures(inputCol="features", outputCol="z", gamma=0.4, dims=4096)
    z = np.array([r[0] for r in stage.transform(frame).select(vector_to_array("z")).collect()])
    got = np.array([r[0] for r in frame.select(vector_to_array("features")).collect()])
    kernel = np.exp(-0.4 * ((got[:, None] - got[None]) ** 2).sum(-1))
    assert np.abs(z @ z.T - kernel).max() < 0.1


def test_svr_beats_the_line_and_can_be_saved(spark, bump):
    board = {r["model"]: r for r in MD.leaderboard_regression(*bump, FEATURES, "y", num_trees=5).collect()}
    assert set(board) == {"linear", "decision_tree", "knn", "svr_rbf_approximate", "random_forest", "gradient_boosting"}
    assert board["linear"]["r2"] < 0.2
    assert board["svr_rbf_approximate"]["r2"] > 0.8 and board["knn"]["r2"] > 0.8
    train, test = (MD.assemble(part, FEATURES, "y") for part in bump)
    model = K.fit_svr(train)
    path = shared_path(spark, "svr_model")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path)
    rows = lambda m: sorted(r[0] for r in m.transform(test).select(F.round("prediction", 9)).collect())
    assert rows(again) == rows(model)


@pytest.mark.parametrize("count", [2, 4])
def test_svc_separates_rings_with_probabilities(spark, count):
    x = np.random.default_rng(4).uniform(-2, 2, (700, 2))
    y = np.minimum((x ** 2).sum(1) / 4 * count, count - 1).astype(int)
    train, test = (MD.assemble(p, FEATURES, "y") for p in MD.holdout(_frame(spark, x, y), "k"))
    got = K.fit_svc(train).transform(test).select(
        "label", "prediction", vector_to_array("probability").alias("p")).collect()
    p = np.array([r["p"] for r in got])
    assert p.shape[1] == count and p.sum(1) == pytest.approx(np.ones(len(p))) and (p >= 0).all()
    assert np.mean([r["label"] == r["prediction"] for r in got]) > 0.8
    sure = p.max(1) > 0.9
    assert np.mean([r["label"] == q.argmax() for r, q in zip(got, p) if q.max() > 0.9]) > 0.85 and sure.sum() > 20


def test_knn_predictions_match_brute_force(spark):
    rng = np.random.default_rng(8)
    x, y = rng.normal(size=(300, 2)), rng.integers(0, 3, 300)
    frame = MD.assemble(_frame(spark, x, y), FEATURES, "y", ["k"])
    train, test = frame.filter("k < 200"), frame.filter("k >= 200").unionByName(frame.filter("k = 250"))
    got = K.knn_predict(train, test, classes=[0.0, 1.0, 2.0]).collect()
    assert len(got) == 101
    mean = {r["k"]: r["prediction"] for r in K.knn_predict(train, test).collect()}
    for r in got:
        near = y[np.argsort(((x[:200] - x[r["k"]]) ** 2).sum(1))[:5]]
        shares = np.bincount(near, minlength=3) / 5
        assert r["probability"].toArray() == pytest.approx(shares) and r["prediction"] == shares.argmax()
        assert mean[r["k"]] == pytest.approx(near.mean())


def test_classification_board_has_every_row_and_score(spark):
    x = np.random.default_rng(6).normal(size=(300, 2))
    y = (x[:, 0] + x[:, 1] > 0).astype(int)
    board = {r["model"]: r for r in MD.leaderboard_classification(
        *MD.holdout(_frame(spark, x, y), "k"), FEATURES, "y", num_trees=5).collect()}
    assert {"knn", "svc_rbf_approximate", "linear_svc", "mlp"} <= set(board) and len(board) == 8
    for name, r in board.items():
        assert r["precision_micro"] == pytest.approx(r["accuracy"]) and r["recall_micro"] == pytest.approx(r["accuracy"])
        assert (r["log_loss"] is None) == (name == "linear_svc")
        assert r["accuracy"] > 0.85


def test_svr_of_many_rows_reaches_a_smaller_objective(monkeypatch, spark):
    """Newton steps over packed rows end at or below Spark ML's value of the same
    objective, with equal vectors and far residuals among the rows."""
    from tabula.operators import cells
    rng = np.random.default_rng(3)
    x = rng.uniform(-3, 3, (1200, 2))
    x[600:] = x[:600]
    y = 4 * np.exp(-(x ** 2).sum(1)) + 0.2 * rng.standard_t(2, len(x))
    train = MD.assemble(_frame(spark, x, y), FEATURES, "y")
    plain = K.fit_svr(train, dims=16)
    monkeypatch.setattr(cells, "SMALL_ROWS", 100)
    model = K.fit_svr(train, dims=16)
    scaled, label = (np.array(v) for v in zip(*((r[0], r[1]) for r in plain.stages[0].transform(train).select(
        vector_to_array("_scaled"), "label").collect())))
    turns, begin = plain.stages[1].draws()(2)
    z = np.sqrt(2 / 16) * np.cos(scaled @ turns + begin)

    def objective(coefs, intercept, sigma):
        rest = np.abs(label - z @ coefs - intercept)
        each = np.where(rest <= 1.35 * sigma, sigma + rest ** 2 / sigma, sigma + 2.7 * rest - sigma * 1.35 ** 2)
        return each.mean() / 2 + 0.5 / len(z) * ((coefs * z.std(axis=0, ddof=1)) ** 2).sum()

    last, fit = plain.stages[-1], model.stages[-1]
    coefs = np.array(fit.getOrDefault("coefficients"))
    found = min(objective(coefs, fit.getOrDefault("intercept"), s) for s in np.linspace(0.7, 1.3, 121) * last.scale)
    assert found <= objective(last.coefficients.toArray(), last.intercept, last.scale) + 1e-4
    path = shared_path(spark, "svr_model_of_many_rows")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path)
    rows = lambda m: sorted(r[0] for r in m.transform(train).select(F.round("prediction", 9)).collect())
    assert rows(again) == rows(model)
