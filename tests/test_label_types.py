"""Estimators chosen by the label's values: imputation, searches, blending."""

import numpy as np
import pandas as pd
import pytest

from tabula.operators import models as MD


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(2)
    level = rng.integers(0, 3, 240)
    x = np.array([0.0, 9.0, 3.0])[level] + rng.normal(0, 0.3, 240)  # no monotone order of the names
    name = np.array(["ash", "birch", "cedar"])[level].astype(object)
    given = name.copy()
    given[::6] = None
    return spark.createDataFrame(pd.DataFrame({"k": np.arange(240), "x": x, "noise": rng.normal(size=240), "name": given,
                                               "true_name": name, "flag": [None if i % 5 == 0 else bool(v == 1)
                                                                           for i, v in enumerate(level)], "y": level}))


def test_string_column_is_filled_with_its_own_levels(frame):
    filled, report = MD.impute_model(frame.drop("flag", "true_name", "y"), "name", "k", num_trees=10)
    assert filled.columns == ["k", "x", "noise", "name"] and dict(filled.dtypes)["name"] == "string"
    got = filled.join(frame.select("k", "true_name"), "k")
    assert got.filter("name IS NULL OR (k % 6 <> 0 AND name <> true_name)").count() == 0  # known cells stay
    assert got.filter("k % 6 = 0 AND name <> true_name").count() <= 2  # of 40: splits lie on quantiles, not in the gaps
    row = report.first()
    assert row["column"] == "name" and row["predictors"] == "x" and row["cv_score"] > 0.95
    assert row["percent_missing"] == pytest.approx(100 / 6)


def test_boolean_column_keeps_its_type(frame):
    filled, _ = MD.impute_model(frame.select("k", "x", "noise", "flag"), "flag", "k", num_trees=10)
    assert dict(filled.dtypes)["flag"] == "boolean"
    assert filled.join(frame.select("k", "y"), "k").filter("flag IS NULL OR flag <> (y = 1)").count() == 0


def test_too_many_levels_none_at_all_and_no_predictor(spark, frame):
    many = spark.createDataFrame([(i, float(i), f"v{i}") for i in range(26)], "k long, x double, s string")
    with pytest.raises(ValueError):
        MD.impute_model(many, "s", "k")
    for empty in (many.filter("k < 0"), many.selectExpr("k", "x", "CAST(NULL AS STRING) AS s")):
        filled, report = MD.impute_model(empty, "s", "k")
        assert filled.columns == many.columns and filled.filter("s IS NOT NULL").count() == 0
        assert report.first()["predictors"] == ""
    filled, _ = MD.impute_model(frame.select("k", "noise", "name"), "name", "k")
    assert filled.filter("name IS NULL").count() == 40


def test_search_and_blend_choose_by_label(frame):
    data = MD.assemble(frame, ["x", "noise"], "y", ["k"])
    space = {"maxDepth": [2, 4], "numTrees": [3, 5]}
    model, res = MD.random_search(None, space, data, None, "k", iterations=2, folds=2)
    assert "Classification" in type(model.bestModel).__name__ and res.count() == 2
    model, _ = MD.random_search(None, space, MD.assemble(frame, ["noise"], "x", ["k"]), None, "k", iterations=1, folds=2)
    assert "Regression" in type(model.bestModel).__name__
    assert len(MD.forest_space(64, True)["featureSubsetStrategy"]) == 63 and "impurity" not in MD.forest_space(4, False)
    chances = MD.blend_predictions(frame, frame, ["x", "noise"], "y", num_trees=3, key="k").collect()
    assert all(len(r["blended"]) == 3 and sum(r["blended"]) == pytest.approx(1) for r in chances)
    assert isinstance(MD.blend_predictions(frame, frame, ["noise"], "x", num_trees=3, key="k").first()["blended"], float)


def test_few_levels_ignores_missing_cells(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,)], "x double")
    assert MD.few_levels(df, "x", 2) and not MD.few_levels(df, "x", 1)
