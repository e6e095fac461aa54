"""Tree SHAP against brute-force Shapley values of the path-dependent
conditional expectation, and additivity against the model's predictions."""

import itertools
import math

import numpy as np
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from tabula.operators import models as MD
from tabula.operators import shap as SH
from tabula.plans.fixtures import lineitem_label
from tabula.session import shared_path

from .conftest import SF_SMALL

FEATS = ["l_quantity", "l_discount", "l_tax"]


def _cond_exp(tree, x, subset, j=0):
    left, right, feat, thr, value, cover = tree
    if left[j] < 0:
        return value[j]
    f = feat[j]
    if f in subset:
        nxt = left[j] if x[f] <= thr[j] else right[j]
        return _cond_exp(tree, x, subset, nxt)
    return (cover[left[j]] * _cond_exp(tree, x, subset, left[j])
            + cover[right[j]] * _cond_exp(tree, x, subset, right[j])) / cover[j]


def _brute(tree, x, d):
    phi = np.zeros(d)
    for i in range(d):
        others = [k for k in range(d) if k != i]
        for r in range(len(others) + 1):
            for s in itertools.combinations(others, r):
                w = math.factorial(len(s)) * math.factorial(d - len(s) - 1) / math.factorial(d)
                phi[i] += w * (_cond_exp(tree, x, set(s) | {i}) - _cond_exp(tree, x, set(s)))
    return phi


def test_tree_shap_matches_brute_force_and_adds_up(spark):
    li = lineitem_label(spark, SF_SMALL).withColumn("k", F.monotonically_increasing_id())
    model = RandomForestRegressor(numTrees=3, maxDepth=4, seed=46).fit(MD.assemble(li, FEATS, "y"))
    path = shared_path(spark, "shap-model")
    trees = SH.tree_tables(model, path, spark)
    pdf = li.select(*FEATS).limit(25).toPandas()
    for x in pdf.to_numpy(dtype=float):
        for t in trees:
            np.testing.assert_allclose(SH.tree_shap_row(x, t, 3), _brute(t, x, 3), atol=1e-9)
    sh = SH.shap_values_trees(model, li, FEATS, "k", shared_path(spark, "shap-model2"))
    pred = model.transform(MD.assemble(li, FEATS, "y", ["k"])).select("k", "prediction")
    j = sh.join(pred, "k").toPandas()
    np.testing.assert_allclose(j["model_output"], j["prediction"], rtol=1e-9, atol=1e-9)


def test_batch_tree_shap_equals_row_form(spark):
    li = lineitem_label(spark, SF_SMALL)
    model = RandomForestRegressor(numTrees=4, maxDepth=5, seed=7).fit(MD.assemble(li, FEATS, "y"))
    trees = SH.tree_tables(model, shared_path(spark, "shap-batch"), spark)
    x = li.select(*FEATS).limit(300).toPandas().to_numpy(dtype=float)
    for t in trees:
        rows = np.array([SH.tree_shap_row(r, t, 3) for r in x])
        np.testing.assert_allclose(SH.tree_shap_batch(x, t, 3), rows, rtol=1e-9, atol=1e-9)


def test_query_explains_every_lineitem_row(spark):
    from tabula.plans import q_models
    from tests.conftest import SF_SMALL
    got = q_models.q_shap_values_tree(spark, SF_SMALL).toPandas()
    assert len(got) == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    total = got[[c for c in got if c.startswith("shap_")]].sum(axis=1) + got["base_value"]
    assert abs(total - got["model_output"]).max() < 1e-6
