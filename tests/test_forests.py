"""Forest searches in one job (F2, F6): trees, votes and scores."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from tabula.operators import forests, models


def _rows(n=600, width=6, classes=3, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 8, (n, width)).astype(np.uint8)
    return x, (x[:, 0] // 3 + rng.integers(0, 2, n)).clip(0, classes - 1).astype(np.int64), rng.poisson(1, n)


@pytest.mark.parametrize("entropy", [False, True])
@pytest.mark.parametrize("least", [1, 4])
def test_split_paths_agree_and_the_first_split_is_the_best(monkeypatch, entropy, least):
    x, y, w = _rows()
    made = []
    for few in (0, 10 ** 9):
        monkeypatch.setattr(forests, "FEW_ROWS", few)
        made.append(forests.grow_tree(x, y, w, 3, 8, 9, 6, least, entropy, np.random.default_rng(1)))
    assert all(np.array_equal(a, b) for a, b in zip(*made))
    feature, cut, left, counts = made[0]
    assert counts[feature < 0].sum() >= counts[0].sum() and (counts[left[feature >= 0]].sum(1) >= least).all()

    def disorder(rows):
        p = np.bincount(y[rows], w[rows], 3) / w[rows].sum()
        return -(p * np.log2(np.maximum(p, 1e-300))).sum() if entropy else 1 - (p * p).sum()
    every = w > 0
    worth = {(f, c): disorder(every) - sum(w[r].sum() / w.sum() * disorder(r) for r in (every & (x[:, f] <= c), every & (x[:, f] > c)))
             for f in range(6) for c in range(7)}
    assert worth[feature[0], cut[0]] == pytest.approx(max(worth.values()))


def test_search_fits_no_forest_per_fold_and_setting(spark, monkeypatch):
    rows = spark.range(1500).select("id", F.rand(3).alias("a"), F.rand(4).alias("b"))
    data = models.assemble(rows.withColumn("y", (F.col("a") * 3).cast("int")), ["a", "b"], "y", ["id"])
    est, ev = RandomForestClassifier(seed=46), MulticlassClassificationEvaluator(metricName="accuracy")
    fits, fit = [], RandomForestClassifier.fit
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda *a: fits.append(1) or fit(*a))
    model, got = models.grid_search(est, {"numTrees": [5, 10], "maxDepth": [1, 4]}, data, ev, "id")
    assert len(fits) == 1 and type(model.bestModel).__name__ == "RandomForestClassificationModel"
    monkeypatch.setattr(models, "fold_accuracies", lambda *a: None)
    _, want = models.grid_search(est, {"numTrees": [5, 10], "maxDepth": [1, 4]}, data, ev, "id")
    got, want = ({r["params"]: r["metric"] for r in frame.collect()} for frame in (got, want))
    assert got.keys() == want.keys()
    for name, value in want.items():
        assert got[name] == pytest.approx(value, abs=0.02 if '"maxDepth": 4' in name else 0.2)


def test_other_estimators_and_metrics_go_to_spark_ml():
    accuracy = MulticlassClassificationEvaluator(metricName="accuracy")
    est = RandomForestClassifier(seed=1)
    assert forests.settings_of(est, [{est.maxDepth: 3}], accuracy)[0]["maxDepth"] == 3
    assert forests.settings_of(est, [{est.maxBins: 8}], accuracy) is None
    assert forests.settings_of(est, [{}], MulticlassClassificationEvaluator(metricName="f1")) is None
    assert forests.settings_of(RandomForestClassifier(minInfoGain=0.1), [{}], accuracy) is None
    assert [forests.features_per_node(s, 64) for s in ("auto", "log2", "onethird", "5", "99", "0.5")] == [8, 6, 22, 5, 64, None]


def test_a_deep_refit_is_a_table_of_trees(spark, monkeypatch):
    rows = spark.range(3000).select("id", F.rand(3).alias("a"), F.rand(4).alias("b"), F.rand(5).alias("c"))
    data = models.assemble(rows.withColumn("y", (F.col("a") * 3 + F.col("b") * 2).cast("int")), ["a", "b", "c"], "y", ["id"]).persist()
    est, ev = RandomForestClassifier(seed=46, bootstrap=False), MulticlassClassificationEvaluator(metricName="accuracy")
    grid = {"numTrees": [4, 6], "maxDepth": [2, 20]}
    fits, fit = [], RandomForestClassifier.fit
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda *a: fits.append(1) or fit(*a))
    found, _ = models.grid_search(est, grid, data, ev, "id")
    model = found.bestModel
    assert not fits and isinstance(model, forests.ForestTable)
    assert sorted(r["tree"] for r in model.trees.collect()) == list(range(model.getNumTrees))
    assert model.totalNumNodes > 100 and model.trees.filter("rows[0] <> 3000").count() == 0
    assert sum(model.featureImportances) == pytest.approx(1) and model.featureImportances[0] > model.featureImportances[2]
    scored = found.transform(data).select("id", "features", "probability", "prediction", "label").toPandas()
    assert len(scored) == 3000 == scored["id"].nunique() and (scored["prediction"] == scored["label"]).mean() > 0.99
    # every row is voted on by every tree, by the rules alone
    trees = [r.asDict() for r in model.trees.collect()]
    for x, got, most in zip(scored["features"][:50], scored["probability"], scored["prediction"]):
        want = np.zeros(model.numClasses)
        for t in trees:
            at = 0
            while t["feature"][at] >= 0:
                at = t["left"][at] + (x[t["feature"][at]] > t["threshold"][at])
            want += np.array(t["shares"][at * model.numClasses:(at + 1) * model.numClasses]) / len(trees)
        assert got.toArray() == pytest.approx(want) and most == got.toArray().argmax()
    data.unpersist()
