"""Trees grown from the sums of cells against Spark ML and plain sums."""

import numpy as np
import pytest
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from tabula.operators import cells, models, shap

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    """2,000 rows, at most 25 values a feature: the borders do not depend on a sample."""
    h = lambda i: F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)) / 1000
    frame = spark.range(2000).select("id", F.floor(h(1) * 25).cast("double").alias("a"), F.floor(h(2) * 9).cast("double").alias("b"),
                                     F.floor(h(3) * 4).cast("double").alias("c"), h(4).alias("noise"))
    frame = frame.withColumn("y", F.col("a") * 2 + F.col("b") * F.col("b") + F.col("noise")).repartition(3, "id").cache()
    return models.assemble(frame, FEATURES, "y", ["id", *FEATURES]).cache()


def predicted(model, data):
    return np.array([r[0] for r in model.transform(data).orderBy("id").select("prediction").collect()])


def test_one_tree_without_draws_is_that_of_spark(spark, rows):
    mine = cells.boosted_of_cells(rows, 2000, 3, 1, 0.1, 4, 46, 32)
    want = DecisionTreeRegressor(maxDepth=4, seed=46).fit(rows)
    np.testing.assert_allclose(predicted(mine, rows), predicted(want, rows), rtol=1e-9)
    np.testing.assert_allclose(mine.featureImportances.toArray(), want.featureImportances.toArray(), rtol=1e-9)


def test_boosted_trees_are_those_of_spark(spark, rows):
    mine = cells.boosted_of_cells(rows, 2000, 3, 6, 0.3, 3, 46, 32)
    want = GBTRegressor(maxIter=6, stepSize=0.3, maxDepth=3, seed=46).fit(rows)
    np.testing.assert_allclose(predicted(mine, rows), predicted(want, rows), rtol=1e-6)


def test_every_row_is_drawn_for_every_tree(spark, rows):
    borders = cells.bin_borders(rows, 2000, 3, 32, 46)
    assert [len(b) for b in borders] == [24, 8, 3]
    plain = cells.cell_sums(rows, 2000, borders, 0, 46).toPandas()
    assert sum(n.sum() for n in plain["n"]) == 2000
    assert sum(s.sum() for s in plain["s"]) == pytest.approx(rows.agg(F.sum("label")).first()[0])
    drawn = cells.cell_sums(rows, 2000, borders, 60, 46).toPandas()
    size = np.array([sum(n.sum() for n in g["n"]) for _, g in drawn.groupby("tree")])
    assert len(size) == 60 and len(set(size)) > 20 and abs(size.mean() - 2000) < 30 and 20 < size.std() < 70


def test_the_forest_fits_as_that_of_spark(spark, rows):
    mine = cells.forest_of_cells(rows, 2000, 3, 40, 46, 5, 32)
    want = RandomForestRegressor(numTrees=40, seed=46).fit(rows)
    y = np.array([r[0] for r in rows.orderBy("id").select("label").collect()])
    error = lambda m: np.sqrt(np.mean((predicted(m, rows) - y) ** 2))
    assert len(mine.trees) == 40 and error(mine) == pytest.approx(error(want), rel=0.2)
    np.testing.assert_allclose(mine.featureImportances.toArray(), want.featureImportances.toArray(), atol=0.06)


def test_bands_and_shap_of_a_cell_forest(spark, rows):
    model = cells.forest_of_cells(rows, 2000, 3, 20, 46, 5, 32)
    x = np.array([r[0].toArray() for r in rows.orderBy("id").select("features").collect()])
    each = cells.tree_values(x, model.trees)
    band = models.intervals_forest(model, rows, 0.9, keep=["id"]).orderBy("id").toPandas()
    np.testing.assert_allclose(band[["lower_PI", "prediction", "upper_PI"]],
                               np.column_stack([np.quantile(each, 0.05, axis=1), each.mean(axis=1), np.quantile(each, 0.95, axis=1)]))
    out = shap.shap_values_trees(model, rows, FEATURES, "id", "").orderBy("id").toPandas()
    np.testing.assert_allclose(out["model_output"], predicted(model, rows), rtol=1e-9)


def test_large_frames_of_few_features_are_fitted_from_cells(spark, rows, monkeypatch):
    assert isinstance(cells.fit_forest(rows, 2), type(RandomForestRegressor(numTrees=2).fit(rows)))
    monkeypatch.setattr(cells, "SMALL_ROWS", 100)
    assert isinstance(cells.fit_forest(rows, 2), cells.CellTrees)
    blended = models.blend_predictions(rows.select("id", *FEATURES, F.col("label").alias("y")), rows.select("id", *FEATURES), FEATURES, "y",
                                       n_models=2, num_trees=3, key="id", classification=False)
    assert blended.count() == 2000 and blended.filter("blended IS NULL").count() == 0
    wide = rows.select(F.col("label"), models.vector_to_array("features").alias("v")).select("label", *[F.col("v")[i % 3].alias(f"w{i}") for i in range(5)])
    data = models.assemble(wide, [f"w{i}" for i in range(5)], "label")
    assert cells.few_cells(data, "label", 32) is None


def test_rows_between_the_same_borders_are_valued_once():
    asked = []
    value = lambda x: asked.append(len(x)) or x[:, 0] > 1
    x, known = np.array([[0.5, 3.0], [0.7, 9.0], [1.5, 3.0], [0.5, 3.0]]), {}
    for _ in range(2):
        got = cells.by_cell(x, [np.array([1.0]), np.array([])], known, value)
        assert got.tolist() == [False, False, True, False]
    assert asked == [2]


def test_the_validation_curve_of_cells_is_that_of_the_rows(spark, rows, monkeypatch):
    from pyspark.ml.evaluation import RegressionEvaluator
    frame = rows.select("id", *FEATURES, F.col("label").alias("y"))
    curve = lambda: models.validation_curve(frame, FEATURES, "y", "id", DecisionTreeRegressor(seed=46), RegressionEvaluator(metricName="r2"),
                                            "maxDepth", [2, 5]).toPandas()
    want = curve()
    monkeypatch.setattr(cells, "SMALL_ROWS", 100)
    got = curve()
    assert list(got["param_value"]) == list(want["param_value"]) and list(got["fold"]) == list(want["fold"])
    np.testing.assert_allclose(got[["train_score", "test_score"]], want[["train_score", "test_score"]], rtol=1e-9)


def test_holdout_spreads_a_frame_of_one_task(spark, monkeypatch):
    from tabula.plans import scale
    monkeypatch.setattr(scale, "SPREAD_ROWS", 100)
    train, test = models.holdout(spark.range(0, 1000, 1, 1), "id")
    assert train.rdd.getNumPartitions() > 1 and (train.count(), test.count()) == (700, 300)


def test_cuts_of_a_drawn_order_rank_only_the_draws_at_the_cuts(spark, monkeypatch):
    from tabula.operators import sample
    ids = [None] * 40 + [7] * 300 + list(range(1000, 1660))
    frame = spark.createDataFrame([(i,) for i in ids], "id long")
    order = [sample.draw_int("id", 46), F.col("id")]
    ranked, rank = [], sample.global_rank_total
    monkeypatch.setattr(sample, "global_rank_total", lambda df, *a, **k: ranked.append(df.count()) or rank(df, *a, **k))
    for places in ([1, 40, 41, 500, 999, 1000], [0, 1001], [300, 300], [700]):
        found = []
        for drawn in (True, False):
            after, n = sample._order_cuts(frame, order, lambda n: places, drawn)
            assert n == 1000
            found.append(frame.select("id", *[c.alias(f"c{i}") for i, c in enumerate(after)]).toPandas().value_counts(dropna=False).sort_index())
        assert found[0].equals(found[1])
    assert ranked[1::2] == [1000] * 4 and ranked[2] == 0 and ranked[6] <= 310
    empty = sample._order_cuts(frame.limit(0), order, lambda n: [0, n])
    assert empty[1] == 0 and frame.limit(0).select(*empty[0]).count() == 0


def test_the_validation_curve_stores_no_rows(spark, rows, monkeypatch):
    from pyspark.ml.evaluation import RegressionEvaluator
    frame = rows.select("id", *FEATURES, F.col("label").alias("y"))
    frame = frame.unionByName(frame.limit(3).withColumn(FEATURES[0], F.lit(None).cast("double")))
    monkeypatch.setattr(cells, "SMALL_ROWS", 100)
    monkeypatch.setattr(models, "assemble", None)
    got = models.validation_curve(frame, FEATURES, "y", "id", DecisionTreeRegressor(seed=46), RegressionEvaluator(metricName="r2"),
                                  "maxDepth", [2]).toPandas()
    assert len(got) == 3 and got["train_score"].between(0, 1).all()
