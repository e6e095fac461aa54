"""Registered queries: model fitting, tuning, intervals, evaluation of fitted
models, serving. Fitted results depend on optimiser details, so most have no
SQL oracle (rows-only check); the one-feature least-squares fit does."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import functions as F

from ..functions.scalar import tokens
from ..operators import models as MD
from ..operators import outliers as O
from ..operators.cells import fit_forest
from ..session import shared_path
from .fixtures import SQL_LINEITEM_LABEL, lineitem_label, t
from .registry import query

REG_F = ["l_quantity", "l_discount", "l_tax"]


def _reg(spark, sf):
    li = lineitem_label(spark, sf)
    return li.select(F.xxhash64(*li.columns).alias("rkey"), *REG_F, "y")


def _emb(spark, sf, binary=False, dims=64):
    e = t(spark, sf, "embeddings")
    out = e.select("vec_id", *[F.col("embedding")[i].cast("double").alias(f"e{i}")
                               for i in range(dims)],
                   ((F.col("label") < 5).cast("int") if binary else F.col("label")).alias("label"))
    return out


def _docs(spark, sf):
    lab = t(spark, sf, "labels")
    d = t(spark, sf, "documents", ["doc_id", "text", "n_chars", "lang"])
    d = d.select("doc_id", F.log1p("n_chars").alias("log_chars"),
                 F.size(tokens("text")).cast("double").alias("n_tokens"),
                 (F.col("lang") == "en").cast("double").alias("is_en"))
    return lab.join(d, "doc_id")


DOC_F = ["log_chars", "n_tokens", "is_en"]
EMB_F = [f"e{i}" for i in range(64)]


@query("linear_fit_one_feature", f"""
SELECT round(regr_slope(y, l_quantity), 6) AS slope, round(regr_intercept(y, l_quantity), 6) AS intercept
FROM {SQL_LINEITEM_LABEL} li""")
def q_linear_fit_one_feature(spark, sf):
    data = MD.assemble(lineitem_label(spark, sf), ["l_quantity"], "y")
    m = LinearRegression(solver="normal", regParam=0.0).fit(data)
    return spark.createDataFrame([(round(float(m.coefficients[0]), 6), round(float(m.intercept), 6))],
                                 "slope DOUBLE, intercept DOUBLE")


@query("regression_holdout")
def q_regression_holdout(spark, sf):
    _, m = MD.regression_holdout(_reg(spark, sf), REG_F, "y", "rkey")
    return m


@query("linear_summary")
def q_linear_summary(spark, sf):
    return MD.linear_summary(_reg(spark, sf), REG_F, "y")


@query("assume_linear")
def q_assume_linear(spark, sf):
    """R2, intercept and coefficients of the linear fit plus the actual vs
    predicted points' summary (the points themselves are ``residual_frame``)."""
    s = MD.linear_summary(_reg(spark, sf), REG_F, "y", solver="normal")
    return s.select("r2", "intercept", "coefficients")


@query("cross_validate")
def q_cross_validate(spark, sf):
    data = MD.assemble(_reg(spark, sf), REG_F, "y", ["rkey"])
    _, res = MD.cross_validate(LinearRegression(), data, RegressionEvaluator(metricName="rmse"),
                               "rkey", folds=3)
    return res


@query("grid_search")
def q_grid_search(spark, sf):
    data = MD.assemble(_emb(spark, sf), EMB_F, "label", ["vec_id"])
    _, res = MD.grid_search(RandomForestClassifier(seed=46),
                            {"numTrees": [10, 20], "maxDepth": [5, 30]}, data,
                            MulticlassClassificationEvaluator(metricName="accuracy"), "vec_id")
    return res


@query("random_search")
def q_random_search(spark, sf):
    """50 settings of 216 in 5 folds: random forests over all 64 dimensions."""
    data = MD.assemble(_emb(spark, sf), EMB_F, "label", ["vec_id"])
    space = {"numTrees": [10, 20, 40], "maxDepth": [2, 4, 8, 12],
             "featureSubsetStrategy": ["auto", "sqrt", "log2"], "minInstancesPerNode": [1, 2, 4],
             "impurity": ["gini", "entropy"]}
    _, res = MD.random_search(RandomForestClassifier(seed=46), space, data,
                              MulticlassClassificationEvaluator(metricName="accuracy"), "vec_id")
    return res


@query("staged_ensemble_error")
def q_staged_ensemble_error(spark, sf):
    return MD.staged_ensemble_error(_emb(spark, sf, binary=True), EMB_F, "label", "vec_id",
                                    max_iter=20)


@query("staged_forest_error")
def q_staged_forest_error(spark, sf):
    return MD.staged_ensemble_error(_emb(spark, sf, binary=True), EMB_F, "label", "vec_id",
                                    max_iter=100, forest=True)


@query("training_history")
def q_training_history(spark, sf):
    return MD.training_history(_emb(spark, sf), EMB_F, "label", LogisticRegression(maxIter=50))


@query("early_stopping")
def q_early_stopping(spark, sf):
    h = MD.training_history(_emb(spark, sf), EMB_F, "label", LogisticRegression(maxIter=100))
    return MD.early_stopping_epoch(h, "objective", "iteration", 1e-4, 5)


@query("f1_cutoff_cv")
def q_f1_cutoff_cv(spark, sf):
    return MD.f1_cutoff_cv(_docs(spark, sf), DOC_F, "toxic", "doc_id", folds=5)


@query("intervals_forest")
def q_intervals_forest(spark, sf):
    train, test = MD.holdout(_reg(spark, sf), "rkey")
    model = fit_forest(MD.assemble(train, REG_F, "y"), 100)
    return MD.intervals_forest(model, MD.assemble(test, REG_F, "y", ["rkey"]), 0.95, keep=["rkey"])


@query("intervals_quantile")
def q_intervals_quantile(spark, sf):
    train, test = MD.holdout(_reg(spark, sf), "rkey")
    return MD.intervals_quantile(train, test, REG_F, "y", 0.95, keep=["rkey"])


@query("intervals_quantile_boosted")
def q_intervals_quantile_boosted(spark, sf):
    """The boosted branch: pinball loss, at most 20 rounds a bound, stopped by a
    tenth of the training rows."""
    train, test = MD.holdout(_reg(spark, sf), "rkey")
    return MD.intervals_quantile_boosted(train, test, REG_F, "y", "rkey", 0.95, keep=["rkey"], rounds=20, learning_rate=0.3)


@query("join_inner_multi_key")
def q_join_inner_multi_key(spark, sf):
    """Label, point prediction and lower/upper bounds side by side for the
    same rows: the three models score one frame (no self-join on the
    non-unique ``(label, features)`` key)."""
    train, test = MD.holdout(_reg(spark, sf), "rkey")
    out = MD.intervals_quantile(train, test, REG_F, "y", 0.95, keep=["rkey", "y"])
    return out.select("rkey", F.col("y").alias("label"), "prediction",
                      F.col("lower_PI").alias("LowerBound"), F.col("upper_PI").alias("UpperBound"))


@query("blend_predictions")
def q_blend_predictions(spark, sf):
    train, test = MD.holdout(_reg(spark, sf), "rkey")
    return MD.blend_predictions(train, test, REG_F, "y", n_models=3, num_trees=100, key="rkey")


@query("blend_probabilities")
def q_blend_probabilities(spark, sf):
    """Class probabilities of three forests, averaged: the label has ten values."""
    train, test = MD.holdout(_emb(spark, sf), "vec_id")
    out = MD.blend_predictions(train, test, EMB_F, "label", key="vec_id")
    return out.select("vec_id", F.transform("blended", lambda p: F.round(p, 9)).alias("probabilities"))


@query("rfe_logistic")
def q_rfe_logistic(spark, sf):
    return MD.rfe_logistic(_emb(spark, sf, binary=True), EMB_F, "label", "vec_id",
                           min_features=3)


@query("kmeans_sweep")
def q_kmeans_sweep(spark, sf):
    return MD.kmeans_sweep(_emb(spark, sf), EMB_F, max_clusters=10)


@query("leaderboard_regression")
def q_leaderboard_regression(spark, sf):
    train, test = MD.holdout(_reg(spark, sf), "rkey")
    return MD.leaderboard_regression(train, test, REG_F, "y")


@query("leaderboard_classification")
def q_leaderboard_classification(spark, sf):
    train, test = MD.holdout(_emb(spark, sf, binary=True), "vec_id")
    return MD.leaderboard_classification(train, test, EMB_F, "label")


@query("learning_curve")
def q_learning_curve(spark, sf):
    return MD.learning_curve(_reg(spark, sf), REG_F, "y", "rkey", LinearRegression(),
                             RegressionEvaluator(metricName="r2"))


@query("validation_curve")
def q_validation_curve(spark, sf):
    return MD.validation_curve(_reg(spark, sf), REG_F, "y", "rkey", DecisionTreeRegressor(seed=46),
                               RegressionEvaluator(metricName="r2"), "maxDepth", [2, 4, 6])


@query("feature_importance")
def q_feature_importance(spark, sf):
    m = fit_forest(MD.assemble(_reg(spark, sf), REG_F, "y"), 100)
    return MD.feature_importance(m, REG_F, spark=spark)


@query("tree_nodes")
def q_tree_nodes(spark, sf):
    m = DecisionTreeRegressor(maxDepth=3, seed=46).fit(MD.assemble(_reg(spark, sf), REG_F, "y"))
    return MD.tree_nodes(m, shared_path(spark, "tree"), spark)


@query("shap_values")
def q_shap_values(spark, sf):
    """Exact SHAP values of the linear fit, with the additivity check
    ``sum(shap) + base == prediction`` carried as a column."""
    data = _reg(spark, sf)
    m = LinearRegression().fit(MD.assemble(data, REG_F, "y"))
    sh = MD.shap_linear(m, data, REG_F, keep=["rkey", *REG_F])
    pred = F.lit(float(m.intercept))
    for c, f in zip(m.coefficients, REG_F):
        pred = pred + F.col(f) * F.lit(float(c))
    total = sum(F.col(f"shap_{f}") for f in REG_F) + F.col("base_value")
    return sh.select("rkey", *[f"shap_{f}" for f in REG_F], "base_value",
                     (F.abs(total - pred) < 1e-6).alias("additive"))


@query("score_batch")
def q_score_batch(spark, sf):
    emb = _emb(spark, sf)
    path = shared_path(spark, "pipeline")
    model, _ = MD.train_and_export(emb, EMB_F, "label", "vec_id", path)
    names = {i: n for i, n in enumerate(["zero", "one", "two", "three", "four", "five", "six",
                                          "seven", "eight", "nine"])}
    return MD.score_batch(MD.load_model(path), emb, names, keep=["vec_id"])


@query("train_and_export")
def q_train_and_export(spark, sf):
    emb = _emb(spark, sf)
    model, acc = MD.train_and_export(emb, EMB_F, "label", "vec_id", shared_path(spark, "export"))
    path = MD.save_model(model, shared_path(spark, "models"), "logistic")
    return spark.createDataFrame([(path.rsplit("/", 1)[-1][:9], float(acc))],
                                 "model_name STRING, accuracy DOUBLE")


@query("sliding_window_evaluation")
def q_sliding_window_evaluation(spark, sf):
    """5-minute bars of the event values with one-hour lag features; five
    consecutive windows, first 80% of each for an L1 linear fit, the rest
    for its test RMSE."""
    from ..streaming.bars import bars_with_lag
    e = t(spark, sf, "events", ["event_id", "ts", "value"])
    bars = bars_with_lag(e, "ts", "value", "event_id").na.drop()
    return MD.sliding_window_evaluation(
        bars, ["previous_hour_close", "previous_hour_high_low_range", "previous_hour_volume"],
        "close", "bar_start", num_windows=5, test_size=0.2, key="bar_start")


@query("impute_model")
def q_impute_model(spark, sf):
    """Fill every seventh document's ``n_chars`` with a forest fitted on
    correlated predictors (token count, line count)."""
    d = t(spark, sf, "documents", ["doc_id", "text", "n_chars"])
    d = d.select("doc_id", F.size(tokens("text")).cast("double").alias("n_tokens"),
                 F.size(F.split("text", "\n")).cast("double").alias("n_lines"),
                 F.when(F.col("doc_id") % 7 == 0, F.lit(None)).otherwise(F.col("n_chars")).alias("n_chars"))
    filled, _ = MD.impute_model(d, "n_chars", key="doc_id")
    return filled.select("doc_id", "n_chars")


@query("impute_levels")
def q_impute_levels(spark, sf):
    """Fill the language of every seventh document, and of those without one,
    by a forest classifier over shares of letters in the whole texts."""
    d = t(spark, sf, "documents", ["doc_id", "text", "lang"])
    share = lambda c: 1 - F.try_divide(F.length(F.replace("text", F.lit(c))), F.length("text"))
    d = d.select("doc_id", *[share(c).alias(f"share_{c}") for c in "aehinostu"],
                 F.when(F.col("doc_id") % 7 == 0, F.lit(None)).otherwise(F.col("lang")).alias("lang"))
    filled, _ = MD.impute_model(d, "lang", key="doc_id", corr_threshold=0.3)
    return filled.select("doc_id", "lang")


@query("outlier_report", """
WITH b AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3,
                  avg(value) AS m, stddev_pop(value) AS s FROM events)
SELECT 'iqr' AS method, 'value' AS feature, event_id FROM events, b
  WHERE value > q3 + (q3 - q1) * 1.5 OR value < q1 - (q3 - q1) * 1.5
UNION ALL
SELECT 'zscore', 'value', event_id FROM events, b WHERE abs((value - m) / s) > 3""")
def q_outlier_report(spark, sf):
    e = t(spark, sf, "events", ["event_id", "value"])
    return O.outlier_report(e, ["value"], "event_id", methods=("iqr", "zscore"))



@query("checkpoint_best")
def q_checkpoint_best(spark, sf):
    """Grid search keeping only the best model: it is written to the shared
    folder, loaded back and re-scored."""
    from pyspark.ml.classification import RandomForestClassificationModel
    data = MD.assemble(_emb(spark, sf), EMB_F, "label", ["vec_id"])
    ev = MulticlassClassificationEvaluator(metricName="accuracy")
    cvm, res = MD.grid_search(RandomForestClassifier(seed=46), {"maxDepth": [3, 6]}, data, ev,
                              "vec_id")
    path = shared_path(spark, "best")
    cvm.bestModel.write().overwrite().save(path)
    best = RandomForestClassificationModel.load(path)
    acc = ev.evaluate(best.transform(data))
    return spark.createDataFrame([(int(best.getMaxDepth()), float(max(cvm.avgMetrics)), float(acc))],
                                 "max_depth INT, cv_accuracy DOUBLE, reloaded_train_accuracy DOUBLE")


@query("save_model")
def q_save_model(spark, sf):
    """A fitted pipeline written under the shared folder with the
    ``_YYYYMMDD`` suffix; lists what was written."""
    from datetime import date
    emb = _emb(spark, sf)
    model, _ = MD.train_and_export(emb, EMB_F, "label", "vec_id", shared_path(spark, "tmp-model"))
    path = MD.save_model(model, shared_path(spark, "saved"), "pipeline", today=date(2024, 1, 1))
    stages = spark.read.text(path + "/stages/*/metadata").select(
        F.get_json_object("value", "$.class").alias("stage_class"))
    return stages.withColumn("model_name", F.lit(path.rsplit("/", 1)[-1]))


@query("load_model")
def q_load_model(spark, sf):
    """Save, load, and score every embedding row with the loaded pipeline."""
    emb = _emb(spark, sf)
    model, _ = MD.train_and_export(emb, EMB_F, "label", "vec_id", shared_path(spark, "tmp-model"))
    path = MD.save_model(model, shared_path(spark, "saved"), "pipeline")
    return MD.load_model(path).transform(emb).select("vec_id", "label", "prediction")


@query("shap_values_tree")
def q_shap_values_tree(spark, sf):
    """Path-dependent Tree SHAP of a random forest (100 trees) for every
    lineitem row, with the model output they add up to."""
    from ..operators.shap import shap_values_trees
    data = _reg(spark, sf)
    m = fit_forest(MD.assemble(data, REG_F, "y"), 100)
    return shap_values_trees(m, data, REG_F, "rkey", shared_path(spark, "shap-forest"))


@query("shap_importance")
def q_shap_importance(spark, sf):
    """Global importance: mean |SHAP| per feature of the forest above."""
    from ..operators.shap import mean_abs_shap, shap_values_trees
    data = _reg(spark, sf)
    m = fit_forest(MD.assemble(data, REG_F, "y"), 100)
    sh = shap_values_trees(m, data, REG_F, "rkey", shared_path(spark, "shap-forest"))
    return mean_abs_shap(sh, REG_F)
