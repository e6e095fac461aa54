"""Model fitting, tuning, intervals and scoring on ``pyspark.ml``.

Training is Spark ML (distributed aggregates per iteration); the driver only
holds parameter maps, d x d matrices and per-fit metrics. Folds and holdout
splits are keyed (``operators.sample``), so every fit is replayable.
"""

from __future__ import annotations

import json
import math
import os
import random
import time
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import partial

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC,
                                       LogisticRegression, MultilayerPerceptronClassifier,
                                       OneVsRest, RandomForestClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import (BinaryClassificationEvaluator,
                                   MulticlassClassificationEvaluator, RegressionEvaluator)
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.ml.tuning import CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import missing, safe_corr
from ..plans.scale import one_row, quantiles, spread
from .boosting import boost_quantiles
from .cells import (MOST_CELLS, CellTrees, blended, fit_boosted, fit_forest, fit_forests, known_rows, plain_columns,
                    weighted_cells)
from .forests import fold_accuracies, refit
from .kernel import fit_svc, fit_svr, knn_predict
from .evaluate import f1_by_threshold, metrics_by_class, metrics_regression
from .newton import Fit, accuracies, newton, standardised
from .sample import split_holdout, split_kfold


#: A label with at most so many values is a class (searches, blending).
MOST_CLASSES = 49
#: A string column with at most so many levels can be imputed.
MOST_LEVELS = 25


def assemble(df: DataFrame, features, label: str | None = None, keep=()) -> DataFrame:
    va = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")
    cols = [*keep, "features"] + ([F.col(label).cast("double").alias("label")] if label else [])
    return va.transform(df).select(*cols)


def holdout(df: DataFrame, key: str, test_size: float = 0.3, seed: int = 46):
    # a filter on the split of a frame that is not stored evaluates its draw, and
    # the key the draw is made of, many times a row and in every scan
    s = spread(split_holdout(df, key, test_size, seed), df.count()).persist(StorageLevel.MEMORY_AND_DISK)
    return s.filter("split = 'train'").drop("split"), s.filter("split = 'test'").drop("split")


# ------------------------------------------------------------- regression


def regression_holdout(df: DataFrame, features, label: str, key: str, seed: int = 46,
                       test_size: float = 0.3, **lr_params):
    """``regression_holdout``: fit linear regression on a keyed 70/30 split;
    returns ``(model, metrics)`` with test RMSE / MAE / R2."""
    train, test = holdout(df, key, test_size, seed)
    model = LinearRegression(**lr_params).fit(assemble(train, features, label, [key]))
    pred = model.transform(assemble(test, features, label, [key]))
    return model, metrics_regression(pred, "label", "prediction")


def linear_summary(df: DataFrame, features, label: str, solver: str = "l-bfgs", **params) -> DataFrame:
    """``linear_summary``: coefficients, intercept, iterations, objective
    history, RMSE and R2 of a linear fit, as one row."""
    data = assemble(df, features, label)
    model = LinearRegression(solver=solver, **params).fit(data)
    s = model.summary
    row = (list(map(float, model.coefficients)), float(model.intercept), int(s.totalIterations),
           list(map(float, s.objectiveHistory)), float(s.rootMeanSquaredError), float(s.r2))
    return df.sparkSession.createDataFrame(
        [row], "coefficients ARRAY<DOUBLE>, intercept DOUBLE, iterations INT, "
               "objective_history ARRAY<DOUBLE>, rmse DOUBLE, r2 DOUBLE")


def training_history(df: DataFrame, features, label: str, estimator=None) -> DataFrame:
    """``training_history``: objective per iteration and the fit's wall time."""
    est = estimator or LogisticRegression(maxIter=50)
    t0 = time.perf_counter()
    model = est.fit(assemble(df, features, label))
    secs = time.perf_counter() - t0
    hist = list(model.summary.objectiveHistory)
    return df.sparkSession.createDataFrame(
        [(i, float(v), float(secs)) for i, v in enumerate(hist)],
        "iteration INT, objective DOUBLE, fit_seconds DOUBLE")


def early_stopping_epoch(history: DataFrame, metric: str = "objective", order: str = "iteration",
                         min_delta: float = 1e-4, patience: int = 5) -> DataFrame:
    """``early_stopping``: the first step at which ``metric`` has not improved
    by ``min_delta`` on the best value for ``patience`` consecutive steps.
    Runs on the (small) history table with windows."""
    from pyspark.sql import Window
    w = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    h = history.withColumn("_best_before", F.min(metric).over(w))
    h = h.withColumn("_improved", F.coalesce(F.col(metric) < F.col("_best_before") - min_delta,
                                             F.lit(True)))
    w2 = Window.orderBy(order)
    h = h.withColumn("_grp", F.sum(F.col("_improved").cast("int")).over(
        w2.rowsBetween(Window.unboundedPreceding, 0)))
    h = h.withColumn("_stale", F.row_number().over(Window.partitionBy("_grp").orderBy(order)) - 1)
    return h.filter(F.col("_stale") >= patience).agg(F.min(order).alias("stop_at"))


# ----------------------------------------------------------------- tuning


def cross_validate(estimator, df: DataFrame, evaluator, key: str, folds: int = 3, seed: int = 46,
                   grid=None, parallelism: int = 1, fold_col: str | None = None):
    """``cross_validate`` / ``grid_search``: k-fold CV with keyed folds
    (or the caller's ``fold_col``, to reuse one fold assignment).
    Returns ``(cv_model, results)``; results has one row per parameter map."""
    if fold_col:
        data = df.withColumnRenamed(fold_col, "_fold")
    else:
        data = split_kfold(df, key, folds, seed).withColumnRenamed("fold", "_fold")
    maps = grid if grid is not None else ParamGridBuilder().build()
    data = (data.drop(key) if key not in ("features", "label") else data).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        cvm = _fit_folds(estimator, data, maps, evaluator, folds, parallelism)
    finally:
        data.unpersist()
    rows = []
    for pm, m, sd in zip(maps, cvm.avgMetrics, cvm.stdMetrics):
        rows.append((json.dumps({p.name: _jsonable(v) for p, v in pm.items()}, sort_keys=True),
                     float(m), float(sd)))
    res = df.sparkSession.createDataFrame(rows, "params STRING, metric DOUBLE, metric_std DOUBLE")
    return cvm, res


def _fit_folds(estimator, data: DataFrame, maps: list, evaluator, folds: int, parallelism: int) -> CrossValidatorModel:
    """What ``CrossValidator`` does with the column ``_fold``, over persisted rows:
    it would write every fold's rows into a cache of their own, and evaluate
    the draws behind the fold numbers again for each. Forest classifiers are fitted
    in one job where they can be (``fold_accuracies``), and so is a deep refit."""
    fold = F.col("_fold")
    seen = one_row(data, F.min(fold).alias("low"), F.max(fold).alias("high"), F.count_distinct(fold).alias("n"),
                   F.count(F.when(fold.isNull(), 1)).alias("none"))
    if seen["none"] or (seen["n"] and (seen["low"] < 0 or seen["high"] >= folds)):
        raise ValueError(f"fold numbers must be in the range [0, {folds})")
    if seen["n"] < folds or folds < 2:
        raise ValueError("a fold has no rows to train on or to validate on")

    def score(job):
        k, pm = job
        model = estimator.fit(data.filter(fold != k), pm)
        return float(evaluator.evaluate(model.transform(data.filter(fold == k), pm)))

    metrics = fold_accuracies(estimator, data, maps, evaluator, folds)
    joint = metrics is not None
    if not joint:
        with ThreadPoolExecutor(max(1, parallelism)) as pool:
            found = list(pool.map(inheritable_thread_target(data.sparkSession)(score), [(k, pm) for k in range(folds) for pm in maps]))
        metrics = np.array(found).reshape(folds, len(maps))
    mean = metrics.mean(axis=0)
    best = np.argmax(mean) if evaluator.isLargerBetter() else np.argmin(mean)
    model = refit(estimator, data, maps[best], evaluator) if joint else None
    return CrossValidatorModel(model or estimator.fit(data, maps[best]), mean.tolist(), stdMetrics=metrics.std(axis=0).tolist())


def _jsonable(v):
    if isinstance(v, (np.integer,)):
        return int(v)
    if isinstance(v, (np.floating,)):
        return float(v)
    return v


def grid_search(estimator, param_grid: dict, df: DataFrame, evaluator, key: str,
                folds: int = 3, seed: int = 46, parallelism: int = 2):
    """``grid_search``: exhaustive parameter grid (dict name -> values)."""
    b = ParamGridBuilder()
    for name, values in param_grid.items():
        b = b.addGrid(estimator.getParam(name), list(values))
    return cross_validate(estimator, df, evaluator, key, folds, seed, b.build(), parallelism)


def few_levels(df: DataFrame, column: str, most: int) -> bool:
    """Whether ``column`` has at most ``most`` values besides NULL and NaN; no
    more than ``most + 1`` of them leave the count."""
    present = df.select(column).filter(~missing(df, column)).distinct()
    return present.limit(most + 1).count() <= most


def forest_space(width: int, classification: bool) -> dict:
    """Choices of a forest search: depth, features per split, rows per leaf,
    bootstrap, and the impurity of a classifier."""
    space = {"maxDepth": [3, 30], "featureSubsetStrategy": [str(i) for i in range(1, max(2, width))],
             "minInstancesPerNode": list(range(1, 11)), "bootstrap": [True, False]}
    return space | ({"impurity": ["gini", "entropy"]} if classification else {})


def _check_settings(space: dict, iterations: int) -> int:
    total = math.prod(len(v) for v in space.values())
    if iterations > total:
        raise ValueError(f"the space has {total} settings, {iterations} were asked for")
    return total


def random_search(estimator, space: dict | None, df: DataFrame, evaluator, key: str,
                  iterations: int = 50, folds: int = 5, seed: int = 46, parallelism: int = 8):
    """``random_search``: ``iterations`` different parameter maps drawn (seeded,
    without replacement) from ``space`` (name -> list of choices), then k-fold
    CV. Asking for more settings than the space has is an error.

    Without ``estimator`` a random forest is searched: a classifier where
    ``label`` has less than 50 values, else a regressor. ``space`` and
    ``evaluator`` may then be None too (``forest_space``; accuracy or R2)."""
    if space is not None:
        _check_settings(space, iterations)
    if estimator is None:
        classes = few_levels(df, "label", MOST_CLASSES)
        estimator = (RandomForestClassifier if classes else RandomForestRegressor)(seed=seed)
        space = space or forest_space(len(df.select("features").first()[0]), classes)
        evaluator = evaluator or (MulticlassClassificationEvaluator(metricName="accuracy") if classes
                                  else RegressionEvaluator(metricName="r2"))
    total = _check_settings(space, iterations)
    maps = []
    for number in random.Random(seed).sample(range(total), iterations):
        choice = {}
        for n, vals in space.items():
            number, i = divmod(number, len(vals))
            choice[estimator.getParam(n)] = vals[i]
        maps.append(choice)
    return cross_validate(estimator, df, evaluator, key, folds, seed, maps, parallelism)


# ------------------------------------------------------------- ensembles


def staged_ensemble_error(df: DataFrame, features, label: str, key: str, max_iter: int = 20,
                          seed: int = 46, classification: bool = True, forest: bool = False) -> DataFrame:
    """``staged_ensemble_error``: test loss after each stage of one fit.

    Boosting: every prefix with ``evaluateEachIteration``. With ``forest``:
    prefixes of one random forest, misclassification (binary labels) or mean
    squared error of the mean over the first trees; all prefixes are one
    aggregate over the scored rows.
    """
    train, test = holdout(df, key, 0.3, seed)
    if forest:
        est = (RandomForestClassifier if classification else RandomForestRegressor)(numTrees=max_iter, seed=seed)
        cur, cols = assemble(test, features, label).select("features", "label"), []
        for i, tree in enumerate(est.fit(assemble(train, features, label)).trees):
            tree.setPredictionCol(f"_t{i}")
            value = F.col(f"_t{i}")
            if classification:
                tree.setProbabilityCol(f"_p{i}").setRawPredictionCol(f"_r{i}")
                value = vector_to_array(f"_p{i}")[1]
            cols.append(f"_v{i}")
            cur = tree.transform(cur).withColumn(cols[-1], value).select("features", "label", *cols)
        losses, total = [], F.lit(0.0)
        for i, c in enumerate(cols):
            total = total + F.col(c)
            mean = total / (i + 1)
            loss = ((mean > 0.5).cast("double") != F.col("label")).cast("double") if classification \
                else (mean - F.col("label")) * (mean - F.col("label"))
            losses.append(F.avg(loss).alias(c))
        errs = list(cur.agg(*losses).first())
        return df.sparkSession.createDataFrame([(i + 1, float(e)) for i, e in enumerate(errs)],
                                               "n_trees INT, loss DOUBLE")
    est = (GBTClassifier if classification else GBTRegressor)(maxIter=max_iter, seed=seed)
    model = est.fit(assemble(train, features, label))
    te = assemble(test, features, label)
    errs = (model.evaluateEachIteration(te) if classification
            else model.evaluateEachIteration(te, "squared"))
    return df.sparkSession.createDataFrame([(i + 1, float(e)) for i, e in enumerate(errs)],
                                           "n_trees INT, loss DOUBLE")


def f1_cutoff_cv(df: DataFrame, features, label: str, key: str, folds: int = 5, seed: int = 46,
                 grid=None, **gbt_params) -> DataFrame:
    """``f1_cutoff_cv``: per fold, fit boosted trees on the other folds, find
    the F1-optimal cutoff (default grid: 100 points on [0, 0.1]) on the
    held-out fold; report each fold's best and their mean."""
    data = assemble(split_kfold(df, key, folds, seed), features, label, ["fold"]).cache()
    rows = []
    for k in range(folds):
        model = GBTClassifier(seed=seed, **gbt_params).fit(data.filter(F.col("fold") != k))
        scored = model.transform(data.filter(F.col("fold") == k)).select(
            "label", vector_to_array("probability")[1].alias("p"))
        cut = list(grid) if grid is not None else [float(x) for x in np.linspace(0, 0.1, 100)]
        best = f1_by_threshold(scored, "label", "p", grid=cut).filter("is_best").first()
        rows.append((k, float(best["threshold"]), float(best["f1"])))
    data.unpersist()
    mean_t = float(np.mean([r[1] for r in rows]))
    return df.sparkSession.createDataFrame(
        [(k, t, f, mean_t) for k, t, f in rows],
        "fold INT, best_threshold DOUBLE, best_f1 DOUBLE, mean_threshold DOUBLE")


def blend_predictions(train: DataFrame, score: DataFrame, features, label: str, n_models: int = 3,
                      seed: int = 46, num_trees: int = 20, classification: bool | None = None,
                      key: str | None = None, average: bool = True) -> DataFrame:
    """``blend_predictions``: refit the same forest with ``n_models`` seeds and
    average (or return all) predictions; chained ``transform`` calls add one
    column per model, so no join is needed. A label with less than 50 values
    (whole numbers from 0) gives class probabilities, unless ``classification``
    says otherwise."""
    if classification is None:
        classification = few_levels(train, label, MOST_CLASSES)
    tr = assemble(train, features, label)
    cur = assemble(score, features, None, [key] if key else [])
    cols = []
    seeds = [seed + i for i in range(n_models)]
    models = ([RandomForestClassifier(numTrees=num_trees, seed=i).fit(tr) for i in seeds] if classification
              else fit_forests(tr, num_trees, seeds))
    keep = [key] if key else []
    if isinstance(models[0], CellTrees):
        return cur.select(*keep, blended(models, average).alias("blended"))
    for i, m in enumerate(models):
        out = f"_p{i}"
        m.setPredictionCol(out)
        if classification:
            m.setProbabilityCol(f"_prob{i}").setRawPredictionCol(f"_raw{i}")
        cur = m.transform(cur)
        cols.append(vector_to_array(F.col(f"_prob{i}")) if classification else F.col(out))
    if classification:
        arrs = F.array(*cols)
        mean = F.aggregate(arrs, F.array_repeat(F.lit(0.0), F.size(cols[0])),
                           lambda acc, a: F.zip_with(acc, a, lambda x, y: x + y))
        res = F.transform(mean, lambda x: x / n_models) if average else arrs
    else:
        res = (sum(cols) / n_models) if average else F.array(*cols)
    return cur.select(*keep, res.alias("blended"))


# -------------------------------------------------------------- intervals


def _interp_percentile(arr, q: float):
    """Linear-interpolated percentile (numpy default) of an array column."""
    s = F.array_sort(arr)
    n = F.size(s)
    pos = (n - 1).cast("double") * q
    lo = F.floor(pos).cast("int")
    hi = F.ceil(pos).cast("int")
    a = F.element_at(s, lo + 1)
    b = F.element_at(s, hi + 1)
    return a + (b - a) * (pos - lo)


def intervals_forest(model, data: DataFrame, percentile: float = 0.95, keep=()) -> DataFrame:
    """``intervals_forest``: per-row percentile band of the individual trees'
    predictions (each tree's ``transform`` is narrow; no join)."""
    if isinstance(model, CellTrees):
        places = [(1 - percentile) / 2, (1 + percentile) / 2]
        band = model.column(lambda v: np.column_stack([*np.quantile(v, places, axis=1), v.mean(axis=1)]), "array<double>")
        return data.select(*keep, band.alias("_b")).select(*keep, F.col("_b")[0].alias("lower_PI"), F.col("_b")[2].alias("prediction"),
                                                          F.col("_b")[1].alias("upper_PI"))
    cur = data
    cols = []
    for i, tree in enumerate(model.trees):
        tree.setPredictionCol(f"_t{i}")
        cur = tree.transform(cur)
        cols.append(F.col(f"_t{i}"))
        cur = cur.select(*keep, "features", *cols)
    arr = F.array(*cols)
    lo_q, hi_q = (1 - percentile) / 2, (1 + percentile) / 2
    return cur.select(*keep, _interp_percentile(arr, lo_q).alias("lower_PI"),
                      F.aggregate(arr, F.lit(0.0), lambda a, x: a + x).alias("_s"),
                      _interp_percentile(arr, hi_q).alias("upper_PI")) \
        .withColumn("prediction", F.col("_s") / len(cols)).drop("_s") \
        .select(*keep, "lower_PI", "prediction", "upper_PI")


def quantile_fit(data: DataFrame, tau: float, max_iter: int = 50, tol: float = 1e-7,
                 floor: float = 1e-4):
    """``quantile_fits`` of one quantile: (coefficients, pinball loss)."""
    return quantile_fits(data, [tau], max_iter, tol, floor)[0]


def quantile_fits(data: DataFrame, taus, max_iter: int = 50, tol: float = 1e-7,
                  floor: float = 1e-4) -> list:
    """Linear quantile regressions by iteratively reweighted least squares, one
    per quantile of ``taus``, side by side.

    Each step is ONE aggregate over all rows that yields, for every quantile
    still moving, both the pinball loss of the current coefficients and the
    weighted normal equations (sum w x x', sum w x y) for the next ones; the
    (d+1) x (d+1) solves run on the driver. All start from least squares with
    the intercept shifted to the residual quantile; one stops when its pinball
    loss stops improving. Cells are persisted as plain columns.
    """
    d = len(data.first()["features"])
    cells = vector_to_array("features")
    base = data.select(*[cells[i].alias(f"x{i}") for i in range(d)], F.col("label").alias("y")) \
        .persist(StorageLevel.MEMORY_AND_DISK)
    x, y = [*[F.col(f"x{i}") for i in range(d)], F.lit(1.0)], F.col("y")

    def pred(beta):
        e = F.lit(0.0)
        for i in range(d + 1):
            e = e + x[i] * F.lit(float(beta[i]))
        return e

    def equations(name, w):
        return [F.sum(w * x[i] * x[j]).alias(f"a{name}_{i}_{j}") for i in range(d + 1) for j in range(i, d + 1)] \
            + [F.sum(w * x[i] * y).alias(f"b{name}_{i}") for i in range(d + 1)]

    def solve(r, name):
        A = np.zeros((d + 1, d + 1))
        for i in range(d + 1):
            for j in range(i, d + 1):
                A[i, j] = A[j, i] = r[f"a{name}_{i}_{j}"]
        return np.linalg.lstsq(A, np.array([r[f"b{name}_{i}"] for i in range(d + 1)]), rcond=None)[0]

    def steps(betas):
        """{number: (pinball loss of beta, next beta)} from one pass."""
        rest = base.withColumns({f"r{n}": y - pred(beta) for n, beta in betas.items()})
        weights, aggs = {}, []
        for n in betas:
            r, tau = F.col(f"r{n}"), taus[n]
            weights[f"w{n}"] = F.when(r >= 0, F.lit(tau)).otherwise(F.lit(1 - tau)) / F.greatest(F.abs(r), F.lit(floor))
            aggs += [F.avg(F.greatest(r * tau, r * (tau - 1))).alias(f"loss{n}"), *equations(n, F.col(f"w{n}"))]
        r = one_row(rest.withColumns(weights), *aggs)
        return {n: (r[f"loss{n}"], solve(r, n)) for n in betas}

    least = solve(one_row(base, *equations(0, F.lit(1.0))), 0)
    shifts = quantiles(base.select((y - pred(least)).alias("_res")), "_res", taus)
    moving = {n: least + np.append(np.zeros(d), shift) for n, shift in enumerate(shifts)}
    best = {n: (beta, None) for n, beta in moving.items()}
    for _ in range(max_iter):
        for n, (loss, after) in steps(moving).items():
            before = best[n][1]
            if before is None or loss < before:
                best[n] = (moving[n], loss)
            if before is not None and loss > before - tol * max(abs(before), 1.0):
                del moving[n]
            else:
                moving[n] = after
        if not moving:
            break
    base.unpersist()
    return [best[n] for n in range(len(taus))]


def intervals_quantile(train: DataFrame, score: DataFrame, features, label: str,
                       confidence: float = 0.95, keep=(), max_iter: int = 50) -> DataFrame:
    """``intervals_quantile``: lower/upper linear quantile models at
    ``(1 -/+ c) / 2`` plus a least-squares point model; returns
    ``lower_PI, prediction, upper_PI`` per scored row."""
    tr = assemble(train, features, label)
    (lo_b, _), (hi_b, _) = quantile_fits(tr, [(1 - confidence) / 2, (1 + confidence) / 2], max_iter)
    point = LinearRegression().fit(tr)

    def lin(beta):
        e = F.lit(float(beta[-1]))
        for i, f in enumerate(features):
            e = e + F.col(f) * F.lit(float(beta[i]))
        return e

    scored = point.transform(assemble(score, features, None, [*keep, *features]))
    return scored.select(*keep, lin(lo_b).alias("lower_PI"), "prediction",
                         lin(hi_b).alias("upper_PI"))


def intervals_quantile_boosted(train: DataFrame, score: DataFrame, features, label: str, key: str,
                               confidence: float = 0.95, keep=(), rounds: int = 100, depth: int = 3,
                               learning_rate: float = 0.1, validation_share: float = 0.1, patience: int = 10,
                               seed: int = 46) -> DataFrame:
    """``intervals_quantile``, boosted branch: lower/upper bounds by boosting on
    the pinball loss, each stopped by a keyed validation part, and a boosted
    least-squares prediction; returns ``lower_PI, prediction, upper_PI``."""
    held = split_holdout(train, key, validation_share, seed)
    tr = assemble(held.withColumn("_held", F.col("split") == "test"), features, label, ["_held"])
    bounds = boost_quantiles(tr, [(1 - confidence) / 2, (1 + confidence) / 2], rounds, depth, learning_rate,
                             F.col("_held"), patience, seed=seed)
    point = fit_boosted(tr, 20, max_depth=depth, seed=seed)
    scored = point.transform(assemble(score, features, None, [*keep]))
    return (scored.withColumn("x", vector_to_array("features"))
            .select(*keep, bounds[0].predict().alias("lower_PI"), "prediction", bounds[1].predict().alias("upper_PI")))


# ---------------------------------------------------------- selection etc


def rfe_logistic(df: DataFrame, features, label: str, key: str, min_features: int = 3,
                 test_size: float = 0.3, seed: int = 46, step: int = 1, folds: int = 5,
                 parallelism: int = 8) -> DataFrame:
    """``rfe_logistic``: recursive elimination from all features down to
    ``min_features``, one row per size. The features are chosen on the training
    part of a holdout split: after each fit the ``step`` features with the
    smallest standardised coefficients (|coef| x std) go. ``accuracy`` is the
    mean over ``folds`` folds of all rows; with ``folds=0`` that of the holdout.

    Two classes: Newton steps, each one scan (``newton``). An elimination starts
    from the coefficients before it; then the folds of all sizes are fitted side
    by side in the same scans. More classes: one Spark ML fit per size and fold.
    """
    classes = sorted(r[0] for r in df.select(F.col(label).cast("double")).distinct().limit(3).collect() if r[0] is not None)
    if classes != [0.0, 1.0]:
        return _rfe_multinomial(df, features, label, key, min_features, test_size, seed, step, folds, parallelism)
    feats = list(features)
    rows = split_holdout(df, key, test_size, seed)
    rows = split_kfold(rows, key, folds, seed) if folds else rows.withColumn("fold", F.lit(0))
    data = standardised(rows, feats, label, ["split", "fold"]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        left, coefs, chosen = list(range(len(feats))), None, []
        while True:
            model = newton(data, [Fit(left, "0=test", coefs)])[0]
            chosen.append(model)
            if len(left) <= min_features:
                break
            weak = np.argsort(np.abs(model.coefs[1:]), kind="stable")
            kept = np.sort(weak[min(step, len(left) - min_features):])
            left, coefs = [left[i] for i in kept], model.coefs[[0, *(kept + 1)]]
        if folds:
            fits = newton(data, [Fit(m.columns, f"1={k}", m.coefs) for m in chosen for k in range(folds)])
            scores = np.array(accuracies(data, fits)).reshape(len(chosen), folds).mean(axis=1)
        else:
            scores = accuracies(data, chosen)
    finally:
        data.unpersist()
    out = [(len(m.columns), ",".join(feats[i] for i in m.columns), float(a)) for m, a in zip(chosen, scores)]
    return df.sparkSession.createDataFrame(out, "n_features INT, features STRING, accuracy DOUBLE")


def _rfe_multinomial(df: DataFrame, features, label: str, key: str, min_features: int, test_size: float,
                     seed: int, step: int, folds: int, parallelism: int) -> DataFrame:
    """The fold fits of one size run beside the eliminations that follow it."""
    feats = list(features)
    stds = one_row(df, *[F.stddev_samp(f).alias(f) for f in feats])
    rows = split_holdout(df, key, test_size, seed)
    rows = split_kfold(rows, key, folds, seed) if folds else rows.withColumn("fold", F.lit(0))
    # one assembled vector; each size takes a slice of it
    data = assemble(rows, feats, label, ["split", "fold"]).persist(StorageLevel.MEMORY_AND_DISK)

    def fit(left, where):
        cut = VectorSlicer(inputCol="features", outputCol="_sliced", indices=left)
        return cut, LogisticRegression(featuresCol="_sliced", maxIter=50).fit(cut.transform(data.filter(where)))

    def accuracy(cut, model, where):
        hit = (F.col("prediction") == F.col("label")).cast("double")
        return model.transform(cut.transform(data.filter(where))).agg(F.avg(hit)).first()[0]

    def fold_accuracy(left, k):
        return accuracy(*fit(left, F.col("fold") != k), F.col("fold") == k)

    left, found = list(range(len(feats))), []
    pool = ThreadPoolExecutor(parallelism)
    try:
        while True:
            cut, model = fit(left, "split = 'train'")
            waits = [pool.submit(inheritable_thread_target(df.sparkSession)(fold_accuracy), left, k) for k in range(folds)] or \
                [pool.submit(accuracy, cut, model, "split = 'test'")]
            found.append((left, waits))
            if len(left) <= min_features:
                break
            coefs = np.abs(model.coefficientMatrix.toArray()).max(axis=0)
            weak = np.argsort([coefs[n] * (stds[feats[i]] or 0.0) for n, i in enumerate(left)], kind="stable")
            gone = set(weak[:min(step, len(left) - min_features)].tolist())
            left = [i for n, i in enumerate(left) if n not in gone]
        out = [(len(left), ",".join(feats[i] for i in left), float(np.mean([w.result() for w in waits])))
               for left, waits in found]
    finally:
        pool.shutdown(cancel_futures=True)
        data.unpersist()
    return df.sparkSession.createDataFrame(out, "n_features INT, features STRING, accuracy DOUBLE")


def kmeans_sweep(df: DataFrame, features, max_clusters: int = 10, scale: bool = True,
                 seed: int = 46) -> DataFrame:
    """``kmeans_sweep``: k-means inertia (within-cluster sum of squares) for
    k = 2..max, optionally after min-max scaling."""
    from .encode import scale_minmax
    src = scale_minmax(df, features) if scale else df
    data = assemble(src, features).cache()
    rows = []
    for k in range(2, max_clusters + 1):
        m = KMeans(k=k, seed=seed).fit(data)
        rows.append((k, float(m.summary.trainingCost)))
    data.unpersist()
    return df.sparkSession.createDataFrame(rows, "k INT, inertia DOUBLE")


def feature_importance(model, names, top_n: int | None = None, spark=None) -> DataFrame:
    """``feature_importance``: importances scaled so the largest is 100,
    sorted descending, optionally the top n."""
    imp = model.featureImportances.toArray()
    mx = float(imp.max()) if len(imp) and imp.max() > 0 else 1.0
    rows = sorted(((n, float(v) * 100.0 / mx) for n, v in zip(names, imp)),
                  key=lambda r: (-r[1], r[0]))
    if top_n:
        rows = rows[:top_n]
    return spark.createDataFrame([(i, n, v) for i, (n, v) in enumerate(rows)],
                                 "rank INT, feature STRING, importance DOUBLE")


def tree_nodes(model, path: str, spark) -> DataFrame:
    """``tree_nodes``: a fitted tree's node table read back from its saved
    data (id, prediction, impurity, gain, children, split feature/threshold,
    training count)."""
    model.write().overwrite().save(path)
    data = spark.read.parquet(os.path.join(path, "data"))
    if "nodeData" in data.columns:
        data = data.select("nodeData.*")
    return data.select(
        F.col("id"), F.col("prediction"), F.col("impurity"), F.col("gain"),
        F.col("leftChild").alias("left_child"), F.col("rightChild").alias("right_child"),
        F.when(F.col("leftChild") >= 0, F.col("split.featureIndex")).alias("feature_index"),
        F.when(F.col("leftChild") >= 0, F.col("split.leftCategoriesOrThreshold")[0])
         .alias("threshold"),
        (F.col("rawCount") if "rawCount" in data.columns else F.lit(None).cast("long"))
        .alias("count")).orderBy("id")


def shap_linear(model, data: DataFrame, features, keep=()) -> DataFrame:
    """``shap_values`` for a linear model: ``coef_j * (x_j - mean_j)``; the
    values plus the base value (mean prediction) add up to the prediction."""
    means = one_row(data, *[F.avg(f).alias(f) for f in features])
    coefs = list(map(float, model.coefficients))
    base = float(model.intercept) + sum(c * means[f] for c, f in zip(coefs, features))
    vals = [(F.col(f) - F.lit(means[f])) * F.lit(c) for c, f in zip(coefs, features)]
    return data.select(*keep, *[v.alias(f"shap_{f}") for v, f in zip(vals, features)],
                       F.lit(base).alias("base_value"))


# ------------------------------------------------------------ leaderboards


def leaderboard_regression(train: DataFrame, test: DataFrame, features, label: str,
                           seed: int = 46, num_trees: int = 100) -> DataFrame:
    """``leaderboard_regression``: R2 / RMSE / MAE / fit seconds for linear,
    tree, k-NN (5 neighbours, exact), support vector (RBF kernel, approximate),
    forest and boosted-tree regressors on the same split. The time of k-NN is
    that of its lookups."""
    tr, te = assemble(train, features, label).cache(), assemble(test, features, label)
    fit = lambda est: lambda: est.fit(tr).transform(te)
    models = [("linear", fit(LinearRegression())),
              ("decision_tree", fit(DecisionTreeRegressor(seed=seed))),
              ("knn", lambda: knn_predict(tr, te)),
              ("svr_rbf_approximate", lambda: fit_svr(tr, seed=seed).transform(te)),
              ("random_forest", lambda: fit_forest(tr, num_trees, seed).transform(te)),
              ("gradient_boosting", lambda: fit_boosted(tr, num_trees, 0.1, 3, seed).transform(te))]
    rows = []
    for name, predict in models:
        t0 = time.perf_counter()
        p = predict()
        secs = time.perf_counter() - t0
        r = metrics_regression(p, "label", "prediction").first()
        rows.append((name, float(r["r2"]), float(r["rmse"]), float(r["mae"]), float(secs)))
    tr.unpersist()
    return train.sparkSession.createDataFrame(
        rows, "model STRING, r2 DOUBLE, rmse DOUBLE, mae DOUBLE, fit_seconds DOUBLE")


def leaderboard_classification(train: DataFrame, test: DataFrame, features, label: str,
                               seed: int = 46, num_trees: int = 100) -> DataFrame:
    """``leaderboard_classification``: accuracy, micro and macro precision,
    recall and F1, support, log loss, AUC (binary only) and fit seconds for
    logistic (L1), tree, k-NN (5 neighbours, exact), forest, boosted trees,
    linear SVM, SVM with RBF kernel (approximate, calibrated) and a
    one-hidden-layer perceptron. Labels are whole numbers from 0."""
    tr, te = assemble(train, features, label).cache(), assemble(test, features, label)
    classes = sorted(r["label"] for r in tr.select("label").distinct().collect())
    k = len(classes)
    binary = k == 2
    gbt = GBTClassifier(maxIter=num_trees, stepSize=0.1, maxDepth=3, seed=seed)
    svc = LinearSVC(maxIter=50)
    fit = lambda est: lambda: est.fit(tr).transform(te)
    models = [("logistic_l1", fit(LogisticRegression(elasticNetParam=1.0, regParam=0.01))),
              ("decision_tree", fit(DecisionTreeClassifier(seed=seed))),
              ("knn", lambda: knn_predict(tr, te, classes=classes)),
              ("svc_rbf_approximate", lambda: fit_svc(tr, seed=seed).transform(te)),
              ("random_forest", fit(RandomForestClassifier(numTrees=num_trees, seed=seed))),
              ("gradient_boosting", fit(gbt if binary else OneVsRest(classifier=gbt))),
              ("linear_svc", fit(svc if binary else OneVsRest(classifier=svc))),
              ("mlp", fit(MultilayerPerceptronClassifier(layers=[len(features), 100, int(max(classes)) + 1],
                                                         seed=seed, maxIter=100)))]
    acc = MulticlassClassificationEvaluator(metricName="accuracy")
    rows = []
    for name, predict in models:
        t0 = time.perf_counter()
        p = predict()
        secs = time.perf_counter() - t0
        p = p.cache()
        a = acc.evaluate(p)
        over = {r["class"]: r for r in metrics_by_class(p, "label", "prediction")
                .filter("class IN ('micro', 'macro')").collect()}
        micro, macro = over["micro"], over["macro"]
        ll = auc = None
        if "probability" in p.columns:
            ll = MulticlassClassificationEvaluator(metricName="logLoss").evaluate(p)
            if binary:
                auc = BinaryClassificationEvaluator(rawPredictionCol="probability",
                                                    metricName="areaUnderROC").evaluate(p)
        p.unpersist()
        rows.append((name, float(a), float(micro["f1"]), float(micro["precision"]), float(micro["recall"]), float(macro["precision"]), float(macro["recall"]), float(macro["f1"]),
                     int(macro["support"]), ll, auc, float(secs)))
    tr.unpersist()
    return train.sparkSession.createDataFrame(
        rows, "model STRING, accuracy DOUBLE, f1_micro DOUBLE, precision_micro DOUBLE, recall_micro DOUBLE, precision_macro DOUBLE, recall_macro DOUBLE, "
              "f1_macro DOUBLE, support BIGINT, log_loss DOUBLE, auc DOUBLE, "
              "fit_seconds DOUBLE")


# ----------------------------------------------------------- curves


def learning_curve(df: DataFrame, features, label: str, key: str, estimator, evaluator,
                   sizes=(0.1, 0.325, 0.55, 0.775, 1.0), folds: int = 3, seed: int = 46) -> DataFrame:
    """``learning_curve``: train/test score for growing training subsets (a
    keyed-draw prefix of each fold's training rows)."""
    from ..functions.random import draw_uniform
    data = assemble(split_kfold(df, key, folds, seed), features, label, ["fold", key]) \
        .withColumn("_u", draw_uniform(key, seed + 1)).cache()
    rows = []
    for size in sizes:
        for k in range(folds):
            tr = data.filter((F.col("fold") != k) & (F.col("_u") < size))
            m = estimator.fit(tr)
            rows.append((float(size), k, float(evaluator.evaluate(m.transform(tr))),
                         float(evaluator.evaluate(m.transform(data.filter(F.col("fold") == k))))))
    data.unpersist()
    return df.sparkSession.createDataFrame(
        rows, "train_fraction DOUBLE, fold INT, train_score DOUBLE, test_score DOUBLE")


def _weighted_score(metric: str, scored: DataFrame) -> float:
    """rmse, mse or r2 of weighted points (Spark ML's r2 takes the weights for
    another variance than that of as many rows)."""
    y, w, rest = F.col("label"), F.col("weight"), F.col("label") - F.col("prediction")
    r = one_row(scored, F.sum(w).alias("n"), F.sum(w * y).alias("s"), F.sum(w * y * y).alias("q"), F.sum(w * rest * rest).alias("e"))
    if metric == "r2":
        return 1 - r["e"] / (r["q"] - r["s"] * r["s"] / r["n"])
    return r["e"] / r["n"] if metric == "mse" else math.sqrt(r["e"] / r["n"])


def validation_curve(df: DataFrame, features, label: str, key: str, estimator, evaluator,
                     param: str, values, folds: int = 3, seed: int = 46) -> DataFrame:
    """``validation_curve``: train/test score per parameter value and fold. A
    regression tree under a squared-error metric needs only the sums of each
    fold's cells, which weighted points carry."""
    split, data, score = split_kfold(df, key, folds, seed), None, evaluator.evaluate
    bins = estimator.getMaxBins() if isinstance(estimator, DecisionTreeRegressor) else 0
    if (bins and bins ** len(features) <= MOST_CELLS and not estimator.isSet("weightCol") and estimator.getMinInstancesPerNode() == 1
            and param == "maxDepth" and isinstance(evaluator, RegressionEvaluator) and evaluator.getMetricName() in ("rmse", "mse", "r2")
            and not evaluator.isSet("weightCol")):
        # one scan for the sums needs the folds, the others two or three columns: no row is stored
        plain = plain_columns(split, features, label, ["fold"])
        size = None if plain is None else known_rows(plain, "label")
        if size is not None:
            data = weighted_cells(plain, size, len(features), "fold", folds, bins, seed, plain=True).cache()
            estimator, score = estimator.copy({estimator.weightCol: "weight"}), partial(_weighted_score, evaluator.getMetricName())
    if data is None:
        data = assemble(split, features, label, ["fold"]).cache()
    rows = []
    for v in values:
        for k in range(folds):
            tr = data.filter(F.col("fold") != k)
            m = estimator.copy({estimator.getParam(param): v}).fit(tr)
            rows.append((str(v), k, float(score(m.transform(tr))),
                         float(score(m.transform(data.filter(F.col("fold") == k))))))
    data.unpersist()
    return df.sparkSession.createDataFrame(
        rows, "param_value STRING, fold INT, train_score DOUBLE, test_score DOUBLE")


# -------------------------------------------------------- serving


def train_and_export(df: DataFrame, features, label: str, key: str, path: str, seed: int = 46):
    """``train_and_export``: assembler + logistic regression pipeline, holdout
    accuracy, saved to ``path``. Returns ``(model, accuracy)``."""
    train, test = holdout(df, key, 0.3, seed)
    pipe = Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"),
                            LogisticRegression(featuresCol="features", labelCol=label, maxIter=100)])
    model = pipe.fit(train)
    acc = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy") \
        .evaluate(model.transform(test))
    model.write().overwrite().save(path)
    return model, acc


def save_model(model, directory: str, name: str, add_timestamp: bool = True, today=None) -> str:
    """``save_model``: write under ``directory``, inserting ``_YYYYMMDD``."""
    suffix = f"_{(today or date.today()).strftime('%Y%m%d')}" if add_timestamp else ""
    path = os.path.join(directory, f"{name}{suffix}")
    model.write().overwrite().save(path)
    return path


def load_model(path: str):
    """``load_model``."""
    return PipelineModel.load(path)


def score_batch(model, df: DataFrame, class_names: dict, keep=()) -> DataFrame:
    """``score_batch``: class name, probability per class and the caller's key."""
    from ..functions.scalar import label_map
    p = model.transform(df)
    return p.select(*keep, label_map(F.col("prediction").cast("int"), class_names).alias("prediction"),
                    vector_to_array("probability").alias("probabilities"))


# --------------------------------------------------- composed recipes


def sliding_window_evaluation(df: DataFrame, features, label: str, order_by: str,
                              num_windows: int = 5, test_size: float = 0.2, *, key,
                              reg_param: float = 0.03, elastic_net: float = 1.0) -> DataFrame:
    """``sliding_window_evaluation``: consecutive time windows; in each, an
    L1 linear fit on the first rows and its test RMSE on the rest. One row
    per window: sizes, train R2 and RMSE, test RMSE; plus their mean."""
    from .window import head_per_window
    split = head_per_window(df, order_by, num_windows, test_size, key=key).cache()
    data = assemble(split, features, label, ["window_num", "split"]).cache()
    ev = RegressionEvaluator(metricName="rmse")
    rows = []
    for w in range(1, num_windows + 1):
        tr = data.filter((F.col("window_num") == w) & (F.col("split") == "train"))
        te = data.filter((F.col("window_num") == w) & (F.col("split") == "test"))
        n_tr, n_te = tr.count(), te.count()
        if n_tr == 0:
            continue
        m = LinearRegression(elasticNetParam=elastic_net, regParam=reg_param).fit(tr)
        test_rmse = ev.evaluate(m.transform(te)) if n_te else None
        rows.append((w, n_tr, n_te, float(m.summary.r2), float(m.summary.rootMeanSquaredError),
                     test_rmse))
    data.unpersist()
    split.unpersist()
    mean_rmse = float(np.mean([r[5] for r in rows if r[5] is not None])) if rows else None
    return df.sparkSession.createDataFrame(
        [(*r, mean_rmse) for r in rows],
        "window INT, n_train BIGINT, n_test BIGINT, r2 DOUBLE, train_rmse DOUBLE, "
        "test_rmse DOUBLE, mean_test_rmse DOUBLE")


def _level_association(df: DataFrame, column: str, numeric: list) -> dict:
    """Correlation ratio of every numeric column with the levels of ``column``."""
    known = df.filter(F.col(column).isNotNull())
    value = {c: F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in numeric}
    total = one_row(known, *[f(value[c]).alias(f"{n}{i}") for i, c in enumerate(numeric)
                             for n, f in (("n", F.count), ("m", F.avg), ("v", F.var_pop))])
    each = known.groupBy(column).agg(*[f(value[c]).alias(f"{n}{i}") for i, c in enumerate(numeric)
                                       for n, f in (("n", F.count), ("m", F.avg))]).collect()
    out = {}
    for i, c in enumerate(numeric):
        if total[f"v{i}"]:
            between = sum(r[f"n{i}"] * (r[f"m{i}"] - total[f"m{i}"]) ** 2 for r in each if r[f"n{i}"])
            out[c] = math.sqrt(between / (total[f"n{i}"] * total[f"v{i}"]))
    return out


def _impute_levels(df: DataFrame, column: str, key: str, threshold: float, folds: int, num_trees: int, seed: int):
    """``impute_model`` for a string or boolean column: the levels in order
    become 0, 1, ..., a classifier fills them, and they are mapped back."""
    if not few_levels(df, column, MOST_LEVELS):
        raise ValueError(f"{column} has more than {MOST_LEVELS} levels")
    levels = sorted(r[0] for r in df.select(column).distinct().collect() if r[0] is not None)
    numeric = [c for c, kind in df.dtypes if c not in (key, column)
               and kind in ("double", "float", "int", "bigint", "smallint", "tinyint")]
    preds = [c for c, r in _level_association(df, column, numeric).items() if r >= threshold] if levels else []
    code = "_code_of_levels"
    coded = df.withColumn(code, (F.array_position(F.array(*map(F.lit, levels)), F.col(column)) - 1).cast("int")
                          if levels else F.lit(None).cast("int"))
    filled, report = _impute_from(coded, code, key, preds, folds, num_trees, True, seed)
    if preds:
        back = F.get(F.array(*map(F.lit, levels)), F.col(code))
        filled = filled.withColumn(column, F.coalesce(F.col(column), back))
    return filled.select(*df.columns), report.withColumn("column", F.lit(column))


def impute_model(df: DataFrame, column: str, key: str, corr_threshold: float = 0.5,
                 folds: int = 3, num_trees: int = 100, categorical: bool | None = None,
                 seed: int = 46):
    """``impute_model``: fill missing cells of ``column`` with a random
    forest fitted on the columns correlated with it (|r| >= threshold).

    Returns ``(filled, report)``. Predictors missing at scoring time get the
    predictor's mean; only missing cells are replaced. With no correlated
    predictor the frame is returned unchanged and the report says so.

    A string or boolean column with at most 25 levels is filled by a classifier
    with levels of its own type, and its predictors are chosen by the
    correlation ratio (the root of the share of variance between levels; |r|
    for two levels). More levels are an error. A numeric column is filled by a
    regressor unless ``categorical`` is set (whole numbers from 0).
    """
    if isinstance(df.schema[column].dataType, (T.StringType, T.BooleanType)):
        return _impute_levels(df, column, key, corr_threshold, folds, num_trees, seed)
    num = [c for c, t_ in df.dtypes if c not in (key, column)
           and t_ in ("double", "float", "int", "bigint", "smallint", "tinyint")]
    y = F.nanvl(F.col(column).cast("double"), F.lit(None))
    stats = one_row(df, *[safe_corr(F.col(c).cast("double"), y).alias(c) for c in num])
    preds = [c for c in num if stats[c] is not None and abs(stats[c]) >= corr_threshold]
    return _impute_from(df, column, key, preds, folds, num_trees, bool(categorical), seed)


def _impute_from(df: DataFrame, column: str, key: str, preds: list, folds: int, num_trees: int,
                 categorical: bool, seed: int):
    """Fill ``column`` from the predictors ``preds``; ``(filled, report)``."""
    stats = one_row(df, F.avg(missing(df, column).cast("double")).alias("_pm"))
    stats["_pm"] = stats["_pm"] or 0.0  # no rows
    spark = df.sparkSession
    if not preds:
        rep = spark.createDataFrame([(column, float(stats["_pm"] * 100), None, None, "")],
                                    "column STRING, percent_missing DOUBLE, cv_score DOUBLE, "
                                    "train_score DOUBLE, predictors STRING")
        return df, rep
    df = df.persist(StorageLevel.MEMORY_AND_DISK)  # read by the fits, the CV and the scoring
    complete = df.na.drop(subset=[column, *preds])
    est = (RandomForestClassifier if categorical else RandomForestRegressor)(
        numTrees=num_trees, seed=seed)
    ev = (MulticlassClassificationEvaluator(metricName="accuracy") if categorical
          else RegressionEvaluator(metricName="r2"))
    data = assemble(complete, preds, column, [key]).persist(StorageLevel.MEMORY_AND_DISK)
    _, cvres = cross_validate(est, data, ev, key, folds, seed)
    model = est.fit(data)
    train_score = ev.evaluate(model.transform(data))
    means = one_row(df, *[F.avg(c).alias(c) for c in preds])
    # the same rows are scored, so nothing has to be joined back
    wide = df.withColumns({f"_f{i}": F.coalesce(F.col(c).cast("double"), F.lit(means[c])) for i, c in enumerate(preds)})
    vec = VectorAssembler(inputCols=[f"_f{i}" for i in range(len(preds))], outputCol="_features")
    model.setFeaturesCol("_features").setPredictionCol("_prediction")
    if categorical:
        model.setProbabilityCol("_probability").setRawPredictionCol("_raw")
    kind = df.schema[column].dataType
    whole = isinstance(kind, (T.IntegerType, T.LongType, T.ShortType, T.ByteType))
    fill = F.round("_prediction") if whole else F.col("_prediction")
    out = model.transform(vec.transform(wide)).withColumn(
        column, F.when(missing(df, column), fill.cast(kind)).otherwise(F.col(column))).select(*df.columns)
    rep = spark.createDataFrame(
        [(column, float(stats["_pm"] * 100), float(cvres.first()["metric"]), float(train_score),
          ",".join(preds))],
        "column STRING, percent_missing DOUBLE, cv_score DOUBLE, train_score DOUBLE, "
        "predictors STRING")
    return out, rep
