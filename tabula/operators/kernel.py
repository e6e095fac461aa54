"""Kernel machines over random Fourier features, approximate by construction.

``RandomFourierFeatures`` maps a vector to cosines whose dot products
approximate the RBF kernel ``exp(-gamma * |x - y|^2)`` (error about
``1 / sqrt(dims)``). A linear model over them stands in for the kernel model:
Huber regression for support vector regression, a linear SVM per class for
the classifier, whose probabilities are sigmoids of held-out margins.
Features are divided by their largest absolute value first.

Spark ML's Huber regression stores the mapped vectors (``dims`` numbers a row)
and scans them up to a hundred times. Above ``SMALL_ROWS`` rows the same
objective is minimised by Newton steps, each one scan of packed rows that
forms the cosines anew, once for equal vectors of a block.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark import StorageLevel, inheritable_thread_target, keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import LinearSVC
from pyspark.ml.feature import MaxAbsScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, HasSeed
from pyspark.ml.regression import LinearRegression
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import Packed
from .cells import known_rows
from .newton import Fit, newton

#: Residuals over so many scales count linearly (Spark ML's default).
HUBER = 1.35
#: Vectors mapped at a time.
MAPPED = 2048


class RandomFourierFeatures(Transformer, HasInputCol, HasOutputCol, HasSeed, DefaultParamsReadable,
                            DefaultParamsWritable):
    """Vector column -> vector of ``dims`` random cosines. The draws follow from
    ``seed`` and the vector's length, so the saved stage is its parameters."""

    gamma = Param(Params._dummy(), "gamma", "width of the kernel", typeConverter=TypeConverters.toFloat)
    dims = Param(Params._dummy(), "dims", "number of features", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, gamma=1.0, dims=128, seed=46):
        super().__init__()
        self._setDefault(gamma=1.0, dims=128, seed=46)
        self._set(**self._input_kwargs)

    def draws(self):
        """Function of the vectors' length: frequencies and phases."""
        dims, seed, scale = self.getOrDefault(self.dims), self.getSeed(), np.sqrt(2 * self.getOrDefault(self.gamma))

        def drawn(width: int):
            rng = np.random.default_rng(seed)
            return rng.standard_normal((width, dims)) * scale, rng.uniform(0, 2 * np.pi, dims)

        return drawn

    def _transform(self, dataset: DataFrame) -> DataFrame:
        dims, draws = self.getOrDefault(self.dims), self.draws()

        @F.pandas_udf("array<double>")
        def cosines(v: pd.Series) -> pd.Series:
            if not len(v):
                return pd.Series([], dtype=object)
            x = np.stack(v.to_numpy())
            turns, begin = draws(x.shape[1])
            return pd.Series(list(np.sqrt(2 / dims) * np.cos(x @ turns + begin)))

        return dataset.withColumn(self.getOutputCol(), array_to_vector(cosines(vector_to_array(self.getInputCol()))))


def _mapping(train: DataFrame, dims: int, seed: int, gamma: float | None) -> PipelineModel:
    """Scaling and features. ``gamma`` is ``1 / (width * variance)`` of all
    scaled cells unless given (1 where they do not vary)."""
    scaler = MaxAbsScaler(inputCol="features", outputCol="_scaled").fit(train)
    if gamma is None:
        x = vector_to_array("_scaled")
        sums = scaler.transform(train).agg(
            F.sum(F.size(x)).alias("n"), F.max(F.size(x)).alias("width"),
            F.sum(F.aggregate(x, F.lit(0.0), lambda a, v: a + v)).alias("s"),
            F.sum(F.aggregate(x, F.lit(0.0), lambda a, v: a + v * v)).alias("q")).first()
        spread = sums["q"] / sums["n"] - (sums["s"] / sums["n"]) ** 2 if sums["n"] else 0.0
        gamma = 1 / (sums["width"] * spread) if spread > 1e-12 else 1.0
    return PipelineModel([scaler, RandomFourierFeatures(inputCol="_scaled", outputCol="_cosines", gamma=gamma, dims=dims, seed=seed)])


class RandomFourierRegression(RandomFourierFeatures):
    """A linear model over the random cosines of a vector column, whose
    ``prediction`` is formed without storing them."""

    coefficients = Param(Params._dummy(), "coefficients", "weights of the features", typeConverter=TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "intercept", typeConverter=TypeConverters.toFloat)
    width = Param(Params._dummy(), "width", "length of the vectors", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, gamma=1.0, dims=128, seed=46, coefficients=None, intercept=0.0, width=1):
        Transformer.__init__(self)
        self._setDefault(gamma=1.0, dims=128, seed=46, intercept=0.0, width=1)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        dims, width, (turns, begin) = self.getOrDefault(self.dims), self.getOrDefault(self.width), self.draws()(self.getOrDefault(self.width))
        weights, intercept = np.sqrt(2 / dims) * np.array(self.getOrDefault(self.coefficients)), self.getOrDefault(self.intercept)

        @F.pandas_udf("double")
        def predicted(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for x in parts:
                x = np.stack(x, axis=1)
                yield pd.Series(np.concatenate([np.cos(x[at:at + MAPPED] @ turns + begin) @ weights + intercept
                                                for at in range(0, len(x), MAPPED)] or [np.zeros(0)]))

        cells = vector_to_array(self.getInputCol())
        return dataset.withColumn(self.getOutputCol(), predicted(*[cells[i] for i in range(width)]))


def _by_vector(x: np.ndarray) -> np.ndarray:
    """Rows of vector and label as the number of distinct vectors, how often
    each comes, the vectors, and the labels in their order."""
    code = np.zeros(len(x), np.int64)
    for column in x[:, :-1].T:
        found, place = np.unique(column, return_inverse=True)
        code = np.unique(code * len(found) + place, return_inverse=True)[1]
    order = np.argsort(code, kind="stable")
    first = np.flatnonzero(np.diff(code[order], prepend=-1))
    return np.concatenate([[len(first)], np.diff(first, append=len(x)), x[order[first], :-1].ravel(), x[order, -1]])


def _huber(rows: Packed, stage: RandomFourierFeatures, theta: np.ndarray, sigma: float, epsilon: float):
    """Over all rows, with intercept and coefficients ``theta`` and scale ``sigma``:
    loss, gradient, Hessian of ``theta``, and the sums of residual and squared
    residual over the rows that count quadratically (by feature, and of all),
    and the number of these."""
    dims, width = stage.getOrDefault(stage.dims), rows.width - 1
    turns, begin = stage.draws()(width)
    scale, k = np.sqrt(2 / dims), dims + 1

    def part(flat, total):
        loss, slope, curve, lean, ends = total[:1], total[1:1 + k], total[1 + k:1 + k + k * k].reshape(k, k), total[-k - 2:-2], total[-2:]
        m = int(flat[0])
        counts, vectors, y = flat[1:1 + m].astype(np.int64), flat[1 + m:1 + m + m * width].reshape(m, width), flat[1 + m + m * width:]
        after = np.cumsum(counts)
        for at in range(0, m, MAPPED):
            n = counts[at:at + MAPPED]
            z = np.ones((len(n), k))
            np.cos(vectors[at:at + MAPPED] @ turns + begin, out=z[:, 1:])
            z[:, 1:] *= scale
            off = y[after[at] - n[0]:after[at + len(n) - 1]] - np.repeat(z @ theta, n)
            size = np.abs(off)
            near = size <= epsilon * sigma
            square = np.where(near, off, 0.0)
            first = np.cumsum(n) - n
            pull = np.where(near, off / sigma, np.copysign(min(epsilon, 1e300), off))
            loss += 0.5 * (sigma * len(off) + square @ square / sigma + ((2 * size - sigma * epsilon)[~near] * epsilon).sum())
            slope += np.add.reduceat(pull, first) @ z
            weighted = z * np.sqrt(np.add.reduceat(near, first, dtype=np.float64))[:, None]
            curve += weighted.T @ weighted
            lean += np.add.reduceat(square, first) @ z
            ends += square @ square, near.sum()

    total = rows.add_up(part, 3 + 2 * k + k * k)
    return total[0], total[1:1 + k], total[1 + k:1 + k + k * k].reshape(k, k), total[-k - 2:-2], total[-2], total[-1]


def _huber_fit(rows: Packed, stage: RandomFourierFeatures, n: int, reg: float, max_steps: int = 50, gain: float = 1e-9) -> np.ndarray:
    """Intercept and coefficients of least ``mean(sigma + H(residual / sigma) sigma) / 2
    + reg |coefficients x deviations|^2 / 2``, with the scale ``sigma`` fitted too (the
    objective of Spark ML). From least squares on, a Newton step each scan; a
    step that loses is halved. The driver holds ``dims^2`` numbers."""
    k = stage.getOrDefault(stage.dims) + 1
    _, slope, curve, _, squares, _ = _huber(rows, stage, np.zeros(k), 1.0, np.inf)
    mean = curve[0] / n
    ridge = reg * np.maximum(np.diag(curve) / n - mean ** 2, 0.0) * n / max(1, n - 1)
    ridge[0] = 0.0

    def solved(a, v):
        return np.linalg.lstsq(a + 1e-12 * np.trace(a) / len(a) * np.eye(len(a)), v, rcond=1e-13)[0]

    theta = solved(curve / n + np.diag(ridge), slope / n)
    rest = squares / n - 2 * theta @ slope / n + theta @ curve @ theta / n
    at = np.append(theta, np.sqrt(max(rest, 1e-12 * squares / n, 1e-300)))
    best, step, last = np.inf, None, at
    for _ in range(max_steps):
        theta, sigma = at[:-1], at[-1]
        loss, slope, curve, lean, squares, near = _huber(rows, stage, theta, sigma, HUBER)
        value = loss / n + 0.5 * ridge @ theta ** 2
        if value > best + 1e-12 * abs(best):
            step = step / 2
            at = last + step
            if np.abs(step).max() <= 1e-12 * np.abs(last).max():
                break
            continue
        last, best = at, value
        slope = np.append(ridge * theta - slope / n, 0.5 * (near - squares / sigma ** 2 + (n - near) * (1 - HUBER ** 2)) / n)
        bend = np.zeros((k + 1, k + 1))
        bend[:k, :k] = curve / (n * sigma) + np.diag(ridge)
        bend[:k, k] = bend[k, :k] = lean / (n * sigma ** 2)
        bend[k, k] = squares / (n * sigma ** 3)
        step = -solved(bend, slope)
        if -(slope @ step) <= gain * abs(best):
            break
        if sigma + step[-1] < 0.1 * sigma:  # the scale stays above zero
            step = step * (-0.9 * sigma / step[-1])
        at = last + step
    return last[:-1]


def fit_svr(train: DataFrame, c: float = 1.0, dims: int = 128, seed: int = 46,
            gamma: float | None = None) -> PipelineModel:
    """Huber regression over the mapped ``features`` of ``train`` (``label``); a
    savable pipeline."""
    scaler, stage = _mapping(train, dims, seed, gamma).stages
    n = known_rows(train, "label")
    if n is None:
        mapping = PipelineModel([scaler, stage])
        huber = LinearRegression(featuresCol="_cosines", loss="huber", regParam=1 / (c * max(1, train.count())))
        return PipelineModel([*mapping.stages, huber.fit(mapping.transform(train))])
    width = len(train.select("features").first()[0])
    cells = scaler.transform(train).select(F.concat(vector_to_array("_scaled"), F.array("label")).alias("x"))
    rows = Packed(cells, "x", width + 1, n, seed, _by_vector)
    try:
        theta = _huber_fit(rows, stage, n, 1 / (c * n))
    finally:
        rows.unpersist()
    return PipelineModel([scaler, RandomFourierRegression(
        inputCol="_scaled", outputCol="prediction", gamma=float(stage.getOrDefault(stage.gamma)), dims=dims, seed=seed,
        coefficients=[float(v) for v in theta[1:]], intercept=float(theta[0]), width=width)])


class RbfSvc:
    """A fitted classifier: mapping, margins per fold model and class (the last
    is the model of all rows), sigmoids. ``transform`` adds ``prediction`` (by
    margin) and ``probability`` (indexed by label, sums to 1)."""

    def __init__(self, mapping: PipelineModel, classes: list, weights: np.ndarray, sigmoids: np.ndarray | None = None):
        self.mapping, self.classes, self.weights, self.sigmoids = mapping, classes, weights, sigmoids

    def margins(self, mapped: DataFrame, fold) -> DataFrame:
        """Adds ``_margins``, by the model of ``fold`` (a column or -1)."""
        weights = mapped.sparkSession.sparkContext.broadcast(self.weights)  # folds x classes x dims

        @F.pandas_udf("array<double>")
        def score(v: pd.Series, f: pd.Series) -> pd.Series:
            if not len(v):
                return pd.Series([], dtype=object)
            x, w = np.stack(v.to_numpy()), weights.value
            out, fold_ = np.zeros((len(x), w.shape[1])), f.to_numpy()
            for i in np.unique(fold_):
                rows = fold_ == i
                out[rows] = x[rows] @ w[i, :, 1:].T + w[i, :, 0]
            return pd.Series(list(out))

        return mapped.withColumn("_margins", score(vector_to_array("_cosines"), fold))

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.margins(self.mapping.transform(df), F.lit(-1))
        a, b = (F.array(*[F.lit(float(v)) for v in col]) for col in self.sigmoids.T)
        sure = F.zip_with(F.zip_with(b, "_margins", lambda s, m: s * m), a, lambda x, y: 1 / (1 + F.exp(-(x + y))))
        if len(self.classes) == 2:
            chance = F.array(1 - sure[0], sure[0])
            place = F.when(F.col("_margins")[0] > 0, 1).otherwise(0)
        else:
            total = F.aggregate(sure, F.lit(0.0), lambda s, v: s + v)
            chance = F.transform(sure, lambda v: v / total)
            place = F.array_position("_margins", F.array_max("_margins")).cast("int") - 1
        labels = F.array(*[F.lit(float(c)) for c in self.classes])
        spots = [self.classes.index(i) + 1 if i in self.classes else 0 for i in range(int(max(self.classes)) + 1)]
        out = out.withColumn("_chance", chance).withColumn("prediction", F.get(labels, place))
        cells = F.array(*[F.element_at("_chance", s) if s else F.lit(0.0) for s in spots])
        return out.withColumn("probability", array_to_vector(cells)).drop("_scaled", "_cosines", "_margins", "_chance")


def fit_svc(train: DataFrame, c: float = 1.0, folds: int = 3, dims: int = 128, seed: int = 46,
            gamma: float | None = None, max_iter: int = 50) -> RbfSvc:
    """One linear SVM per class (one for two classes) over the mapped
    ``features`` of ``train`` (``label``: whole numbers from 0).

    The sigmoid of a class is fitted by Newton steps to the margins that
    models of the other folds give the rows of a fold, with the smoothed
    targets ``(n1 + 1) / (n1 + 2)`` and ``1 / (n0 + 2)``. Equal vectors share a fold.
    """
    counts = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    classes, n = sorted(counts), sum(counts.values())
    if len(classes) < 2:
        raise ValueError("a classifier needs at least two classes")
    targets = classes[1:] if len(classes) == 2 else classes
    mapping = _mapping(train, dims, seed, gamma)
    fold = F.pmod(F.xxhash64(vector_to_array("features"), F.lit(seed)), F.lit(folds)).cast("int").alias("_fold")
    data = mapping.transform(train).select("label", "_cosines", fold).persist(StorageLevel.MEMORY_AND_DISK)

    def fit(job):
        target, left_out = job
        rows = data if left_out is None else data.filter(F.col("_fold") != left_out)
        rows = rows.select("_cosines", (F.col("label") == target).cast("double").alias("_y"))
        present = rows.agg(F.min("_y").alias("low"), F.max("_y").alias("high")).first()
        if present["low"] == present["high"]:  # one side is missing outside this fold
            return np.concatenate([[1.0 if present["low"] else -1.0], np.zeros(dims)])
        m = LinearSVC(featuresCol="_cosines", labelCol="_y", regParam=1 / (c * n), maxIter=max_iter).fit(rows)
        return np.concatenate([[m.intercept], m.coefficients.toArray()])

    def sigmoid(i):
        ones = counts[targets[i]]
        y = F.when(F.col("label") == targets[i], (ones + 1) / (ones + 2)).otherwise(1 / (n - ones + 2))
        return newton(held.select(F.array(F.col("_margins")[i]).alias("x"), y.alias("y")), [Fit([0])], gain=1e-6)[0].coefs

    jobs = [(t, f) for f in (*range(folds), None) for t in targets]
    with ThreadPoolExecutor(8) as pool:
        found = list(pool.map(inheritable_thread_target(train.sparkSession)(fit), jobs))
        model = RbfSvc(mapping, classes, np.array(found).reshape(folds + 1, len(targets), dims + 1))
        held = model.margins(data, F.col("_fold")).select("label", "_margins").persist(StorageLevel.MEMORY_AND_DISK)
        held.count()
        model.sigmoids = np.array(list(pool.map(inheritable_thread_target(train.sparkSession)(sigmoid), range(len(targets)))))
    held.unpersist()
    data.unpersist()
    return model


def knn_predict(train: DataFrame, test: DataFrame, k: int = 5, classes: list | None = None) -> DataFrame:
    """``test`` with ``prediction``: the mean label of the ``k`` nearest rows of
    ``train``, or with ``classes`` the most frequent label (ties: the smallest)
    and ``probability``, the shares of labels. Equal test vectors are looked up once."""
    from .neighbors import knn_join
    number = F.monotonically_increasing_id().alias("_id")
    known = train.select(number, vector_to_array("features").alias("_x"), F.col("label").alias("_label")).checkpoint()
    asked = test.select(vector_to_array("features").alias("_x")).distinct().select(number.alias("_asked"), "_x").checkpoint()
    near = (knn_join(asked, known, "_asked", "_id", "_x", k).select("_asked", F.col("neighbor_id").alias("_id"))
            .join(known.select("_id", "_label"), "_id"))
    if classes is None:
        said = near.groupBy("_asked").agg(F.avg("_label").alias("prediction"))
    else:
        shares = [F.avg((F.col("_label") == i).cast("double")) for i in range(int(max(classes)) + 1)]
        said = near.groupBy("_asked").agg(F.array(*shares).alias("_shares"))
        said = said.select("_asked", array_to_vector("_shares").alias("probability"),
                           (F.array_position("_shares", F.array_max("_shares")) - 1).cast("double").alias("prediction"))
    return (test.withColumn("_x", vector_to_array("features"))
            .join(asked.join(said, "_asked").drop("_asked"), "_x").drop("_x"))
