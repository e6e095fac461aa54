"""Encoding, scaling and projection."""

from __future__ import annotations

import math

from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.random import draw_uniform
from ..functions.scalar import nan_to_null
from ..plans.scale import one_row


def assemble_features(df: DataFrame, feature_cols, label_col: str | None = None,
                      out_col: str = "features", handle_invalid: str = "error",
                      keep=()) -> DataFrame:
    """``assemble_features``: feature vector (+ ``label``), as the recipe does."""
    va = VectorAssembler(inputCols=list(feature_cols), outputCol=out_col,
                         handleInvalid=handle_invalid)
    out = va.transform(df)
    cols = [*keep, out_col]
    if label_col:
        cols.append(F.col(label_col).cast("double").alias("label"))
    return out.select(*cols)


def one_hot_encode(df: DataFrame, column: str, drop_last: bool = True) -> DataFrame:
    """``one_hot_encode``: index by frequency (ties alphabetical), one-hot,
    drop the index column; output ``<column>_one_hot`` (a sparse vector)."""
    idx = StringIndexer(inputCol=column, outputCol="_category_index",
                        stringOrderType="frequencyDesc").fit(df)
    enc = OneHotEncoder(inputCol="_category_index", outputCol=f"{column}_one_hot",
                        dropLast=drop_last)
    indexed = idx.transform(df)
    return enc.fit(indexed).transform(indexed).drop("_category_index")


def target_encode(train: DataFrame, test: DataFrame, variable: str, label: str,
                  smoothing: float = 1.0, min_samples_leaf: int = 1, noise_level: float = 0.0,
                  seed: int = 46, key: str | None = None):
    """``target_encode``: smoothed mean of ``label`` per level of ``variable``.

    ``w = 1 / (1 + exp(-(n - min_samples_leaf) / smoothing))``,
    ``enc = prior * (1 - w) + mean * w``; unseen or NULL levels get the prior.
    Returns ``(train, test)`` each with ``<variable>_mean`` added. The level
    table is a partial aggregate joined back.
    """
    out_col = f"{variable}_mean"
    y = nan_to_null(train, label)
    prior = one_row(train, F.avg(y).alias("p"))["p"]
    stats = train.groupBy(variable).agg(F.avg(y).alias("_m"), F.count(y).alias("_n"))
    w = 1.0 / (1.0 + F.exp(-(F.col("_n") - F.lit(min_samples_leaf)) / F.lit(float(smoothing))))
    enc = stats.select(variable, (F.lit(prior) * (1 - w) + F.col("_m") * w).alias("_enc"))
    enc = enc.filter(F.col(variable).isNotNull())

    def apply(df, salt):
        out = df.join(enc, variable, "left").withColumn(
            out_col, F.coalesce(F.col("_enc"), F.lit(prior))).drop("_enc")
        if noise_level:
            if key is None:
                raise ValueError("noise needs a key column: draws are a function of the row's key")
            # Box-Muller on two keyed draws: the same noise on any cluster, after any retry
            u, v = draw_uniform(key, seed + 2 * salt), draw_uniform(key, seed + 2 * salt + 1)
            normal = F.sqrt(-2 * F.log1p(-u)) * F.cos(v * (2 * math.pi))
            out = out.withColumn(out_col, F.col(out_col) * (1 + noise_level * normal))
        return out

    return apply(train, 0), apply(test, 1)


def _minmax_stats(df, columns):
    aggs = []
    for c in columns:
        v = nan_to_null(df, c)
        aggs += [F.min(v).alias(f"min_{c}"), F.max(v).alias(f"max_{c}")]
    return one_row(df, *aggs)


def scale_minmax(df: DataFrame, columns, fitted_on: DataFrame | None = None) -> DataFrame:
    """``scale_minmax``: ``(x - min) / (max - min)``; a constant column maps to 0
    (sklearn), not 0.5 (Spark's MinMaxScaler)."""
    st = _minmax_stats(fitted_on or df, columns)
    out = {}
    for c in columns:
        lo, hi = st[f"min_{c}"], st[f"max_{c}"]
        rng = (hi - lo) if (hi is not None and lo is not None and hi != lo) else 1.0
        out[c] = (F.col(c) - F.lit(lo)) / F.lit(rng)
    return df.withColumns(out)


def scale_standard(df: DataFrame, columns, fitted_on: DataFrame | None = None) -> DataFrame:
    """``scale_standard``: ``(x - mean) / population std`` (std 0 -> divide by 1)."""
    src = fitted_on or df
    aggs = []
    for c in columns:
        v = nan_to_null(src, c)
        aggs += [F.avg(v).alias(f"m_{c}"), F.stddev_pop(v).alias(f"s_{c}")]
    st = one_row(src, *aggs)
    return df.withColumns({c: (F.col(c) - F.lit(st[f"m_{c}"])) / F.lit(st[f"s_{c}"] or 1.0)
                           for c in columns})


def scale_maxabs(df: DataFrame, columns, fitted_on: DataFrame | None = None) -> DataFrame:
    """``scale_maxabs``: divide each column by its largest absolute value,
    fitted on ``fitted_on`` (the training rows) and applied to ``df``."""
    src = fitted_on or df
    st = one_row(src, *[F.max(F.abs(nan_to_null(src, c))).alias(c) for c in columns])
    return df.withColumns({c: F.col(c) / F.lit(st[c] or 1.0) for c in columns})


def pca_fit(df: DataFrame, columns, num_components: float = 0.99, key: str | None = None):
    """``pca_fit``: min-max scale, PCA, keep k components (k given, or the
    smallest prefix whose explained variance reaches the fraction).

    The covariance is one distributed aggregate inside ``pyspark.ml.PCA``;
    only the d x d eigenproblem runs on the driver. Spark's transform does not
    center, so the mean projection is subtracted; component signs are fixed
    so that each component's largest-magnitude loading is positive.
    Returns ``(scores, explained)``: ``scores`` has ``key`` and ``pc`` (array),
    ``explained`` one row per component with its variance percent.
    """
    import numpy as np
    from pyspark.ml.feature import PCA

    scaled = scale_minmax(df, columns)
    vec = VectorAssembler(inputCols=list(columns), outputCol="_x").transform(scaled)
    d = len(columns)
    model = PCA(k=d, inputCol="_x", outputCol="_pc").fit(vec)
    ev = np.array(model.explainedVariance.toArray())
    if num_components >= 1:
        k = int(num_components)
    else:
        k = int(np.searchsorted(np.cumsum(ev), num_components - 1e-12) + 1)
        k = min(k, d)
    pcs = model.pc.toArray()[:, :k]
    signs = np.sign(pcs[np.argmax(np.abs(pcs), axis=0), range(k)])
    signs[signs == 0] = 1
    means = one_row(scaled, *[F.avg(c).alias(c) for c in columns])
    mu = np.array([means[c] for c in columns])
    shift = mu @ pcs
    # JVM-side projection (PCAModel.transform), then center and fix signs
    # on the first k entries with literal arrays: no UDF, no huge codegen.
    sh = F.array(*[F.lit(float(x)) for x in shift])
    sg = F.array(*[F.lit(float(x)) for x in signs])
    proj = F.slice(vector_to_array(F.col("_pc")), 1, k)
    pc = F.transform(proj, lambda x, i: (x - sh[i]) * sg[i])
    keep = [key] if key else []
    scores = model.transform(vec).select(*keep, pc.alias("pc"))
    explained = df.sparkSession.createDataFrame(
        [(j, float(ev[j] * 100)) for j in range(k)], "component INT, variance_percent DOUBLE")
    return scores, explained


def one_hot_index_array(df: DataFrame, column: str) -> DataFrame:
    """``one_hot_encode`` output as a dense int array (for inspection)."""
    return df.withColumn(f"{column}_one_hot",
                         vector_to_array(F.col(f"{column}_one_hot")).cast("array<int>"))
