"""Path-dependent Tree SHAP for Spark ML decision trees and random forests.

The fitted trees (node tables read back from the saved model: split feature,
threshold, children, training count, leaf value) are bounded by the model
size, so they are broadcast; each task computes the attributions of its rows
with the polynomial-time path algorithm of Lundberg et al. (2018) in
``mapInPandas``, vectorised over each Arrow batch (the path state is shared
by all rows; per-row fractions and weights are numpy vectors).
The forest's attribution is the mean over trees, and
``sum(shap) + base_value`` equals the model's prediction for every row.
"""

from __future__ import annotations

import os

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cells import CellTrees, by_cell, tree_borders


def tree_tables(model, path: str, spark, positive_class: int = 1) -> list:
    """Per tree: arrays (left, right, feature, threshold, value, cover)."""
    if isinstance(model, CellTrees):
        return model.trees
    model.write().overwrite().save(path)
    data = spark.read.parquet(os.path.join(path, "data"))
    if "treeID" not in data.columns:
        data = data.withColumn("treeID", F.lit(0))
    nd = data.select("treeID", "nodeData.*")
    classifier = "impurityStats" in nd.columns and "Classification" in type(model).__name__
    cols = ["treeID", "id", "leftChild", "rightChild", "split.featureIndex",
            "split.leftCategoriesOrThreshold", "prediction", "rawCount"]
    if classifier:
        cols.append("impurityStats")
    pdf = nd.select(*[F.col(c) for c in cols]).toPandas()  # bounded by the model size
    trees = []
    for _, g in pdf.sort_values(["treeID", "id"]).groupby("treeID"):
        left = g["leftChild"].to_numpy(dtype=np.int64)
        right = g["rightChild"].to_numpy(dtype=np.int64)
        feat = np.where(left >= 0, g["featureIndex"].fillna(-1).to_numpy(), -1).astype(np.int64)
        thr = np.array([t_[0] if t_ is not None and len(t_) else np.nan
                        for t_ in g["leftCategoriesOrThreshold"]], dtype=np.float64)
        if classifier:
            stats = [np.asarray(s, dtype=np.float64) for s in g["impurityStats"]]
            value = np.array([s[positive_class] / s.sum() if s.sum() > 0 else 0.0 for s in stats])
        else:
            value = g["prediction"].to_numpy(dtype=np.float64)
        cover = g["rawCount"].to_numpy(dtype=np.float64)
        trees.append((left, right, feat, thr, value, cover))
    return trees


def expected_value(tree) -> float:
    left, right, feat, thr, value, cover = tree
    leaves = left < 0
    return float((value[leaves] * cover[leaves]).sum() / cover[0])


def _extend(m, pz, po, pi):
    m = [list(e) for e in m]
    ln = len(m)
    m.append([pi, pz, po, 1.0 if ln == 0 else 0.0])
    for i in range(ln - 1, -1, -1):
        m[i + 1][3] += po * m[i][3] * (i + 1) / (ln + 1)
        m[i][3] = pz * m[i][3] * (ln - i) / (ln + 1)
    return m


def _unwind(m, i):
    m = [list(e) for e in m]
    ln = len(m) - 1
    n = m[ln][3]
    zi, oi = m[i][1], m[i][2]
    for j in range(ln - 1, -1, -1):
        if oi != 0:
            t_ = m[j][3]
            m[j][3] = n * (ln + 1) / ((j + 1) * oi)
            n = t_ - m[j][3] * zi * (ln - j) / (ln + 1)
        else:
            m[j][3] = m[j][3] * (ln + 1) / (zi * (ln - j))
    for j in range(i, ln):
        m[j][0], m[j][1], m[j][2] = m[j + 1][0], m[j + 1][1], m[j + 1][2]
    return m[:ln]


def _unwound_sum(m, i):
    return sum(e[3] for e in _unwind(m, i))


def tree_shap_row(x: np.ndarray, tree, d: int) -> np.ndarray:
    """Path-dependent SHAP values of one row for one tree (Spark routes a
    row left when ``x[feature] <= threshold``)."""
    left, right, feat, thr, value, cover = tree
    phi = np.zeros(d)

    def recurse(j, m, pz, po, pi):
        m = _extend(m, pz, po, pi)
        if left[j] < 0:
            for i in range(1, len(m)):
                w = _unwound_sum(m, i)
                phi[m[i][0]] += w * (m[i][2] - m[i][1]) * value[j]
            return
        f = feat[j]
        hot, cold = (left[j], right[j]) if x[f] <= thr[j] else (right[j], left[j])
        iz = io = 1.0
        k = next((i for i in range(1, len(m)) if m[i][0] == f), None)
        if k is not None:
            iz, io = m[k][1], m[k][2]
            m = _unwind(m, k)
        recurse(hot, m, iz * cover[hot] / cover[j], io, f)
        recurse(cold, m, iz * cover[cold] / cover[j], 0.0, f)

    recurse(0, [], 1.0, 1.0, -1)
    return phi


def tree_shap_batch(x: np.ndarray, tree, d: int) -> np.ndarray:
    """``tree_shap_row`` for every row of ``x`` at once.

    The path state (split features and zero fractions) is the same for all
    rows; only the one fractions and the permutation weights depend on the
    row, so they are carried as vectors and every step is a numpy operation
    over the whole batch.
    """
    left, right, feat, thr, value, cover = tree
    n = x.shape[0]
    phi = np.zeros((n, d))

    def extend(m, pz, po, pi):
        m = [[e[0], e[1], e[2], e[3].copy()] for e in m]
        ln = len(m)
        m.append([pi, pz, po, np.ones(n) if ln == 0 else np.zeros(n)])
        for i in range(ln - 1, -1, -1):
            m[i + 1][3] = m[i + 1][3] + po * m[i][3] * ((i + 1) / (ln + 1))
            m[i][3] = pz * m[i][3] * ((ln - i) / (ln + 1))
        return m

    def unwind(m, i):
        m = [[e[0], e[1], e[2], e[3].copy()] for e in m]
        ln = len(m) - 1
        nn = m[ln][3].copy()
        zi, oi = m[i][1], m[i][2]
        nz = oi != 0
        safe_o = np.where(nz, oi, 1.0)
        for j in range(ln - 1, -1, -1):
            t_ = m[j][3]
            w_one = nn * (ln + 1) / ((j + 1) * safe_o)
            w_zero = t_ * (ln + 1) / (zi * (ln - j)) if zi != 0 else np.zeros(n)
            nn = np.where(nz, t_ - w_one * zi * (ln - j) / (ln + 1), nn)
            m[j][3] = np.where(nz, w_one, w_zero)
        for j in range(i, ln):
            m[j][0], m[j][1], m[j][2] = m[j + 1][0], m[j + 1][1], m[j + 1][2]
        return m[:ln]

    def recurse(j, m, pz, po, pi):
        m = extend(m, pz, po, pi)
        if left[j] < 0:
            for i in range(1, len(m)):
                w = sum(e[3] for e in unwind(m, i))
                phi[:, m[i][0]] += w * (m[i][2] - m[i][1]) * value[j]
            return
        f = feat[j]
        go_left = x[:, f] <= thr[j]
        iz, io = 1.0, np.ones(n)
        k = next((i for i in range(1, len(m)) if m[i][0] == f), None)
        if k is not None:
            iz, io = m[k][1], m[k][2]
            m = unwind(m, k)
        recurse(left[j], m, iz * cover[left[j]] / cover[j], np.where(go_left, io, 0.0), f)
        recurse(right[j], m, iz * cover[right[j]] / cover[j], np.where(go_left, 0.0, io), f)

    if n:
        recurse(0, [], 1.0, np.ones(n), -1)
    return phi


def shap_values_trees(model, data: DataFrame, features, key: str, path: str,
                      positive_class: int = 1) -> DataFrame:
    """``shap_values`` for a decision tree or random forest: one column per
    feature ``shap_<name>`` plus ``base_value`` and ``model_output``."""
    spark = data.sparkSession
    trees = tree_tables(model, path, spark, positive_class)
    base = float(np.mean([expected_value(t_) for t_ in trees]))
    bc = spark.sparkContext.broadcast(trees)
    d = len(features)
    key_type = dict(data.dtypes)[key]

    def run(it):
        ts, known = bc.value, {}
        borders = tree_borders(ts, d)
        # rows between the same thresholds have equal values: each cell is explained once
        explain = lambda x: sum((tree_shap_batch(x, t_, d) for t_ in ts), np.zeros((len(x), d))) / max(len(ts), 1)
        for p in it:
            x = p[list(features)].to_numpy(dtype=np.float64)
            out = by_cell(x, borders, known, explain).reshape(-1, d)
            res = pd.DataFrame(out, columns=[f"shap_{f}" for f in features])
            res.insert(0, key, p[key].to_numpy())
            res["base_value"] = base
            res["model_output"] = out.sum(1) + base
            yield res

    schema = f"{key} {key_type}, " + ", ".join(f"shap_{f} double" for f in features) + \
        ", base_value double, model_output double"
    return data.select(key, *[F.col(f).cast("double") for f in features]).mapInPandas(run, schema)


def mean_abs_shap(shap: DataFrame, features) -> DataFrame:
    """Global importance: mean absolute attribution per feature (long form)."""
    wide = shap.agg(*[F.avg(F.abs(f"shap_{f}")).alias(f) for f in features])
    return wide.unpivot([], list(features), "feature", "mean_abs_shap")
