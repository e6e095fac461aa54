"""Packed rows: sums up to a rank, and the detectors that scan them."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabula.operators import anomaly as A
from tabula.operators.blocks import Packed


def _arrays(spark, x):
    return spark.createDataFrame(pd.DataFrame({"k": np.arange(len(x)), "_x": list(map(list, x))}), "k long, _x array<double>")


@pytest.mark.parametrize("bracket", [None, (3.0, 3.001), (-9.0, -8.9)])
def test_sums_up_to_an_exact_rank(spark, bracket):
    """Missing cells are left out, a tie at the cut comes whole, and a bracket
    beside the cut is widened."""
    x = np.random.default_rng(5).normal(size=(4000, 2))
    x[100:140, 0] = np.sort(x[:, 0])[1500]  # ties
    frame = _arrays(spark, x).union(spark.sql("SELECT 9999L, array(1.0D, CAST(NULL AS DOUBLE))"))
    rows = Packed(frame, "_x", 2, len(x), 1)
    assert len(rows.sample) == len(x)

    def part(v):
        return v[:, :1].T, np.stack([np.ones(len(v)), v[:, 1]])

    ranked = x[np.argsort(x[:, 0])]
    for rank in (1, 700, 1501, 4000):
        cuts, sums = rows.sums_to_rank(part, 2, 300, rows.sample[:, :1].T, rank, rank / len(x), True,
                                       bracket and tuple(np.array([v]) for v in bracket))
        below = ranked[ranked[:, 0] <= ranked[rank - 1, 0]]
        assert sums[0, 0] == len(below) and sums[0, 1] == pytest.approx(below[:, 1].sum())
        assert below[-1, 0] < cuts[0] and (len(below) == len(x) or cuts[0] <= ranked[len(below), 0])
        near, some = rows.sums_to_rank(part, 2, 300, rows.sample[:, :1].T, rank, rank / len(x))
        assert rank <= some[0, 0] <= len(below) + 40
    rows.unpersist()


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.multivariate_normal([10, -5, 1000], [[2, .8, 0], [.8, 1, .3], [0, .3, .5]], 2100),
                        rng.multivariate_normal([22, 9, 1012], 0.05 * np.eye(3), 900)])
    return spark.createDataFrame(pd.DataFrame({"k": np.arange(len(x)), "a": x[:, 0], "b": x[:, 1], "c": x[:, 2]}))


def _both(monkeypatch, run):
    """Result by plain rows and by packed rows, and the scans of the packed ones."""
    plain, scans, add_up = run(), [], Packed.add_up
    monkeypatch.setattr(A, "PACKED_ROWS", 1000)
    monkeypatch.setattr(Packed, "add_up", lambda self, *a: scans.append(1) or add_up(self, *a))
    return plain, run(), len(scans)


def test_packed_covariance_is_as_small(monkeypatch, cloud):
    base = cloud.select("k", F.array("a", "b", "c").alias("_x"))
    (_, cov), (mean, packed), scans = _both(monkeypatch, lambda: A.robust_covariance(base, "k", 3000, 3))
    assert np.abs(mean - [10, -5, 1000]).max() < 0.15
    assert A._log_det(packed) == pytest.approx(A._log_det(cov), abs=0.05)
    assert scans > 5


def test_packed_one_class_decides_alike(monkeypatch, cloud):
    run = lambda: A.outliers_one_class(cloud, ["a", "b", "c"], "k", max_iter=6).toPandas().sort_values("k")
    plain, packed, scans = _both(monkeypatch, run)
    assert 6 <= scans <= 8  # about one a step
    assert np.abs(plain["decision"] - packed["decision"]).max() < 0.01 * plain["decision"].std()
    assert (plain["is_outlier"] != packed["is_outlier"]).mean() < 0.005


def test_all_rows_go_down_a_tree_together():
    x = np.random.default_rng(7).normal(size=(300, 2))
    tree = tuple(map(np.array, A._grow(x[:200], np.random.default_rng(8), 7)))
    feat, thr, left, right, size = tree

    def walk(row, at=0):
        if feat[at] < 0:
            return A._c(size[at])
        return 1 + walk(row, left[at] if row[feat[at]] < thr[at] else right[at])

    assert A._path_lengths(x, tree) == pytest.approx([walk(r) for r in x])
