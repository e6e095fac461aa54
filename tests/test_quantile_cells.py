"""Quantile boosting from cells (F3): ranks, losses and bounds."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabula.operators import boosting, cells, models


@pytest.fixture()
def frame(spark):
    rows = spark.range(0, 6000, 1, 4).select("id", (F.col("id") % 20).cast("double").alias("a"), F.rand(7).alias("b"), F.randn(8).alias("e"))
    return models.assemble(rows.withColumn("y", F.col("a") + F.round(F.col("e") * (1 + F.col("b")), 2)), ["a", "b"], "y", ["id"]).cache()


def test_bounds_are_those_of_the_rows(frame, monkeypatch):
    held = F.col("id") % 10 == 0
    want = [boosting.boost_quantile(frame, tau, 8, 3, 0.3, held, 10) for tau in (0.1, 0.9)]
    monkeypatch.setattr(cells, "SMALL_ROWS", 100)
    monkeypatch.setattr(boosting, "boost_quantile", None)  # no chain of jobs per bound
    got = boosting.boost_quantiles(frame, [0.1, 0.9], 8, 3, 0.3, held, 10)
    for a, b in zip(got, want):
        assert a.start == b.start and len(a.history) == len(b.history) == 8
        assert np.allclose(a.history, b.history, rtol=0.02)
    from pyspark.ml.functions import vector_to_array
    seen = frame.withColumn("x", vector_to_array("features")).select(
        F.avg((F.col("label") <= got[0].predict()).cast("double")), F.avg((F.col("label") <= got[1].predict()).cast("double"))).first()
    assert seen[0] == pytest.approx(0.1, abs=0.04) and seen[1] == pytest.approx(0.9, abs=0.04)


@pytest.mark.parametrize("fetched", [20_000, 3])
def test_leaf_quantiles_are_exact(frame, monkeypatch, fetched):
    monkeypatch.setattr(boosting, "FETCHED", fetched)
    borders = cells.bin_borders(frame, 6000, 2, 32, 1)
    store = boosting._CellStore(frame.select("features", "label", F.lit(False).alias("held")), 6000, borders, 1)
    f = {0: np.linspace(-1, 1, store.cells), 1: np.zeros(store.cells)}
    leaves, taus = {0: np.arange(store.cells) % 3 * 2, 1: np.arange(store.cells) % 2}, [0.025, 0.5]
    got = store.leaf_quantiles(f, leaves, taus)
    pdf = frame.toPandas()
    x = np.stack([v.toArray() for v in pdf["features"]])
    cell, y = cells.cell_of(list(x.T), borders), pdf["label"].to_numpy()
    for i in f:
        for leaf in np.unique(leaves[i][cell]):
            rest = np.sort((y - f[i][cell])[leaves[i][cell] == leaf])
            assert got[i][leaf] == rest[int(np.ceil(taus[i] * len(rest))) - 1]
    store.blocks.unpersist()
