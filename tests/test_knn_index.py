"""The two-level metric index of the k-NN join: visits, hot vectors, edges."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabula.operators import neighbors as N


def _visits(spark, n, block_rows=32, need=4):
    """(block pairs visited, all block pairs) of a self-join of n points in clusters of 64."""
    rng = np.random.default_rng(n)
    centres = rng.uniform(-100, 100, (n // 64, 3))
    x = centres[np.arange(n) % len(centres)] + rng.normal(0, 0.2, (n, 3))
    rows = spark.createDataFrame(pd.DataFrame({"_id": np.arange(n), "_v": list(x)}))
    index = spark.sparkContext.broadcast(N._index(rows, block_rows))
    blocks = N._cell_blocks(rows, index, block_rows)
    found = N.plan_visits(blocks, blocks, index, need)
    return found.count(), blocks.select("_cell", "_blk").distinct().count() ** 2


def test_visits_grow_slower_than_block_pairs(spark):
    small, small_all = _visits(spark, 2048)
    large, large_all = _visits(spark, 16384)
    assert large_all / small_all > 25
    assert large / small < 0.4 * large_all / small_all
    assert large < 0.1 * large_all


def test_a_third_of_the_rows_alike(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(0, 1, (600, 4)), np.tile([0.5, 0.5, 0.0, -0.0], (300, 1))])
    ids = rng.permutation(900)
    df = spark.createDataFrame(pd.DataFrame({"id": ids, "v": list(x)}))
    got = N.knn_join(df, df, "id", "id", "v", k=3, exclude_self=True, block_rows=20).toPandas()
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)
    np.fill_diagonal(d, np.inf)
    want = {ids[i]: list(ids[np.lexsort((ids, d[i]))[:3]]) for i in range(900)}
    assert got.sort_values("neighbor_rank").groupby("id")["neighbor_id"].apply(list).to_dict() == want


def test_fewer_rows_than_neighbours_and_no_rows(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0]), (2, [3.0, 1.0]), (3, None)], "id long, v array<double>")
    got = N.knn_join(df, df, "id", "id", "v", k=5)
    assert sorted((r["id"], r["neighbor_rank"], r["neighbor_id"]) for r in got.collect()) == [
        (1, 1, 1), (1, 2, 2), (2, 1, 2), (2, 2, 1)]
    assert N.knn_join(df, df.filter("id > 5"), "id", "id", "v").count() == 0
    assert N.knn_join(df.filter("id > 5"), df, "id", "id", "v").count() == 0


def test_index_places_every_row_with_true_distances(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(500, 5))
    rows = spark.createDataFrame(pd.DataFrame({"_id": np.arange(500), "_v": list(x)}))
    index = N._index(rows, 10)
    cell, dist, top = index.place(x)
    assert len(index.pivots) == 50 and index.supers == 8
    assert dist == pytest.approx(np.linalg.norm(x - index.pivots[cell], axis=1))
    assert top == pytest.approx(np.linalg.norm(x - index.pivots[index.home[cell]], axis=1))
    sent = spark.sparkContext.broadcast(index)
    blocks = N._cell_blocks(rows, sent, 10)
    sizes = blocks.groupBy("_cell", "_blk").count().agg(F.max("count"), F.sum("count")).first()
    assert sizes[0] <= 10 and sizes[1] == 500


def test_a_block_moves_once_per_strip(spark, monkeypatch):
    """strips of any size give the pairs of single blocks, NULL keys included."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(700, 8))
    ids = [None if i % 97 == 0 else i for i in range(700)]
    df = spark.createDataFrame(list(zip(ids, x.tolist())), "id long, v array<double>")
    packed, made = N._packed, []
    monkeypatch.setattr(N, "_packed", lambda blocks: made.append(packed(blocks)) or made[-1])
    got = {}
    for strip in (1, 150, 1 << 15):
        monkeypatch.setattr(N, "STRIP_ROWS", strip)
        got[strip] = sorted(map(str, N.knn_join(df, df, "id", "id", "v", k=4, exclude_self=True, block_rows=20).collect()))
        assert sum(len(r["_ids"]) // 8 for r in made[-1].collect()) == 700
    assert got[1] == got[150] == got[1 << 15]
    strips = [m.select("_strip").distinct().count() for m in made]
    assert strips[0] > strips[1] > strips[2] == 1
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)
    np.fill_diagonal(d, np.inf)
    plain = N.knn_join(df.filter("id < 500"), df.filter("id IS NOT NULL"), "id", "id", "v", k=1, exclude_self=True, block_rows=20)
    known = np.array([i for i in range(700) if i % 97])
    assert all(r["neighbor_id"] == known[d[r["id"]][known].argmin()] for r in plain.collect())
