"""Whitening against numpy's own eigenvectors, and its edges."""

import numpy as np
import pytest

from tabula.llm import whitening as W
from tests.conftest import SF_SMALL


def spectra():
    rng = np.random.default_rng(3)
    yield np.diag([3.0, 3.0, 3.0])
    yield np.array([[0.0, 1.0], [1.0, 0.0]])
    yield np.diag([1.0, 2.0, 3.0])  # the mean is an eigenvalue
    for values in (np.arange(1, 65.0), 2.0 ** -np.arange(40), np.r_[np.ones(10), np.zeros(5)],
                   np.r_[1e8, rng.random(30)], np.r_[np.full(20, 5.0), np.full(20, 1.0)]):
        q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
        a = q * values @ q.T
        yield (a + a.T) / 2
    b = rng.standard_normal((300, 64))
    yield b.T @ b


@pytest.mark.parametrize("a", list(spectra()))
def test_spectrum(a):
    values, vectors = W.spectrum(a)
    size = np.linalg.norm(a)
    want = np.linalg.eigvalsh(a)[::-1]
    assert np.abs(values - want).max() <= 1e-13 * size
    assert np.abs(vectors.T @ vectors - np.eye(len(a))).max() < 1e-13
    assert np.linalg.norm(a @ vectors - vectors * values) <= 1e-12 * size


def test_polar_factor_is_the_sign():
    rng = np.random.default_rng(1)
    q, _ = np.linalg.qr(rng.standard_normal((12, 12)))
    values = np.r_[-5, -1e-9, rng.standard_normal(10)]
    a = q * values @ q.T
    u = W.polar_factor((a + a.T) / 2, 1e-10)
    assert np.abs(u - q * np.sign(values) @ q.T).max() < 1e-6


def plain(rows):
    """{row number: (deviation, whitened)} and explained shares, by numpy's eigh."""
    good = [(i, v) for i, v in rows if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(1024 * float(c))) + 100000 for c in v] for _, v in good])
    n, s = len(x), x.sum(axis=0)
    centred = x - s / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:8], axes[:, ::-1][:, :8]
    dev = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s)) for r in x]
    return [i for i, _ in good], n, dev, centred @ axes / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def compare(got, rows, atol=1e-8):
    ids, n, dev, white, share = plain(rows)
    k = max(r["component"] for r in got)
    place = {i: p for p, i in enumerate(ids)}
    assert sorted((r["vec_id"], r["component"]) for r in got) == sorted((i, c + 1) for i in ids for c in range(k))
    own = np.zeros((len(ids), k))
    for r in got:
        p = place[r["vec_id"]]
        own[p, r["component"] - 1] = r["whitened"]
        assert r["n"] == n and r["deviation"] == dev[p]
        assert r["explained"] == pytest.approx(share[r["component"] - 1], rel=1e-9)
        assert r["identity_error"] < 1e-9
    sign = np.sign((own * white[:, :k]).sum(axis=0))
    assert np.abs(own * sign - white[:, :k]).max() < atol


def test_whole_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in
            spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    compare(W.op11(spark, SF_SMALL).collect(), rows)


def test_edges(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(c) for c in rng.standard_normal(9) * range(1, 10)]) for i in range(60)]
    rows += [(100, None), (101, []), (102, [1.0] * 8 + [None]), (103, [float("nan")] * 9), (104, [float("inf")] * 9)]
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows],
                                  "vec_id long, embedding array<double>, n int, whitened string")
    compare(W.whitened_rows(frame).collect(), rows)
    odd = frame.select("vec_id", "embedding").union(spark.createDataFrame(
        [(200, [1.0, 2.0]), (None, [5.0] * 9), (0, rows[0][1])], "vec_id long, embedding array<double>"))
    got = W.whitened_rows(odd).collect()
    assert len(got) == 62 * 8 and {r["n"] for r in got} == {62}
    assert not any(r["vec_id"] == 200 for r in got) and sum(r["vec_id"] is None for r in got) == 8
    assert W.whitened_rows(frame.limit(0)).count() == 0
    assert W.whitened_rows(frame.filter("vec_id = 3")).count() == 0  # one vector has no spread
    flat = spark.createDataFrame([(i, [float(i), float(i), 1.0]) for i in range(9)], "vec_id long, embedding array<double>")
    assert {r["component"] for r in W.whitened_rows(flat).collect()} == {1}
