"""Multivariate outlier detectors: isolation forest and robust-covariance
(elliptic envelope) distances.

Isolation forest: each tree sees at most ``max_samples`` rows picked by
keyed draws, so the training set of a tree is a bounded group; trees are
grown in ``applyInPandas`` (one group per tree), the finished trees (at most
``n_estimators x (2 max_samples - 1)`` nodes, a fixed bound) are broadcast, and
every row is scored in ``mapInPandas``. Nothing grows with the data except
the scoring pass, which is embarrassingly parallel.

Elliptic envelope: the fast minimum-covariance-determinant method. Random
starts run in nested subsets of bounded size, the ten best are concentrated over
all rows side by side; moments are partial sums per partition (numpy in the
task) added by position in Spark, so d x d numbers reach the driver, and the
last cuts are exact order statistics. The final flag is the top
``contamination`` share of robust distances. From ``PACKED_ROWS`` rows on, this
fit and that of the one-class detector scan packed blocks (``blocks``), and a
step is one scan that finds its cut and the sums below it.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from ..functions.random import draw_uniform
from ..plans.scale import bracketed_quantile, one_row, quantiles, spread
from .blocks import PACKED_ROWS, Packed
from .missing import _distinct_counts as exact_distinct_counts
from .relational import distinct_counts

EULER = 0.5772156649015329


def _c(n: float) -> float:
    """Average path length of an unsuccessful search in a binary tree of n."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + EULER) - 2.0 * (n - 1) / n


def _grow(x: np.ndarray, rng: np.random.Generator, max_depth: int):
    """One isolation tree as flat arrays: feature, threshold, left, right, size."""
    feat, thr, left, right, size = [], [], [], [], []

    def node(idx, depth):
        i = len(feat)
        feat.append(-1)
        thr.append(0.0)
        left.append(-1)
        right.append(-1)
        size.append(len(idx))
        if depth >= max_depth or len(idx) <= 1:
            return i
        sub = x[idx]
        lo, hi = sub.min(0), sub.max(0)
        usable = np.flatnonzero(hi > lo)
        if len(usable) == 0:
            return i
        f = int(rng.choice(usable))
        t = float(rng.uniform(lo[f], hi[f]))
        feat[i], thr[i] = f, t
        mask = sub[:, f] < t
        li = node(idx[mask], depth + 1)
        ri = node(idx[~mask], depth + 1)
        left[i], right[i] = li, ri
        return i

    node(np.arange(len(x)), 0)
    return feat, thr, left, right, size


def _steps(tree):
    """A tree for ``_descend``: feature and threshold per node, the nodes
    after it (no, yes), path lengths at leaves, and levels. A leaf leads to itself."""
    feat, thr, left, right, size = tree
    own, depth = np.arange(len(feat)), np.zeros(len(feat))
    for i in own[feat >= 0]:  # a node comes before those below it
        depth[[left[i], right[i]]] = depth[i] + 1
    after = np.stack([np.where(feat < 0, own, right), np.where(feat < 0, own, left)], axis=1).ravel()
    return np.maximum(feat, 0), thr, after, depth + np.array([_c(s) for s in size]), int(depth.max())


def _path_lengths(x: np.ndarray, tree) -> np.ndarray:
    return _descend(x, _steps(tree))


def _descend(x: np.ndarray, steps) -> np.ndarray:
    """Path length of every row of ``x``: all rows go down a level at a time."""
    feat, thr, after, length, levels = steps
    cells, first = np.ascontiguousarray(x).ravel(), np.arange(len(x)) * x.shape[1]
    cur = np.zeros(len(x), dtype=np.int64)
    for _ in range(levels):
        cur = after[2 * cur + (cells[first + feat[cur]] < thr[cur])]
    return length[cur]


def outliers_isolation_forest(df: DataFrame, features, key: str, n_estimators: int = 100,
                              max_samples: int = 256, contamination="auto", seed: int = 46,
                              score_col: str = "anomaly_score") -> DataFrame:
    """``outliers_isolation_forest``: every row with its anomaly score
    ``2^(-E[h(x)] / c(psi))`` and ``is_outlier`` (score > 0.5 for 'auto', else
    the top ``contamination`` share by score)."""
    spark = df.sparkSession
    n = df.count()
    psi = int(min(max_samples, n))
    max_depth = int(math.ceil(math.log2(max(psi, 2))))
    vec = F.array(*[F.col(c).cast("double") for c in features])
    base = spread(df.select(F.col(key), vec.alias("_x")), n)
    # Candidates: each row enters tree t when its keyed draw for t is below
    # a rate giving ~3 psi rows per tree; each tree keeps its psi smallest draws.
    margin = 3.0
    while True:
        rate = min(1.0, margin * psi / max(n, 1))
        # one row per tree, dropped by its draw within the stage
        trees_of = F.array(*[F.lit(i) for i in range(n_estimators)])
        cand = (base.select(key, "_x", F.explode(trees_of).alias("tree"))
                .withColumn("u", draw_uniform(F.xxhash64(F.col(key), F.col("tree")), seed)).filter(F.col("u") < rate)
                .persist(StorageLevel.MEMORY_AND_DISK))
        short = cand.groupBy("tree").count().filter(F.col("count") < psi).limit(1).count()
        if short == 0 or rate >= 1.0:
            break
        cand.unpersist()
        margin *= 2

    d = len(features)

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["u", key]).head(psi)
        tree_id = int(pdf["tree"].iloc[0])
        x = np.stack(pdf["_x"].to_numpy()).astype(np.float64).reshape(-1, d)
        rng = np.random.default_rng([seed, tree_id])
        feat, thr, left, right, size = _grow(x, rng, max_depth)
        return pd.DataFrame({"tree": tree_id, "node": np.arange(len(feat)), "feature": feat,
                             "threshold": thr, "left": left, "right": right, "size": size})

    nodes = cand.groupBy("tree").applyInPandas(
        build, "tree int, node long, feature long, threshold double, left long, right long, size long")
    # Bounded by n_estimators x (2 psi - 1) rows, independent of the data size.
    trees_pdf = nodes.toPandas().sort_values(["tree", "node"])
    cand.unpersist()
    trees = [_steps(tuple(g[c].to_numpy() for c in ("feature", "threshold", "left", "right", "size")))
             for _, g in trees_pdf.groupby("tree")]
    bc = spark.sparkContext.broadcast(trees)
    c_psi = _c(psi)

    def score(it):
        ts = bc.value
        for p in it:
            x = _cells(p, d)
            h = np.zeros(len(x))
            for tr in ts:
                h += _descend(x, tr)
            h /= max(len(ts), 1)
            s = np.power(2.0, -h / c_psi) if c_psi > 0 else np.full(len(x), 0.5)
            yield _batch(**{key: p.column(key), score_col: s})

    key_type = dict(df.dtypes)[key]
    scored = base.mapInArrow(score, f"{key} {key_type}, {score_col} double")
    if contamination == "auto":
        flag = F.col(score_col) > 0.5
    else:
        cut = quantiles(scored, score_col, [1.0 - float(contamination)])[0]
        flag = F.col(score_col) > F.lit(cut)
    return scored.withColumn("is_outlier", flag)


# ------------------------------------------------------------------ MCD


def _vector_sum(partials: DataFrame, column: str) -> np.ndarray:
    """Element-wise sum of one array per partition, by position in Spark: the
    driver gets one number per element, however many partitions there are."""
    rows = (partials.select(F.posexplode(column).alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x"))
            .collect())
    return np.array([r["x"] for r in sorted(rows)])


def _cells(batch: pa.RecordBatch, d: int) -> np.ndarray:
    """The arrays ``_x`` of an Arrow batch as rows, without an object per row."""
    return batch.column("_x").flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, d)


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({n: c if isinstance(c, pa.Array) else pa.array(c) for n, c in columns.items()})


def _lists(rows: np.ndarray) -> pa.Array:
    """A matrix as an array column."""
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel()))


def _stored(df: DataFrame, feats, key: str, rows: int) -> DataFrame:
    """Key and cells, kept for the many scans of a fit."""
    cells = F.array(*[F.col(f).cast("double") for f in feats]).alias("_x")
    return spread(df.select(F.col(key), cells), rows).persist(StorageLevel.MEMORY_AND_DISK)


def _moments(df: DataFrame, d: int, weight=None, around=None):
    """(count, mean, covariance) of rows (optionally only those with weight
    true): one numpy partial per partition, summed by position in Spark. A
    point ``around`` near the mean keeps the products from cancelling."""
    around = np.zeros(d) if around is None else np.asarray(around)
    cols = df.select(F.col("_x"), (weight if weight is not None else F.lit(True)).alias("_w"))

    def part(it):
        n, s, ss = 0, np.zeros(d), np.zeros((d, d))
        for p in it:
            x = _cells(p.filter(p.column("_w")), d) - around
            if len(x):
                n += len(x)
                s += x.sum(0)
                ss += x.T @ x
        yield _batch(sums=[[float(n), *s.tolist(), *ss.ravel().tolist()]])

    sums = _vector_sum(cols.mapInArrow(part, "sums array<double>"), "sums")
    n, s, ss = int(sums[0]), sums[1:d + 1], sums[d + 1:].reshape(d, d)
    mean = s / n
    cov = ss / n - np.outer(mean, mean)
    return n, mean + around, cov


def _mahalanobis(mean, prec):
    d = len(mean)
    diff = [F.col("_x")[i] - F.lit(float(mean[i])) for i in range(d)]
    # quadratic form as a sum of d products of (diff . prec row)
    terms = []
    for i in range(d):
        row = F.lit(0.0)
        for j in range(d):
            if prec[i, j] != 0:
                row = row + diff[j] * F.lit(float(prec[i, j]))
        terms.append(diff[i] * row)
    out = terms[0]
    for t_ in terms[1:]:
        out = out + t_
    return out


def _wide_features(df: DataFrame, features, min_distinct: int) -> list:
    """Features with more than ``min_distinct`` distinct values, exactly: a
    sketch tells the clear cases, the few-valued columns are counted."""
    rough = distinct_counts(df, list(features), exact=False)
    near = [f for f in features if rough[f] < 2 * min_distinct + 20]
    exact = exact_distinct_counts(df, near) if near else {}
    return [f for f in features if exact.get(f, 0 if f in near else rough[f]) > min_distinct]


def chi_square_quantile(p: float, d: int) -> float:
    """Quantile of the chi-square law, by bisection of the incomplete gamma series."""
    def below(x):
        a, x = d / 2, x / 2
        if x <= 0:
            return 0.0
        term = total = 1 / a
        n = a
        while term > total * 1e-16:
            n += 1
            term *= x / n
            total += term
        return total * math.exp(a * math.log(x) - x - math.lgamma(a))

    low, high = 0.0, 4.0 * d + 60
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < p else (low, middle)
    return (low + high) / 2


def _concentrate(x: np.ndarray, mean, cov, h: int, steps: int):
    """C-steps on rows in memory: the h nearest rows give the next estimate."""
    for _ in range(steps):
        diff = x - mean
        near = np.argsort(np.einsum("ij,jk,ik->i", diff, np.linalg.pinv(cov), diff), kind="stable")[:h]
        mean, cov = x[near].mean(axis=0), np.atleast_2d(np.cov(x[near].T, bias=True))
    return mean, cov


def _log_det(cov) -> float:
    sign, value = np.linalg.slogdet(cov)
    return value if sign > 0 else -np.inf


def _random_starts(x: np.ndarray, share: float, starts: int, best: int, rng) -> list:
    """The ``best`` of many estimates that began with d + 1 random rows (and
    more where those lie in a plane) after two C-steps."""
    n, d = x.shape
    h, found = min(n, max(d + 1, int(math.ceil(share * n)))), []
    for _ in range(starts):
        order, m = rng.permutation(n), min(n, d + 1)
        while m < n and np.linalg.matrix_rank(np.cov(x[order[:m]].T, bias=True)) < d:
            m += 1
        own = x[order[:m]]
        mean, cov = _concentrate(x, own.mean(axis=0), np.atleast_2d(np.cov(own.T, bias=True)), h, 2)
        found.append((_log_det(cov), mean, cov))
    return sorted(found, key=lambda f: f[0])[:best]


def _nested_starts(base: DataFrame, key: str, n: int, d: int, share: float, seed: int) -> list:
    """The nested subsets of the published fast method: at most five subsets
    of 300 rows by keyed draws, a hundred starts in each, the ten best of each
    carried on over all of their rows, ten in the end."""
    rate = min(1.0, 3.0 * SUBSETS * SUBSET_ROWS / max(n, 1))
    draw = draw_uniform(F.xxhash64(F.col(key)), seed)
    drawn = base.withColumn("_u", draw).filter(F.col("_u") <= rate).orderBy("_u", key).limit(SUBSETS * SUBSET_ROWS)
    subsets = max(1, min(SUBSETS, n // SUBSET_ROWS))
    parted = drawn.withColumn("_s", F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(subsets))).select("_s", "_x")

    def begin(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(pdf["_x"].to_numpy()).astype(float)
        x = x[np.lexsort(x.T)]
        got = _random_starts(x, share, STARTS, BEST, np.random.default_rng([seed, int(pdf["_s"].iloc[0])]))
        return pd.DataFrame({"m": [m.tolist() for _, m, _ in got], "c": [c.ravel().tolist() for _, _, c in got],
                             "x": [x.ravel().tolist() if i == 0 else None for i in range(len(got))]})

    # at most SUBSETS x BEST estimates and SUBSETS x SUBSET_ROWS rows
    got = parted.groupBy("_s").applyInPandas(begin, "m array<double>, c array<double>, x array<double>").collect()
    x = np.concatenate([np.array(r["x"]).reshape(-1, d) for r in got if r["x"] is not None])
    h = min(len(x), max(d + 1, int(math.ceil(share * len(x)))))
    again = [_concentrate(x, np.array(r["m"]), np.array(r["c"]).reshape(d, d), h, 2) for r in got]
    return sorted(again, key=lambda f: _log_det(f[1]))[:BEST]


def _concentrate_all(base: DataFrame, estimates: list, h: int, n: int, d: int) -> list:
    """One C-step of several estimates over all rows, side by side: a scan for
    the cuts (by sketch; the winner's last cuts are exact) and one for the moments."""
    shapes = [(m, np.linalg.pinv(c)) for m, c in estimates]

    def distances(x):
        return np.stack([np.einsum("ij,jk,ik->i", x - m, p, x - m) for m, p in shapes], axis=1)

    def far(it):
        for p in it:
            if len(p):
                yield _batch(q=_lists(distances(_cells(p, d))))

    cuts = one_row(base.select("_x").mapInArrow(far, "q array<double>"),
                   *[F.percentile_approx(F.col("q")[i], F.lit(h / n), 10000).alias(f"c{i}") for i in range(len(shapes))])

    def part(it):
        total = np.zeros((len(shapes), 1 + d + d * d))
        for p in it:
            if len(p):
                x = _cells(p, d)
                near = distances(x) <= [cuts[f"c{i}"] for i in range(len(shapes))]
                for i in range(len(shapes)):
                    # around the estimate, so that the products do not cancel
                    own = x[near[:, i]] - shapes[i][0]
                    total[i] += np.concatenate([[len(own)], own.sum(0), (own.T @ own).ravel()])
        yield _batch(sums=[total.ravel().tolist()])

    sums = _vector_sum(base.select("_x").mapInArrow(part, "sums array<double>"), "sums").reshape(len(shapes), -1)
    out = []
    for (mean, _), v in zip(shapes, sums):
        shift = v[1:d + 1] / v[0]
        out.append((mean + shift, v[d + 1:].reshape(d, d) / v[0] - np.outer(shift, shift)))
    return out


SUBSETS, SUBSET_ROWS, STARTS, BEST = 5, 300, 100, 10


class _Squares:
    """The products of cells that distances and moments are made of, over packed
    rows. Cells are taken from the median of the sample in units of its spread."""

    def __init__(self, rows: Packed):
        self.rows, self.d = rows, rows.width
        low, self.centre, high = np.percentile(rows.sample, [25, 50, 75], axis=0) if len(rows.sample) else np.zeros((3, self.d))
        self.unit = np.where(high > low, high - low, 1.0)
        self.first, self.second = np.triu_indices(self.d)
        self.columns = 1 + self.d + len(self.first)
        self.chunk = max(1, (1 << 17) // self.columns)

    def __getstate__(self):
        """What the tasks need."""
        return {k: v for k, v in self.__dict__.items() if k != "rows"}

    def terms(self, x: np.ndarray) -> np.ndarray:
        out = np.ones((self.columns, len(x)))
        u = out[1:self.d + 1]
        u[:] = ((x - self.centre) / self.unit).T
        np.multiply(u[self.first], u[self.second], out=out[self.d + 1:])
        return out

    def distance(self, mean, cov) -> np.ndarray:
        """Squared distance from an estimate as coefficients of the terms."""
        m = (mean - self.centre) / self.unit
        p = np.linalg.pinv(cov) * np.outer(self.unit, self.unit)
        twice = np.where(self.first == self.second, 1.0, 2.0)
        return np.concatenate([[m @ p @ m], -2.0 * (p @ m), twice * p[self.first, self.second]])

    def estimate(self, sums: np.ndarray):
        """Mean and covariance from the sums of the terms."""
        mean, square = sums[1:self.d + 1] / sums[0], np.zeros((self.d, self.d))
        square[self.first, self.second] = square[self.second, self.first] = sums[self.d + 1:] / sums[0]
        return mean * self.unit + self.centre, (square - np.outer(mean, mean)) * np.outer(self.unit, self.unit)

    def nearest(self, estimates: list, rank: int, n: int, exact: bool = False, bracket=None):
        """Cuts of the distances from ``estimates`` at ``rank``, and the
        estimates by the rows below."""
        shapes = np.stack([self.distance(*e) for e in estimates])

        def part(x):
            terms = self.terms(x)
            return shapes @ terms, terms

        cuts, sums = self.rows.sums_to_rank(part, self.columns, self.chunk, shapes @ self.terms(self.rows.sample), rank, rank / n,
                                            exact, bracket)
        return cuts, [self.estimate(s) for s in sums]

    def within(self, estimate, cut: float):
        """The estimate by the rows up to a distance."""
        shape = self.distance(*estimate)

        def part(x, total):
            terms = self.terms(x)
            total += terms @ (shape @ terms <= cut)

        return self.estimate(self.rows.add_up(part, self.columns, self.chunk))


def _packed_covariance(rows: Packed, estimates: list, h: int, n: int, d: int, max_steps: int):
    """``robust_covariance`` from its ``estimates`` on, over packed rows."""
    squares = _Squares(rows)
    for _ in range(max_steps):
        _, new = squares.nearest(estimates, h, n)
        falling = [_log_det(c2) < _log_det(c) - 1e-6 for (_, c), (_, c2) in zip(estimates, new)]
        estimates = [b if f else a for a, b, f in zip(estimates, new, falling)]
        if not any(falling):
            break
    mean, cov = min(estimates, key=lambda e: _log_det(e[1]))
    det, cuts = np.inf, []
    for _ in range(max_steps):
        # the cut moves less from step to step
        off = 2 * abs(cuts[-1] - cuts[-2]) if len(cuts) > 1 else 0.0
        bracket = (np.array([cuts[-1] - off]), np.array([cuts[-1] + off])) if off > 0 else None
        (cut,), [(m2, c2)] = squares.nearest([(mean, cov)], h, n, True, bracket)
        cuts.append(cut)
        if not _log_det(c2) < det - 1e-10:
            break
        mean, cov, det = m2, c2, _log_det(c2)
    return mean, cov, squares


def robust_covariance(base: DataFrame, key: str, n: int, d: int, max_steps: int = 30, seed: int = 46):
    """Minimum covariance determinant (the published fast method) of the
    arrays ``_x``: location and covariance.

    Starts of d + 1 rows are concentrated in nested subsets, the ten best over
    all rows side by side until no determinant falls, and the winner with
    exact cuts at the h = (n + d + 1) / 2 nearest rows. The covariance is made
    consistent at the normal law (median distance over the chi-square
    median), and rows within its 97.5 % quantile give the final estimate.
    """
    h = (n + d + 1) // 2
    estimates = _nested_starts(base, key, n, d, h / n, seed)
    if n >= PACKED_ROWS:
        rows = Packed(base, "_x", d, n, seed)
        try:
            mean, cov, squares = _packed_covariance(rows, estimates, h, n, d, max_steps)
            (middle,), _ = squares.nearest([(mean, cov)], (n + 1) // 2, n, exact=True)
            factor = middle / chi_square_quantile(0.5, d)
            return squares.within((mean, cov), factor * chi_square_quantile(0.975, d)) if factor > 0 else (mean, cov)
        finally:
            rows.unpersist()
    for _ in range(max_steps):
        new = _concentrate_all(base, estimates, h, n, d)
        falling = [_log_det(c2) < _log_det(c) - 1e-6 for (_, c), (_, c2) in zip(estimates, new)]
        estimates = [b if f else a for a, b, f in zip(estimates, new, falling)]
        if not any(falling):
            break
    mean, cov = min(estimates, key=lambda e: _log_det(e[1]))
    det = np.inf
    for _ in range(max_steps):
        dist = _mahalanobis(mean, np.linalg.pinv(cov))
        cut = bracketed_quantile(base.select(dist.alias("_d")), "_d", (h - 1) / max(n - 1, 1), n)
        _, m2, c2 = _moments(base, d, dist <= F.lit(cut), mean)
        if not _log_det(c2) < det - 1e-10:
            break
        mean, cov, det = m2, c2, _log_det(c2)
    dist = _mahalanobis(mean, np.linalg.pinv(cov))
    factor = bracketed_quantile(base.select(dist.alias("_d")), "_d", 0.5, n) / chi_square_quantile(0.5, d)
    if factor > 0:
        _, mean, cov = _moments(base, d, dist <= F.lit(factor * chi_square_quantile(0.975, d)), mean)
    return mean, cov


def outliers_elliptic(df: DataFrame, features, key: str, contamination: float = 0.1,
                      min_distinct: int = 30, max_steps: int = 30) -> DataFrame:
    """``outliers_elliptic``: drop features with <= 30 distinct values, refuse
    when rows < features^2, estimate a robust location and covariance
    (``robust_covariance``), then flag the rows whose robust distance is in the
    top ``contamination`` share."""
    feats = _wide_features(df, features, min_distinct)
    n = df.count()
    d = len(feats)
    if d == 0 or n < d * d:
        raise ValueError(f"elliptic envelope needs rows >= features^2 ({n} < {d * d})")
    base = _stored(df, feats, key, n)
    mean, cov = robust_covariance(base, key, n, d, max_steps)
    scored = base.select(key, _mahalanobis(mean, np.linalg.pinv(cov)).alias("robust_distance"))
    thr = bracketed_quantile(scored, "robust_distance", 1.0 - contamination, n)
    out = scored.withColumn("is_outlier", F.col("robust_distance") > F.lit(thr))
    return out


# ----------------------------------------------------------- one-class SVM


def outliers_one_class(df: DataFrame, features, key: str, nu: float = 0.5, gamma="scale",
                       n_components: int = 200, max_iter: int = 30, seed: int = 46,
                       min_distinct: int = 30) -> DataFrame:
    """``outliers_one_class`` (re-aimed, approximate): an RBF one-class SVM in
    random-Fourier-feature space.

    ``z(x) = sqrt(2/D) cos(W x + b)`` approximates the RBF kernel with
    ``gamma`` ('scale' = 1 / (d * var(X)), the usual default). The linear
    one-class objective ``1/2 |w|^2 - rho + 1/(nu n) sum max(0, rho - w.z)``
    is minimised by subgradient steps; each step is one pass (two over few rows) whose per-
    partition partial sums (numpy in the task) are added in Spark;
    the features are formed in the pass and never stored. For fixed ``w`` the best ``rho`` is the
    ``nu``-quantile of the scores, to a ten-thousandth of the rows during the steps and exact at the end. Rows with
    ``w.z(x) < rho`` are flagged (about a ``nu`` share, as the nu-property
    says). Same column and size guards as the other multivariate detectors.
    """
    feats = _wide_features(df, features, min_distinct)
    n = df.count()
    d = len(feats)
    if d == 0 or n < d * d:
        raise ValueError(f"one-class detector needs rows >= features^2 ({n} < {d * d})")
    base = _stored(df, feats, key, n)
    if gamma == "scale":
        _, mean, cov = _moments(base, d)
        var = float(np.trace(cov) / d + (mean ** 2).mean() - (mean.mean()) ** 2)
        gamma = 1.0 / (d * var) if var > 0 else 1.0
    rng = np.random.default_rng(seed)
    W = rng.normal(0.0, math.sqrt(2.0 * gamma), size=(n_components, d))
    b = rng.uniform(0.0, 2 * math.pi, size=n_components)
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast((W, b))
    scale = math.sqrt(2.0 / n_components)

    def feats_of(x):
        Wb, bb = bc.value
        return scale * np.cos(x @ Wb.T + bb)

    key_type = dict(df.dtypes)[key]

    def scores(wv):
        w_bc = spark.sparkContext.broadcast(wv)

        def part(it):
            for p in it:
                if len(p):
                    yield _batch(**{key: p.column(key), "_s": feats_of(_cells(p, d)) @ w_bc.value})

        return base.mapInArrow(part, f"{key} {key_type}, _s double")

    def best_rho(wv):
        return one_row(scores(wv), F.percentile_approx("_s", F.lit(nu), 10000).alias("q"))["q"]

    def violators_sum(wv, rho):
        w_bc = spark.sparkContext.broadcast((wv, rho))

        def part(it):
            wv_, rho_ = w_bc.value
            s = np.zeros(n_components)
            for p in it:
                if len(p):
                    z = feats_of(_cells(p, d))
                    s += z[z @ wv_ < rho_].sum(0)
            yield _batch(s=[s.tolist()])

        return _vector_sum(base.select("_x").mapInArrow(part, "s array<double>"), "s")

    # every row violates at w = 0, rho = 1: start from the mean feature direction
    w = violators_sum(np.zeros(n_components), 1.0) / n
    # a missing cell makes all of them NaN
    rows = Packed(base, "_x", d, n, seed) if n >= PACKED_ROWS and np.isfinite(w).all() else None
    # in single precision, whose rounding (1e-7) is far below a ten-thousandth of
    # the rows; the scores that are returned are in double precision
    middle = np.median(rows.sample, axis=0) if rows and len(rows.sample) else np.zeros(d)
    turns, begin = W.astype(np.float32), np.mod(W @ middle + b, 2 * math.pi).astype(np.float32)[:, None]

    def cosines(x):
        out = np.ones((n_components + 1, len(x)), np.float32)
        part = out[1:]
        np.matmul(turns, (x - middle).T.astype(np.float32), out=part)
        part += begin
        np.cos(part, out=part)
        part *= np.float32(scale)
        return out

    drawn = cosines(rows.sample) if rows else None

    def violators(wv):
        if rows is None:
            return violators_sum(wv, best_rho(wv))

        weights = wv[None].astype(np.float32)

        def part(x):
            terms = cosines(x)
            return weights @ terms[1:], terms

        return rows.sums_to_rank(part, n_components + 1, 512, weights @ drawn[1:], max(1, round(nu * n)), nu)[1][0, 1:]

    for t_ in range(1, max_iter + 1):
        grad = w - violators(w) / (nu * n)
        w = w - (1.0 / (t_ + 1)) * grad
    if rows:
        rows.unpersist()
    # formed once, and stored for the scans that rank them
    final = scores(w).persist(StorageLevel.MEMORY_AND_DISK)
    rho = bracketed_quantile(final, "_s", nu, n)
    return final.select(key, (F.col("_s") - F.lit(rho)).alias("decision"),
                        (F.col("_s") < F.lit(rho)).alias("is_outlier"))
