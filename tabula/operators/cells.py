"""Regression trees over cells: forests and boosted trees in one scan of the rows.

The histogram method (Spark ML's too) sees a row only by the bins of its
features, at most ``max_bins`` each, so with few features all rows lie in at
most ``max_bins ** features`` cells, whatever the data. A least-squares tree
needs the number, sum and sum of squares of the labels in each cell. One scan
adds these up: for a forest once per tree, every row with a Poisson(1) count
drawn for that tree; then each tree is grown from the sums of its cells, one
group per tree. Nothing is kept per row and tree, and the rows are not read
again for every level. Bin borders come from a sample of rows (10,000 or
``max_bins ** 2``), as those of Spark ML do; every row is counted.

Where there may be more than ``MOST_CELLS`` cells, or at most ``SMALL_ROWS``
rows, Spark ML fits the rows themselves. The draws depend on the order of rows
in their partitions, as those of Spark ML do.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.scale import one_row, spread

#: Most cells a task keeps sums for: 32 bins of three features.
MOST_CELLS = 2 ** 15
#: Up to so many rows Spark ML fits them as they are.
SMALL_ROWS = 100_000
#: Rows a task adds up at a time.
CHUNK = 2 ** 17
#: Cells whose predictions a task keeps between batches.
KNOWN_CELLS = 100_000


# ------------------------------------------------------------------ cells


def few_cells(data: DataFrame, label: str, max_bins: int) -> tuple[int, int] | None:
    """(rows, features) of the vector column ``features``, if trees over them
    can be grown from cells and there are enough rows for it to pay."""
    rows = known_rows(data, label)
    if rows is None:
        return None
    width = len(data.select("features").first()[0])
    return (rows, width) if max_bins ** width <= MOST_CELLS else None


def known_rows(data: DataFrame, label: str) -> int | None:
    """Number of rows, if they are enough for cells to pay and all have a label."""
    seen = one_row(data, F.count(F.lit(1)).alias("n"), F.count(F.nanvl(F.col(label).cast("double"), F.lit(None))).alias("known"))
    return None if seen["n"] <= SMALL_ROWS or seen["known"] < seen["n"] else seen["n"]


def plain_columns(df: DataFrame, features, label: str, keep=()) -> DataFrame | None:
    """The rows that ``assemble`` keeps with their features as columns x0, x1, ...;
    None where a feature is not a number. Scans of it read only the columns they use,
    so that no vectors are made or stored."""
    types = {f.name: f.dataType for f in df.schema}
    if not all(isinstance(types.get(f), (T.NumericType, T.BooleanType)) for f in features):
        return None
    return df.dropna(subset=list(features)).select(
        *keep, *[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)], F.col(label).cast("double").alias("label"))


def feature_columns(width: int, plain: bool = False) -> list:
    if plain:
        return [F.col(f"x{i}") for i in range(width)]
    cells = vector_to_array("features")
    return [cells[i].alias(f"x{i}") for i in range(width)]


def bin_borders(data: DataFrame, rows: int, width: int, max_bins: int, seed: int, plain: bool = False) -> list:
    """Per feature the borders of its bins: between all neighbouring values, or
    where there are more values than bins between those next to the quantiles."""
    wanted = max(max_bins ** 2, 10_000)
    narrow = data.select(*feature_columns(width, plain))
    sample = (narrow.sample(False, wanted / rows, seed) if rows > wanted else narrow).toPandas()
    return [_borders(sample[f"x{i}"].to_numpy(), max_bins) for i in range(width)]


def _borders(values: np.ndarray, max_bins: int) -> np.ndarray:
    found, counts = np.unique(values, return_counts=True)
    after = np.arange(len(found) - 1)
    if len(found) > max_bins:
        below = np.cumsum(counts)[:-1]
        stride = counts.sum() / max_bins
        after = np.unique([np.abs(below - k * stride).argmin() for k in range(1, max_bins)])
    return (found[after] + found[after + 1]) / 2


def cell_of(x: list, borders: list) -> np.ndarray:
    """Number of the cell of each row; a value on a border lies below it."""
    cell = np.zeros(len(x[0]), np.int64)
    for values, b in zip(x, borders):
        cell = cell * (len(b) + 1) + np.searchsorted(b, values)
    return cell


def _chunks(batches):
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= CHUNK:
            yield pa.Table.from_batches(held)
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held)


def cell_sums(data: DataFrame, rows: int, borders: list, trees: int, seed: int, extra: list | None = None) -> DataFrame:
    """Per task and tree: cells, and count, sum and sum of squares of the labels
    in them. ``trees=0``: one tree, every row once. ``extra``: columns x0, x1, ...
    in place of the features.

    Independent Poisson(1) counts are drawn as their total and then that many
    rows of the chunk with replacement, which has the same distribution."""
    width, cells = len(borders), int(np.prod([len(b) + 1 for b in borders]))
    narrow = spread(data.select(*(extra or feature_columns(width)), F.col("label").cast("double").alias("y")), rows)
    # a task's sums do not grow with its rows, so few tasks keep the shuffle small
    narrow = narrow.coalesce(2 * data.sparkSession.sparkContext.defaultParallelism)

    def run(batches):
        rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
        sums = np.zeros((max(trees, 1), 3, cells))
        for table in _chunks(batches):
            x = [table[f"x{i}"].to_numpy() for i in range(width)]
            cell, y = cell_of(x, borders), table["y"].to_numpy()
            y2 = y * y
            for t in range(max(trees, 1)):
                at = rng.integers(0, len(y), rng.poisson(len(y)), np.int32) if trees else slice(None)
                c = cell[at]
                sums[t, 0] += np.bincount(c, minlength=cells)
                sums[t, 1] += np.bincount(c, y[at], cells)
                sums[t, 2] += np.bincount(c, y2[at], cells)
        for t in range(max(trees, 1)):
            used = np.flatnonzero(sums[t, 0])
            yield pa.RecordBatch.from_pydict({"tree": pa.array([t], pa.int32()), "cells": pa.array([used], pa.list_(pa.int32())),
                                              **{k: pa.array([v[used]], pa.list_(pa.float64())) for k, v in zip("nsq", sums[t])}})

    return narrow.mapInArrow(run, "tree int, cells array<int>, n array<double>, s array<double>, q array<double>")


# ------------------------------------------------------------------ trees

NODES = "tree int, id int, left int, right int, feature int, threshold double, value double, cover double, gain double"


def grow_tree(bins: np.ndarray, sums: np.ndarray, borders: list, depth: int, per_node: int, rng) -> list:
    """Nodes in preorder as (left, right, feature, threshold, value, cover,
    gain); ``bins``: cells x features, ``sums``: count, sum and sum of squares
    per cell. The rules are Spark ML's: the largest fall of variance among
    ``per_node`` features drawn for the node, one row a leaf at least, and no
    two leaves of one value under a node."""
    nodes = []

    def variance(n, s, q):
        return (q - s * s / n) / n

    def add(at, level):
        n, s, q = sums[:, at].sum(axis=1)
        impurity, me, best = variance(n, s, q), len(nodes), (0.0, -1, 0)
        nodes.append((-1, -1, -1, np.nan, s / n, n, -1.0))
        if level == depth or abs(impurity) < 2.3e-16:
            return
        for f in sorted(rng.choice(bins.shape[1], per_node, replace=False)):
            parts = [np.cumsum(np.bincount(bins[at, f], v, len(borders[f]) + 1))[:-1] for v in sums[:, at]]
            for k in np.flatnonzero((parts[0] >= 1) & (n - parts[0] >= 1)):
                ln, ls, lq = (p[k] for p in parts)
                gain = impurity - ln / n * variance(ln, ls, lq) - (n - ln) / n * variance(n - ln, s - ls, q - lq)
                if gain > best[0]:
                    best = (gain, f, k)
        gain, f, k = best
        if f < 0:
            return
        below = bins[at, f] <= k
        left = len(nodes)
        add(at[below], level + 1)
        right = len(nodes)
        add(at[~below], level + 1)
        if nodes[left][0] < 0 and nodes[right][0] < 0 and nodes[left][4] == nodes[right][4]:
            del nodes[left:]
            return
        nodes[me] = (left, right, int(f), float(borders[f][k]), s / n, n, gain)

    add(np.arange(len(bins)), 0)
    return nodes


def _total(pdf: pd.DataFrame, cells: int) -> tuple[np.ndarray, np.ndarray]:
    sums = np.zeros((3, cells))
    for c, *parts in zip(pdf["cells"], *(pdf[k] for k in "nsq")):
        for total, part in zip(sums, parts):
            total[c] += part
    used = np.flatnonzero(sums[0])
    return used, sums[:, used]


def _bins(used: np.ndarray, borders: list) -> np.ndarray:
    return np.stack(np.unravel_index(used, [len(b) + 1 for b in borders]), axis=1)


def _frame(tree: int, nodes: list) -> pd.DataFrame:
    out = pd.DataFrame(nodes, columns=["left", "right", "feature", "threshold", "value", "cover", "gain"])
    out.insert(0, "id", np.arange(len(nodes)))
    out.insert(0, "tree", tree)
    return out


class CellTrees:
    """Fitted trees: node arrays (left, right, feature, threshold, value, cover)
    each, and the weights of their values. ``transform`` is that of a Spark ML
    model."""

    def __init__(self, nodes: pd.DataFrame, width: int, weights=None):
        self.trees, self.gains, self.width, self.prediction = [], [], width, "prediction"
        for _, g in nodes.sort_values(["tree", "id"]).groupby("tree"):
            self.trees.append(tuple(g[c].to_numpy(k) for c, k in (("left", np.int64), ("right", np.int64), ("feature", np.int64),
                                                                  ("threshold", float), ("value", float), ("cover", float))))
            self.gains.append(g["gain"].to_numpy())
        self.weights = np.full(len(self.trees), 1 / len(self.trees)) if weights is None else np.asarray(weights)

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802 (as in Spark ML)
        """Fall of variance by feature, weighted by rows; each tree counts the same."""
        total = np.zeros(self.width)
        for (left, _, feature, _, _, cover), gain in zip(self.trees, self.gains):
            inner = left >= 0
            own = np.bincount(feature[inner], gain[inner] * cover[inner], self.width)
            total += own / own.sum() if own.sum() > 0 else own
        return DenseVector(total / total.sum() if total.sum() > 0 else total)

    def column(self, of_trees, kind: str, features: str = "features"):
        """``of_trees(values)`` of the trees' values (rows x trees) as a column."""
        trees, width = self.trees, self.width

        @F.pandas_udf(kind)
        def score(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            borders, known = tree_borders(trees, width), {}
            for x in parts:
                x = np.stack([np.asarray(c, float) for c in x], axis=1)
                yield pd.Series(list(by_cell(x, borders, known, lambda rows: of_trees(tree_values(rows, trees)))))

        cells = vector_to_array(features)
        return score(*[cells[i] for i in range(width)])

    def part(self, first: int, last: int) -> CellTrees:
        """A forest of some of the trees."""
        out = copy.copy(self)
        out.trees, out.gains = self.trees[first:last], self.gains[first:last]
        out.weights = np.full(last - first, 1 / (last - first))
        return out

    def setPredictionCol(self, name: str) -> CellTrees:  # noqa: N802 (as in Spark ML)
        self.prediction = name
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        weights = self.weights
        return df.withColumn(self.prediction, self.column(lambda v: v @ weights, "double"))


def blended(models: list, average: bool):
    """Predictions of forests of one size, averaged or as an array, by one
    lookup of a row."""
    whole = copy.copy(models[0])
    whole.trees = [t for m in models for t in m.trees]
    each = lambda v: v.reshape(len(v), len(models), -1).mean(axis=2)
    return whole.column(lambda v: each(v).mean(axis=1), "double") if average else whole.column(each, "array<double>")


def tree_borders(trees: list, width: int) -> list:
    """Per feature the thresholds that occur in the trees."""
    return [np.unique(np.concatenate([t[3][(t[0] >= 0) & (t[2] == f)] for t in trees])) for f in range(width)]


def tree_values(x: np.ndarray, trees: list) -> np.ndarray:
    """Value of every tree for every row of ``x``: rows x trees."""
    out = np.empty((len(x), len(trees)))
    rows = np.arange(len(x))
    for i, (left, right, feature, threshold, value, _) in enumerate(trees):
        at = np.zeros(len(x), np.int64)
        while (left[at] >= 0).any():
            inner = left[at] >= 0
            below = x[rows, feature[at]] <= threshold[at]
            at = np.where(inner, np.where(below, left[at], right[at]), at)
        out[:, i] = value[at]
    return out


def by_cell(x: np.ndarray, borders: list, known: dict, value) -> np.ndarray:
    """``value(rows)`` for all rows of ``x``. Rows between the same borders have
    the same value: it is computed once, and ``known`` keeps it for the next
    batches (at most ``KNOWN_CELLS`` of them)."""
    place = np.stack([np.searchsorted(b, x[:, f]) for f, b in enumerate(borders)], axis=1)
    if np.prod([float(len(b) + 1) for b in borders]) < 2 ** 62:
        names = cell_of(list(x.T), borders)
    else:
        place = np.ascontiguousarray(place)
        names = place.view(f"V{place.dtype.itemsize * place.shape[1]}").ravel()
    names, at, back = np.unique(names, return_index=True, return_inverse=True)
    names = [n.tobytes() for n in names] if names.dtype.kind == "V" else names.tolist()
    if len(known) > KNOWN_CELLS:
        known.clear()
    fresh = np.array([i for i, n in enumerate(names) if n not in known], np.int64)
    if len(fresh):
        known.update(zip((names[i] for i in fresh), value(x[at[fresh]])))
    return np.array([known[n] for n in names])[back]


# ------------------------------------------------------------------- fits


def fit_forest(data: DataFrame, num_trees: int = 20, seed: int = 46, max_depth: int = 5, max_bins: int = 32):
    """Random forest regressor of ``label`` on the vectors ``features`` with the
    defaults of Spark ML: a ``CellTrees``, or Spark ML's model where cells do
    not pay."""
    return fit_forests(data, num_trees, [seed], max_depth, max_bins)[0]


def fit_forests(data: DataFrame, num_trees: int, seeds: list, max_depth: int = 5, max_bins: int = 32) -> list:
    """``fit_forest`` for every seed; from cells, all in the same scan."""
    size = few_cells(data, "label", max_bins)
    if size is None:
        return [RandomForestRegressor(numTrees=num_trees, seed=seed, maxDepth=max_depth, maxBins=max_bins).fit(data) for seed in seeds]
    every = forest_of_cells(data, *size, num_trees, seeds[0], max_depth, max_bins, len(seeds))
    return [every.part(i * num_trees, (i + 1) * num_trees) for i in range(len(seeds))]


def forest_of_cells(data: DataFrame, rows: int, width: int, num_trees: int, seed: int, max_depth: int, max_bins: int,
                    forests: int = 1) -> CellTrees:
    borders = bin_borders(data, rows, width, max_bins, seed)
    cells = int(np.prod([len(b) + 1 for b in borders]))
    per_node = width if num_trees == 1 else -(-width // 3)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        used, sums = _total(pdf, cells)
        return _frame(tree, grow_tree(_bins(used, borders), sums, borders, max_depth, per_node, np.random.default_rng([seed, tree])))

    return CellTrees(cell_sums(data, rows, borders, num_trees * forests, seed).groupBy("tree").applyInPandas(grow, NODES).toPandas(), width)


def fit_boosted(data: DataFrame, rounds: int = 20, step: float = 0.1, max_depth: int = 5, seed: int = 46, max_bins: int = 32):
    """Boosted regression trees (squared error) with the defaults of Spark ML. A
    prediction is one number per cell, so the sums of the residuals follow from
    those of the labels, and all rounds need one scan."""
    size = few_cells(data, "label", max_bins)
    if size is None:
        return GBTRegressor(maxIter=rounds, stepSize=step, maxDepth=max_depth, seed=seed, maxBins=max_bins).fit(data)
    return boosted_of_cells(data, *size, rounds, step, max_depth, seed, max_bins)


def boosted_of_cells(data: DataFrame, rows: int, width: int, rounds: int, step: float, max_depth: int, seed: int, max_bins: int) -> CellTrees:
    borders = bin_borders(data, rows, width, max_bins, seed)
    cells = int(np.prod([len(b) + 1 for b in borders]))

    def boost(pdf: pd.DataFrame) -> pd.DataFrame:
        used, (n, s, q) = _total(pdf, cells)
        bins, f, out = _bins(used, borders), np.zeros(len(used)), []
        centres = [np.append(b, np.inf) for b in borders]
        x = np.stack([c[bins[:, i]] for i, c in enumerate(centres)], axis=1)  # upper border: in the bin
        for t in range(rounds):
            # the first tree learns the labels, the others twice the residuals
            sums = np.stack([n, s, q]) if t == 0 else np.stack([n, 2 * (s - n * f), 4 * (q - 2 * f * s + n * f * f)])
            nodes = grow_tree(bins, sums, borders, max_depth, width, np.random.default_rng([seed, t]))
            tree = [np.array(c) for c in zip(*nodes)][:6]
            f = f + (1.0 if t == 0 else step) * tree_values(x, [tree])[:, 0]
            out.append(_frame(t, nodes))
        return pd.concat(out)

    nodes = cell_sums(data, rows, borders, 0, seed).groupBy("tree").applyInPandas(boost, NODES).toPandas()
    return CellTrees(nodes, width, [1.0] + [step] * (rounds - 1))


def weighted_cells(data: DataFrame, rows: int, width: int, group: str, groups: int, max_bins: int, seed: int,
                   plain: bool = False) -> DataFrame:
    """Two points per cell of each ``group`` (0, 1, ...) with the count, sum and
    sum of squares of its labels: their mean plus and minus their deviation, half
    the weight each. ``plain``: rows of ``plain_columns``. The features are the numbers of the bins, so that a tree
    splits between the same rows."""
    borders = [*bin_borders(data, rows, width, max_bins, seed, plain), np.arange(groups - 1) + 0.5]
    cells = int(np.prod([len(b) + 1 for b in borders]))

    def points(pdf: pd.DataFrame) -> pd.DataFrame:
        used, (n, s, q) = _total(pdf, cells)
        bins, mean = _bins(used, borders), s / n
        off = np.sqrt(np.maximum(q / n - mean * mean, 0.0))
        return pd.DataFrame({"x": [*bins[:, :-1].astype(float)] * 2, group: np.tile(bins[:, -1], 2), "label": np.concatenate([mean - off, mean + off]),
                             "weight": np.tile(n / 2, 2)})

    columns = [*feature_columns(width, plain), F.col(group).cast("double").alias(f"x{width}")]
    out = cell_sums(data, rows, borders, 0, seed, columns).groupBy("tree").applyInPandas(
        points, f"x array<double>, {group} int, label double, weight double")
    return out.withColumn("features", array_to_vector("x")).drop("x")
