"""Gradient boosting on the pinball loss, with stopping by a validation part.

Spark ML's boosted trees know no quantile loss. Here each round fits one
Spark ML regression tree to the sign of the residuals (the negative gradient)
and replaces its leaf values by the quantile of the residuals in each leaf: one
grouped aggregate with a sketch (rank error at most a hundred-thousandth of the
rows). Trees are read into nested conditions, so predictions are column
expressions in the JVM and a model is a list of small literals.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.scale import one_row, quantiles, spread
from .cells import _chunks, bin_borders, cell_of, feature_columns, few_cells, grow_tree, tree_values

#: Rounds between two checkpoints, which cut the lineage of the running predictions.
CHECKPOINT_EVERY = 10
#: Bins of a feature, as in Spark ML.
MAX_BINS = 32
#: Bins per leaf in the search of a rank, stages of that search at most (each
#: within a bin of the last), and the rows of a bin whose values are fetched.
RANK_BINS, MOST_STAGES, FETCHED = 8192, 6, 20_000


def pinball(label: Column, prediction: Column, tau: float) -> Column:
    """tau (y - f) above the prediction, (1 - tau) (f - y) below it."""
    rest = label - prediction
    return F.greatest(rest * tau, rest * (tau - 1))


def _node(java_node, count: list):
    """(feature, threshold, left, right), or the leaf's number in preorder."""
    if java_node.getClass().getSimpleName() == "LeafNode":
        count[0] += 1
        return count[0] - 1
    split = java_node.split()
    left = _node(java_node.leftChild(), count)
    return split.featureIndex(), split.threshold(), left, _node(java_node.rightChild(), count)


def _expression(node, leaf) -> Column:
    if isinstance(node, int):
        return leaf(node)
    feature, threshold, left, right = node
    return F.when(F.col("x")[feature] <= threshold, _expression(left, leaf)).otherwise(_expression(right, leaf))


@dataclass
class Boosted:
    """``start`` plus, for every stage, a tree and the steps of its leaves.

    ``history``: loss on the training and on the validation part after every
    round, whether it is kept or not; the model ends with the best stage."""

    start: float
    stages: list = field(default_factory=list)
    history: list = field(default_factory=list)

    def predict(self, stages=None) -> Column:
        """Prediction from the feature array ``x``."""
        out = F.lit(self.start)
        for node, steps in self.stages if stages is None else stages:
            out = out + _expression(node, lambda i, s=steps: F.lit(s[i]))
        return out


def boost_quantile(data: DataFrame, tau: float, rounds: int = 100, depth: int = 3, learning_rate: float = 0.1,
                   validation: Column | None = None, patience: int = 10, min_gain: float = 1e-4,
                   resume: Boosted | None = None, seed: int = 46) -> Boosted:
    """Fit the ``tau`` quantile of ``label`` from the vector ``features``.

    With ``validation`` (a boolean column) those rows are not learned from: the
    fit stops once their loss has not fallen by ``min_gain`` of itself for
    ``patience`` rounds, and keeps the stages up to the best round. ``resume``
    goes on from a fitted model. Without rows there are no stages.
    """
    held = F.lit(False) if validation is None else F.coalesce(validation, F.lit(False))
    now = data.select("features", vector_to_array("features").alias("x"), F.col("label").cast("double").alias("label"),
                      held.alias("held"))
    model = resume or Boosted(quantiles(now.filter("NOT held"), "label", [tau])[0])
    if model.start is None:
        return Boosted(0.0)
    now = now.withColumn("f", model.predict()).persist(StorageLevel.MEMORY_AND_DISK)

    def losses(frame):
        loss = pinball(F.col("label"), F.col("f"), tau)
        r = one_row(frame, F.avg(F.when(~F.col("held"), loss)).alias("train"), F.avg(F.when(F.col("held"), loss)).alias("held"))
        return r["train"], r["held"]

    stages, history = list(model.stages), list(model.history)
    best, best_at, since = losses(now)[1], len(stages), 0
    tree = DecisionTreeRegressor(labelCol="g", maxDepth=depth, seed=seed)
    for number in range(rounds):
        rest = F.col("label") - F.col("f")
        learn = now.filter("NOT held").withColumn("g", F.when(rest > 0, F.lit(tau)).otherwise(F.lit(tau - 1.0)))
        count = [0]
        node = _node(tree.fit(learn.select("features", "g"))._java_obj.rootNode(), count)
        values = {r["leaf"]: r["q"] for r in learn.groupBy(_expression(node, F.lit).alias("leaf")).agg(
            F.percentile_approx(rest, F.lit(tau), 100000).alias("q")).collect()}  # at most 2^depth rows
        steps = [learning_rate * values.get(i, 0.0) for i in range(count[0])]
        stages.append((node, steps))
        after = now.withColumn("f", F.col("f") + _expression(node, lambda i: F.lit(steps[i])))
        after = after.checkpoint() if (number + 1) % CHECKPOINT_EVERY == 0 else after.persist(StorageLevel.MEMORY_AND_DISK)
        history.append(losses(after))
        now.unpersist()
        now = after
        if best is not None:
            if history[-1][1] < best * (1 - min_gain):
                best, best_at, since = history[-1][1], len(stages), 0
            else:
                since += 1
                if since >= patience:
                    break
    now.unpersist()
    return Boosted(model.start, stages[:best_at] if best is not None else stages, history)


# ------------------------------------------------------------- from cells


def boost_quantiles(data: DataFrame, taus: list, rounds: int = 100, depth: int = 3, learning_rate: float = 0.1,
                    validation: Column | None = None, patience: int = 10, min_gain: float = 1e-4, seed: int = 46) -> list:
    """``boost_quantile`` for every tau. Where few features make few cells of bins
    (``cells``), the rows are stored once as cell numbers and labels; a prediction
    is one number per cell, so a round of all taus is three scans of that store:
    signs of the residuals by cell (from which the tree grows) with the losses,
    then the residual of the wanted rank in every leaf, exactly, by a histogram
    and the values of one of its bins. Nothing is written per round."""
    size = few_cells(data, "label", MAX_BINS)
    if size is None:
        def bound(tau):
            return boost_quantile(data, tau, rounds, depth, learning_rate, validation, patience, min_gain, seed=seed)

        # beside each other: their rounds are chains of small jobs
        with ThreadPoolExecutor(len(taus)) as pool:
            return list(pool.map(inheritable_thread_target(data.sparkSession)(bound), taus))
    rows, width = size
    held = F.lit(False) if validation is None else F.coalesce(validation, F.lit(False))
    narrow = data.select("features", F.col("label").cast("double").alias("label"), held.alias("held"))
    learn = narrow.filter("NOT held")
    starts = quantiles(learn, "label", list(taus))
    if starts[0] is None:
        return [Boosted(0.0) for _ in taus]
    store = _CellStore(narrow, rows, bin_borders(learn, rows, width, MAX_BINS, seed), seed)
    try:
        models = [Boosted(start) for start in starts]
        f = {i: np.full(store.cells, start) for i, start in enumerate(starts)}
        state = store.state(f, taus, depth)
        best = {i: (state[i][1], 0) for i in f}
        for number in range(rounds):
            leaves = {i: store.leaf_of(state[i][2]) for i in f}
            values = store.leaf_quantiles(f, leaves, taus)
            for i in f:
                node, order = _nested(state[i][2])
                steps = {leaf: learning_rate * value for leaf, value in values[i].items()}
                models[i].stages.append((node, [steps.get(leaf, 0.0) for leaf in order]))
                by_node = np.zeros(len(state[i][2]))
                by_node[list(steps)] = list(steps.values())
                f[i] = f[i] + by_node[leaves[i]]
            state = store.state(f, taus, depth)
            for i in list(f):
                models[i].history.append(state[i][:2])
                if best[i][0] is None:
                    continue
                if state[i][1] < best[i][0] * (1 - min_gain):
                    best[i] = (state[i][1], number + 1)
                elif number + 1 - best[i][1] >= patience:
                    del f[i]
            if not f:
                break
    finally:
        store.blocks.unpersist()
    for i, model in enumerate(models):
        if best[i][0] is not None:
            model.stages = model.stages[:best[i][1]]
    return models


def _nested(nodes: np.ndarray):
    """The tree as ``_expression`` reads it, and the nodes that its leaves are."""
    order = []

    def at(i):
        left, right, feature, threshold = nodes[i][:4]
        if left < 0:
            order.append(i)
            return len(order) - 1
        return int(feature), float(threshold), at(int(left)), at(int(right))
    return at(0), order


class _CellStore:
    """Rows as (cell, label) in large binary blocks, learned and held ones apart."""

    def __init__(self, narrow: DataFrame, rows: int, borders: list, seed: int):
        self.borders, self.seed, width = borders, seed, len(borders)
        self.cells = int(np.prod([len(b) + 1 for b in borders]))
        upper = [np.append(b, np.inf) for b in borders]
        bins = np.stack(np.unravel_index(np.arange(self.cells), [len(u) for u in upper]), axis=1)
        self.bins, self.x = bins, np.stack([u[bins[:, i]] for i, u in enumerate(upper)], axis=1)

        def pack(batches):
            for table in _chunks(batches):
                cell = cell_of([table[f"x{i}"].to_numpy() for i in range(width)], borders).astype(np.uint16)
                y, held = table["label"].to_numpy(), table["held"].to_numpy()
                yield pa.RecordBatch.from_pydict({n: pa.array([v.tobytes()], pa.binary()) for n, v in (
                    ("cell", cell[~held]), ("y", y[~held]), ("held_cell", cell[held]), ("held_y", y[held]))})

        narrow = spread(narrow.select(*feature_columns(width), "label", "held"), rows)
        self.blocks = narrow.mapInArrow(pack, "cell binary, y binary, held_cell binary, held_y binary").persist(StorageLevel.MEMORY_AND_DISK)
        self.blocks.count()
        # what a task returns does not grow with its rows
        self.parts = self.blocks.coalesce(2 * narrow.sparkSession.sparkContext.defaultParallelism)
        cells = self.cells

        def ends(batches):
            low, high = np.full(cells, np.inf), np.full(cells, -np.inf)
            for cell, y, _, _ in _unpacked(batches):
                np.minimum.at(low, cell, y)
                np.maximum.at(high, cell, y)
            yield pa.RecordBatch.from_pydict({"low": pa.array([low], pa.list_(pa.float64())), "high": pa.array([high], pa.list_(pa.float64()))})

        found = self.parts.mapInArrow(ends, "low array<double>, high array<double>").collect()
        self.low = np.min([r["low"] for r in found], axis=0)
        self.high = np.max([r["high"] for r in found], axis=0)

    def state(self, f: dict, taus: list, depth: int) -> dict:
        """For every model: loss on the learned and on the held rows, and the nodes
        of the tree on the signs of the residuals."""
        cells, bins, borders, seed = self.cells, self.bins, self.borders, self.seed
        schema = "model int, n array<double>, above array<double>, learned array<double>, held array<double>"

        def sums(batches):
            n, above = np.zeros(cells), {i: np.zeros(cells) for i in f}
            loss = {i: np.zeros(4) for i in f}
            for cell, y, held_cell, held_y in _unpacked(batches):
                n += np.bincount(cell, minlength=cells)
                for i, value in f.items():
                    rest = y - value[cell]
                    above[i] += np.bincount(cell[rest > 0], minlength=cells)
                    away = held_y - value[held_cell]
                    loss[i] += [np.maximum(rest * taus[i], rest * (taus[i] - 1)).sum(), len(rest),
                                np.maximum(away * taus[i], away * (taus[i] - 1)).sum(), len(away)]
            for i in f:
                yield pa.RecordBatch.from_pydict({"model": pa.array([i], pa.int32()), **{
                    k: pa.array([v], pa.list_(pa.float64())) for k, v in (("n", n), ("above", above[i]), ("learned", loss[i][:2]), ("held", loss[i][2:]))}})

        def grow(pdf):
            i = int(pdf["model"].iloc[0])
            n, above, learned, held = (np.sum(np.stack(pdf[c].to_numpy()), axis=0) for c in ("n", "above", "learned", "held"))
            used, tau = np.flatnonzero(n), taus[i]
            n, above = n[used], above[used]
            total = np.stack([n, tau * above + (tau - 1) * (n - above), tau ** 2 * above + (tau - 1) ** 2 * (n - above)])
            nodes = np.nan_to_num(np.array(grow_tree(bins[used], total, borders, depth, len(borders), np.random.default_rng(seed))))
            mean = [float(s / m) if m else None for s, m in (learned, held)]
            return pd.DataFrame({"model": [i], "learned": [mean[0]], "held": [mean[1]], "nodes": [nodes.tolist()]})

        out = self.parts.mapInArrow(sums, schema).groupBy("model").applyInPandas(
            grow, "model int, learned double, held double, nodes array<array<double>>").collect()
        return {r["model"]: (r["learned"], r["held"], np.array(r["nodes"])) for r in out}

    def leaf_of(self, nodes: np.ndarray) -> np.ndarray:
        """Node of the leaf of every cell."""
        left, right, feature, threshold = nodes[:, :4].T
        tree = (left.astype(int), right.astype(int), feature.astype(int), threshold, np.arange(len(nodes)), None)
        return tree_values(self.x, [tree])[:, 0].astype(np.int64)

    def leaf_quantiles(self, f: dict, leaves: dict, taus: list) -> dict:
        """For every model and leaf the residual of which a share tau are at most as large."""
        stages, rank, size = {}, {}, {i: int(leaves[i].max()) + 1 for i in f}
        low, width = {}, {}
        for i in f:
            low[i], high = np.full(size[i], np.inf), np.full(size[i], -np.inf)
            np.minimum.at(low[i], leaves[i], self.low - f[i])
            np.maximum.at(high, leaves[i], self.high - f[i])
            low[i] = np.where(np.isfinite(low[i]), low[i], 0.0)
            width[i] = np.where(np.isfinite(high), high - low[i], 0.0)
            stages[i], rank[i] = [], None
        for _ in range(MOST_STAGES):
            now = {i: (low[i], RANK_BINS / np.where(width[i] > 0, width[i], 1.0)) for i in f}
            counts = self._histograms(f, leaves, stages, now, size)
            most = 0
            for i in f:
                if rank[i] is None:
                    rank[i] = np.maximum(np.ceil(taus[i] * counts[i].sum(1)).astype(np.int64) - 1, 0)
                running = counts[i].cumsum(1)
                j = (running <= rank[i][:, None]).sum(1).clip(0, RANK_BINS - 1)
                each = np.arange(size[i])
                rank[i] = rank[i] - np.where(j > 0, running[each, j - 1], 0)
                stages[i].append((*now[i], j))
                low[i], width[i] = low[i] + j / now[i][1], np.where(width[i] > 0, 1.0 / now[i][1], 0.0)
                most = max(most, counts[i][each, j].max())
            if most <= FETCHED:
                break
        found = {i: {} for i in f}
        for r in self._values(f, leaves, stages).groupBy("model", "leaf", "value").agg(F.sum("n").alias("n")).collect():
            found[r["model"]].setdefault(r["leaf"], []).append((r["value"], r["n"]))
        out = {i: {} for i in f}
        for i, by_leaf in found.items():
            for leaf, pairs in by_leaf.items():
                values, n = map(np.array, zip(*sorted(pairs)))
                out[i][leaf] = float(values[min(np.searchsorted(n.cumsum(), rank[i][leaf], "right"), len(values) - 1)])
        return out

    def _histograms(self, f, leaves, stages, now, size) -> dict:
        def count(batches):
            total = {i: np.zeros(size[i] * RANK_BINS, np.int64) for i in f}
            for cell, y, _, _ in _unpacked(batches):
                for i in f:
                    leaf, rest = _left(cell, y, f[i], leaves[i], stages[i])
                    total[i] += np.bincount(leaf * RANK_BINS + _place(rest, leaf, *now[i]), minlength=len(total[i]))
            for i in f:
                used = np.flatnonzero(total[i])
                yield pa.RecordBatch.from_pydict({"model": pa.array([i] * len(used), pa.int32()), "at": pa.array(used, pa.int64()),
                                                  "n": pa.array(total[i][used], pa.int64())})

        out = {i: np.zeros(size[i] * RANK_BINS, np.int64) for i in f}
        sums = self.parts.mapInArrow(count, "model int, at long, n long").groupBy("model", "at").agg(F.sum("n").alias("n")).toPandas()
        for i in f:
            mine = sums[sums["model"] == i]
            out[i][mine["at"].to_numpy()] = mine["n"].to_numpy()
        return {i: v.reshape(size[i], RANK_BINS) for i, v in out.items()}

    def _values(self, f, leaves, stages) -> DataFrame:
        def values(batches):
            for cell, y, _, _ in _unpacked(batches):
                for i in f:
                    leaf, rest = _left(cell, y, f[i], leaves[i], stages[i])
                    for k in np.unique(leaf):
                        value, n = np.unique(rest[leaf == k], return_counts=True)
                        yield pa.RecordBatch.from_pydict({"model": pa.array([i] * len(value), pa.int32()), "leaf": pa.array([int(k)] * len(value), pa.int32()),
                                                          "value": pa.array(value), "n": pa.array(n, pa.int64())})

        return self.parts.mapInArrow(values, "model int, leaf int, value double, n long")


def _unpacked(batches):
    for batch in batches:
        for row in zip(*(batch.column(c) for c in ("cell", "y", "held_cell", "held_y"))):
            yield [np.frombuffer(v.as_buffer(), k) for v, k in zip(row, (np.uint16, np.float64) * 2)]


def _place(rest, leaf, low, scale):
    """Bin of the residual, counted within its leaf."""
    return ((rest - low[leaf]) * scale[leaf]).clip(0, RANK_BINS - 1).astype(np.int64)


def _left(cell, y, f, leaf_of, stages):
    """Leaf and residual of the rows that lie in the chosen bin of every stage."""
    leaf, rest = leaf_of[cell], y - f[cell]
    for low, scale, chosen in stages:
        keep = _place(rest, leaf, low, scale) == chosen[leaf]
        leaf, rest = leaf[keep], rest[keep]
    return leaf, rest
