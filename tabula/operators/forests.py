"""Many random forest classifiers in one job: the folds and settings of a search.

A fit of Spark ML is a chain of small jobs, one or more per level, and a search
fits hundreds of forests: its time goes into jobs, and for deep trees into one
scan of the rows for every group of nodes that fits the memory for statistics.
Here the rows are binned once per fold (borders from a sample of its training
rows, as in Spark ML), and dealt to packs of forests: one group per pack holds
the bins of the fold, one byte a cell, grows its forests level by level and
counts the held-out rows they get right. Only these counts leave the group.

The best setting is refitted in the same way, a tree or a few a group; the trees
stay in a table (``ForestTable``). Shallow refits are Spark ML's.

A group holds at most ``GROUP_CELLS`` bytes of bins; larger frames, and up to
``SMALL_ROWS`` rows, go to Spark ML. The rules are Spark ML's (Poisson(1)
counts per tree, features drawn per node, largest fall of impurity, sibling
leaves of one class merged, votes by the shares in a leaf), the draws are not.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.scale import one_row, spread
from ..session import shared_path
from .cells import _borders

#: Most cells (rows times features, a byte each) of the frame that a group holds.
GROUP_CELLS = 64 << 20
#: Up to so many rows Spark ML fits them as they are.
SMALL_ROWS = 1000
#: Most classes: a node's statistics are bins times classes.
MOST_CLASSES = 100
#: Nodes whose statistics are held at a time.
CHUNK_NODES = 2048
#: Nodes of fewer rows are split from their sorted rows, not from all bins.
FEW_ROWS = 32
#: Up to so many nodes on the last level of all trees Spark ML refits the best
#: setting: it scans the rows once per group of nodes that fits its memory.
REFIT_NODES = 8192
#: Rows of a block.
BLOCK_ROWS = 8192

SETTINGS = ("numTrees", "maxDepth", "featureSubsetStrategy", "minInstancesPerNode", "impurity", "bootstrap")
#: Parameters without a say in the result.
FREE = (*SETTINGS, "seed", "maxBins", "maxMemoryInMB", "cacheNodeIds", "checkpointInterval")


# ------------------------------------------------------------------ trees


def _fall(left: np.ndarray, total: np.ndarray, least: int, entropy: bool) -> np.ndarray:
    """Fall of impurity by splitting ``total`` into ``left`` and the rest
    (counts by class in the last axis); -1 where a side has less than ``least``."""
    right = total - left
    n, nl, nr = total.sum(-1), left.sum(-1), right.sum(-1)

    def disorder(counts, size):
        if entropy:
            return _xlogx(size) - _xlogx(counts).sum(-1)
        return size - np.einsum("...c,...c->...", counts, counts) / np.maximum(size, 1)

    fall = (disorder(total, n) - disorder(left, nl) - disorder(right, nr)) / n
    return np.where((nl >= least) & (nr >= least), fall, -1.0)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log2(np.maximum(x, 1))


def _best_of_large(x, y, w, rows, sizes, features, bins, classes, least, entropy):
    """(fall, feature, bin) of the best split of each node; ``rows`` are in the
    order of the nodes."""
    k = len(sizes)
    node, yr, wr = np.repeat(np.arange(k), sizes), y[rows], w[rows]
    base, best = node * bins * classes + yr, (np.full(k, -1.0), np.full(k, -1), np.zeros(k, np.int64))
    for f in features.T:
        at = base + x[rows, np.repeat(f, sizes)].astype(np.int64) * classes
        left = np.bincount(at, wr, k * bins * classes).reshape(k, bins, classes).cumsum(1)
        fall = _fall(left[:, :-1], left[:, -1:], least, entropy)
        cut = fall.argmax(1)
        _keep(best, fall[np.arange(k), cut], f, cut)
    return best


def _best_of_small(x, y, w, rows, sizes, features, bins, classes, least, entropy):
    k, ends = len(sizes), np.cumsum(sizes)
    node, first = np.repeat(np.arange(k), sizes), ends - sizes
    one = np.zeros((len(rows), classes))
    one[np.arange(len(rows)), y[rows]] = w[rows]
    total = np.add.reduceat(one, first, axis=0)
    best = (np.full(k, -1.0), np.full(k, -1), np.zeros(k, np.int64))
    for f in features.T:
        b = x[rows, np.repeat(f, sizes)].astype(np.int64)
        key = node * bins + b
        order = np.argsort(key, kind="stable")
        key = key[order]
        # candidates: the last row of a bin, unless it is the last of its node
        last = np.flatnonzero((key[1:] != key[:-1]) & (node[1:] == node[:-1]))
        if not len(last):
            continue
        run = one[order].cumsum(0)
        of = node[last]
        before = np.where(first[of, None] > 0, run[first[of] - 1], 0.0)
        fall = _fall(run[last] - before, total[of], least, entropy)
        start = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        top = np.maximum.reduceat(fall, start)
        place = np.flatnonzero(fall == np.repeat(top, np.diff(np.append(start, len(of)))))
        place = place[np.append(True, of[place[1:]] != of[place[:-1]])]  # the first of equal ones
        found, cut = np.full(k, -1.0), np.zeros(k, np.int64)
        found[of[place]], cut[of[place]] = fall[place], key[last[place]] % bins
        _keep(best, found, f, cut)
    return best


def _keep(best, fall, feature, cut) -> None:
    better = fall > best[0]
    best[0][better], best[1][better], best[2][better] = fall[better], feature[better], cut[better]


def grow_tree(x: np.ndarray, y: np.ndarray, w: np.ndarray, classes: int, bins: int, depth: int, per_node: int,
              least: int, entropy: bool, rng) -> tuple:
    """(feature or -1, bin, left child, counts by class) of the nodes, in level
    order; rows of at most the bin go to the left child, the others to the next."""
    rows = np.flatnonzero(w)
    sizes, made, levels = np.array([len(rows)]), 1, []
    for level in range(depth + 1):
        k = len(sizes)
        node = np.repeat(np.arange(k), sizes)
        counts = np.bincount(node * classes + y[rows], w[rows], k * classes).reshape(k, classes)
        feature, cut, left = np.full(k, -1), np.zeros(k, np.int64), np.full(k, -1)
        levels.append((feature, cut, left, counts))
        open_ = (counts.max(1) < counts.sum(1)) & (counts.sum(1) >= 2 * least)
        if level == depth or not open_.any():
            break
        ends = np.cumsum(sizes)
        for some, best_of in ((open_ & (sizes >= FEW_ROWS), _best_of_large), (open_ & (sizes < FEW_ROWS), _best_of_small)):
            some = np.flatnonzero(some)
            for i in range(0, len(some), CHUNK_NODES):
                part = some[i:i + CHUNK_NODES]
                drawn = (rng.random((len(part), x.shape[1])).argpartition(per_node - 1, axis=1)[:, :per_node]
                         if per_node < x.shape[1] else np.tile(np.arange(x.shape[1]), (len(part), 1)))
                held = np.repeat(ends[part] - sizes[part] - np.append(0, np.cumsum(sizes[part])[:-1]), sizes[part])
                fall, f, c = best_of(x, y, w, rows[held + np.arange(len(held))], sizes[part], np.sort(drawn, axis=1),
                                     bins, classes, least, entropy)
                split = fall > 1e-12
                feature[part[split]], cut[part[split]] = f[split], c[split]
        split = feature >= 0
        if not split.any():
            break
        left[split] = made + 2 * np.arange(split.sum())
        made += 2 * int(split.sum())
        inner = split[node]
        rows, node = rows[inner], node[inner]
        child = 2 * (np.cumsum(split) - 1)[node] + (x[rows, feature[node]] > cut[node])
        rows, sizes = rows[np.argsort(child, kind="stable")], np.bincount(child, minlength=2 * int(split.sum()))
    return _merged(levels)


def _merged(levels: list) -> tuple:
    """The levels in one, sibling leaves of the same class made one leaf."""
    for (feature, _, left, _), (below, _, _, counts) in zip(levels[-2::-1], levels[:0:-1]):
        inner = np.flatnonzero(feature >= 0)
        pair = 2 * np.arange(len(inner))  # children lie in the order of their parents
        of = counts.argmax(1)
        same = (below[pair] < 0) & (below[pair + 1] < 0) & (of[pair] == of[pair + 1])
        feature[inner[same]] = left[inner[same]] = -1
    return tuple(np.concatenate(part) for part in zip(*levels))


def add_votes(votes: np.ndarray, x: np.ndarray, tree: tuple) -> None:
    feature, cut, left, counts = tree
    at, live = np.zeros(len(x), np.int64), np.arange(len(x))
    while len(live):
        live = live[feature[at[live]] >= 0]
        now = at[live]
        at[live] = left[now] + (x[live, feature[now]] > cut[now])
    votes += (counts / counts.sum(1, keepdims=True))[at]


# ----------------------------------------------------------------- search


def features_per_node(strategy: str, width: int) -> int | None:
    """As Spark ML reads it for a classifier of several trees; None: not known."""
    known = {"auto": math.ceil(math.sqrt(width)), "sqrt": math.ceil(math.sqrt(width)), "all": width,
             "log2": max(1, math.ceil(math.log2(width))), "onethird": math.ceil(width / 3)}
    strategy = str(strategy).lower()
    if strategy.isdigit() and int(strategy) > 0:
        return min(int(strategy), width)
    return known.get(strategy)


def settings_of(estimator, maps: list, evaluator) -> list | None:
    """The settings of every map, or None where Spark ML has to fit them."""
    if type(estimator) is not RandomForestClassifier or type(evaluator) is not MulticlassClassificationEvaluator:
        return None
    named = {p.name for pm in maps for p in pm}
    changed = {p.name for o in (estimator, evaluator) for p in o.params
               if o.isSet(p) and not (o.hasDefault(p) and o.getOrDefault(p) == o._defaultParamMap[p])}
    if not named <= set(SETTINGS) or not changed <= {*FREE, "metricName"} or evaluator.getMetricName() != "accuracy":
        return None
    out = [{n: pm.get(estimator.getParam(n), estimator.getOrDefault(n)) for n in SETTINGS} for pm in maps]
    fits = all(s["numTrees"] > 1 and s["impurity"] in ("gini", "entropy") for s in out)
    return out if fits and estimator.getMaxBins() <= 256 else None


def _plan(estimator, data: DataFrame, maps: list, evaluator) -> tuple | None:
    """(settings, features per node of each, rows, features, classes) of a random
    forest search over the persisted rows (features, label, ...), or None."""
    settings = settings_of(estimator, maps, evaluator)
    if settings is None:
        return None
    y = F.col("label").cast("double")
    size = one_row(data, F.count(F.lit(1)).alias("n"), F.max(y).alias("top"),
                   F.count(F.when((y >= 0) & (y == F.floor(y)) & ~F.isnan(y), 1)).alias("whole"))
    if size["n"] <= SMALL_ROWS or size["whole"] < size["n"] or size["top"] >= MOST_CLASSES:
        return None
    width, classes = len(data.select("features").first()[0]), int(size["top"]) + 1
    per_node = [features_per_node(s["featureSubsetStrategy"], width) for s in settings]
    if classes < 2 or None in per_node or size["n"] * width > GROUP_CELLS:
        return None
    return settings, per_node, size["n"], width, classes


def fold_accuracies(estimator, data: DataFrame, maps: list, evaluator, folds: int) -> np.ndarray | None:
    """Accuracy of every fold and map (folds x maps) of a random forest search
    over the persisted rows (features, label, _fold), or None: for Spark ML."""
    plan = _plan(estimator, data, maps, evaluator) if len(maps) > 1 else None
    if plan is None:
        return None
    settings, per_node, n, width, classes = plan
    rows = data.select(vector_to_array("features").alias("x"), F.col("label").cast("int").alias("y"), F.col("_fold").cast("int").alias("fold"))
    most, seed = estimator.getMaxBins(), estimator.getSeed() % 2 ** 32
    borders = [_fold_borders(rows.filter(F.col("fold") != k), n, max(most ** 2, 10_000), most, seed) for k in range(folds)]
    bins = max(len(b) + 1 for of_fold in borders for b in of_fold)

    # packs of a fold: the costliest forests first, each to the pack with least to do
    packs = min(len(maps), -(-3 * data.sparkSession.sparkContext.defaultParallelism // folds))
    levels, dealt, load = math.log2(n), [[] for _ in range(packs)], [0.0] * packs
    cost = [s["numTrees"] * min(s["maxDepth"], levels) * m for s, m in zip(settings, per_node)]
    for i in sorted(range(len(maps)), key=lambda i: -cost[i]):
        least = load.index(min(load))
        dealt[least].append(i)
        load[least] += cost[i]

    def run(key, table):
        k, (x, label, held) = key[0].as_py() // packs, _rows(table, width)
        xt, yt, xh, yh = x[~held], label[~held], x[held], label[held]
        found = [_hits(xt, yt, xh, yh, classes, bins, settings[i], per_node[i], [seed, k]) for i in dealt[key[0].as_py() % packs]]
        return pa.table({"fold": pa.array([k] * len(found), pa.int32()), "setting": pa.array(dealt[key[0].as_py() % packs], pa.int32()),
                         "score": pa.array([h / len(yh) for h in found], pa.float64())})

    blocks = spread(rows, n).mapInArrow(lambda it: _blocks(it, borders), "of int, part int, seq int, x binary, y binary, fold binary")
    scores = np.full((folds, len(maps)), np.nan)
    for r in _dealt(blocks, folds, packs).groupBy("pack").applyInArrow(run, "fold int, setting int, score double").collect():
        scores[r["fold"], r["setting"]] = r["score"]
    return scores


def _dealt(blocks: DataFrame, folds: int, packs: int) -> DataFrame:
    """The blocks of every fold to each of its packs, a pack a task."""
    return (blocks.select("*", F.explode(F.sequence(F.col("of") * packs, F.col("of") * packs + (packs - 1))).alias("pack"))
            .repartitionByRange(folds * packs, "pack"))


def _rows(table: pa.Table, width: int) -> tuple:
    """Bins, labels and whether held out, of the rows of a group's blocks."""
    table = table.sort_by([("part", "ascending"), ("seq", "ascending")])
    x, label, fold = (np.frombuffer(b"".join(table[c].to_pylist()), np.uint8) for c in ("x", "y", "fold"))
    return x.reshape(-1, width), label.astype(np.int64), fold.view(bool)


def _fold_borders(rows: DataFrame, n: int, wanted: int, max_bins: int, seed: int) -> list:
    sample = (rows.select("x").sample(False, wanted / n, seed) if n > wanted else rows.select("x")).toPandas()["x"]
    return [_borders(column, max_bins) for column in np.stack(sample.to_numpy()).T]


def _blocks(batches, borders: list):
    """For every fold the rows' bins by its borders, their labels, and whether
    the fold holds them out."""
    part, seq = TaskContext.get().partitionId(), 0
    for batch in batches:
        for i in range(0, batch.num_rows, BLOCK_ROWS):
            piece = batch.slice(i, BLOCK_ROWS)
            x = piece.column("x").flatten().to_numpy(zero_copy_only=False).reshape(piece.num_rows, -1)
            y, fold = (piece.column(c).to_numpy(zero_copy_only=False) for c in ("y", "fold"))
            for k, of_fold in enumerate(borders):
                cells = np.stack([np.searchsorted(b, x[:, f]) for f, b in enumerate(of_fold)], axis=1).astype(np.uint8)
                yield pa.RecordBatch.from_pydict({
                    "of": pa.array([k], pa.int32()), "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()),
                    "x": pa.array([cells.tobytes()], pa.binary()), "y": pa.array([y.astype(np.uint8).tobytes()], pa.binary()),
                    "fold": pa.array([(fold == k).astype(np.uint8).tobytes()], pa.binary())})
            seq += 1


def _hits(xt, yt, xh, yh, classes: int, bins: int, setting: dict, per_node: int, seed: list) -> int:
    votes = np.zeros((len(yh), classes))
    for t in range(setting["numTrees"]):
        rng = np.random.default_rng([*seed, t])
        w = rng.poisson(1.0, len(yt)) if setting["bootstrap"] else np.ones(len(yt), np.int64)
        if w.any():
            add_votes(votes, xh, grow_tree(xt, yt, w, classes, bins, setting["maxDepth"], per_node,
                                           setting["minInstancesPerNode"], setting["impurity"] == "entropy", rng))
    return int((votes.argmax(1) == yh).sum())


# ------------------------------------------------------------------ refit

TREE = ("tree int, feature array<int>, threshold array<double>, left array<int>, shares array<double>, "
        "rows array<long>, importances array<double>")


def refit(estimator, data: DataFrame, pm: dict, evaluator) -> ForestTable | None:
    """The forest of one setting over all the persisted rows, or None: for Spark
    ML, which has few levels to scan the rows for, or has to fit them anyway."""
    plan = _plan(estimator, data, [pm], evaluator)
    if plan is None:
        return None
    (setting,), (per_node,), n, width, classes = plan
    trees = setting["numTrees"]
    if trees * min(2.0 ** setting["maxDepth"], n) <= REFIT_NODES:
        return None
    rows = data.select(vector_to_array("features").alias("x"), F.col("label").cast("int").alias("y"), F.lit(-1).alias("fold"))
    most, seed = estimator.getMaxBins(), estimator.getSeed() % 2 ** 32
    borders = _fold_borders(rows, n, max(most ** 2, 10_000), most, seed)
    bins, entropy = max(len(b) + 1 for b in borders), setting["impurity"] == "entropy"
    packs = min(trees, 3 * data.sparkSession.sparkContext.defaultParallelism)

    def grow(key, table):
        x, y, _ = _rows(table, width)
        found = [_grown(x, y, classes, bins, setting, per_node, entropy, [seed, t], borders) for t in range(key[0].as_py(), trees, packs)]
        names = ("feature", "threshold", "left", "shares", "rows", "importances")
        return pa.table({"tree": pa.array(range(key[0].as_py(), trees, packs), pa.int32()),
                         **{c: pa.array([f[i] for f in found], pa.list_(pa.from_numpy_dtype(found[0][i].dtype))) for i, c in enumerate(names)}})

    blocks = spread(rows, n).mapInArrow(lambda it: _blocks(it, [borders]), "of int, part int, seq int, x binary, y binary, fold binary")
    path = shared_path(data.sparkSession, "forest")
    _dealt(blocks, 1, packs).groupBy("pack").applyInArrow(grow, TREE).write.parquet(path)
    return ForestTable(data.sparkSession.read.schema(TREE).parquet(path), trees, width, classes)


def _grown(x, y, classes: int, bins: int, setting: dict, per_node: int, entropy: bool, seed: list, borders: list) -> tuple:
    """A tree as arrays: feature (-1: leaf), threshold, left child (the right one
    is the next), shares of the classes (nodes x classes, flat), rows, and
    the fall of impurity by feature, summing to 1."""
    rng = np.random.default_rng(seed)
    w = rng.poisson(1.0, len(y)) if setting["bootstrap"] else np.ones(len(y), np.int64)
    feature, cut, left, counts = grow_tree(x, y, w, classes, bins, setting["maxDepth"], per_node, setting["minInstancesPerNode"], entropy, rng)
    inner, size = np.flatnonzero(feature >= 0), counts.sum(1)
    threshold = np.full(len(feature), np.nan)
    for f in np.unique(feature[inner]):
        at = inner[feature[inner] == f]
        threshold[at] = borders[f][cut[at]]
    fall = _fall(counts[left[inner]], counts[inner], 0, entropy) * size[inner]
    importances = np.bincount(feature[inner], fall, x.shape[1])
    importances = importances / importances.sum() if importances.sum() > 0 else importances
    return (feature.astype(np.int32), threshold, left.astype(np.int32), (counts / size[:, None]).ravel(),
            size.astype(np.int64), importances)


class ForestTable:
    """A fitted random forest whose trees are rows of a table (``TREE``): a deep
    tree has about as many nodes as it has seen rows, which the driver
    never holds. ``transform`` adds the columns of a Spark ML model."""

    def __init__(self, trees: DataFrame, number: int, width: int, classes: int):
        self.trees, self.getNumTrees, self.numFeatures, self.numClasses = trees, number, width, classes

    @property
    def totalNumNodes(self) -> int:  # noqa: N802 (as in Spark ML)
        return one_row(self.trees, F.sum(F.size("feature")).alias("n"))["n"]

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802 (as in Spark ML)
        """Fall of impurity by feature, weighted by rows; each tree counts the same."""
        total = one_row(self.trees, *[F.sum(F.col("importances")[i]).alias(f"i{i}") for i in range(self.numFeatures)])
        total = np.array([total[f"i{i}"] for i in range(self.numFeatures)])
        return DenseVector(total / total.sum() if total.sum() > 0 else total)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with rawPrediction, probability and prediction. Blocks of rows meet
        every tree in its group; the votes of a row are added up by its number."""
        spark, width, classes, number = df.sparkSession, self.numFeatures, self.numClasses, self.getNumTrees
        path = shared_path(spark, "forest-rows")  # the write freezes the numbers of the rows
        df.select("*", F.monotonically_increasing_id().alias("_row")).write.parquet(path)
        rows = spark.read.parquet(path)

        def packed(batches):
            for batch in batches:
                for i in range(0, batch.num_rows, BLOCK_ROWS):
                    piece = batch.slice(i, BLOCK_ROWS)
                    yield pa.RecordBatch.from_pydict({"ids": pa.array([piece.column("_row").to_pylist()], pa.list_(pa.int64())),
                                                      "x": pa.array([piece.column("x").flatten().to_numpy(zero_copy_only=False)], pa.list_(pa.float64()))})

        def vote(left: pa.Table, right: pa.Table) -> pa.Table:
            tree = [right[c].combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("feature", "threshold", "left", "shares")]
            out = [_shares(x.values.to_numpy(zero_copy_only=False).reshape(-1, width), *tree, classes) for x in left["x"]]
            ids = left["ids"].combine_chunks().flatten()
            flat = np.concatenate(out).ravel() if out else np.zeros(0)
            return pa.table({"_row": ids, "v": pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1, dtype=np.int32) * classes), pa.array(flat))})

        blocks = (rows.select("_row", vector_to_array("features").alias("x")).mapInArrow(packed, "ids array<long>, x array<double>")
                  .select("*", F.explode(F.sequence(F.lit(0), F.lit(number - 1))).alias("tree")))
        votes = blocks.groupBy("tree").cogroup(self.trees.groupBy("tree")).applyInArrow(vote, "_row long, v array<double>")
        total = votes.groupBy("_row").agg(F.array(*[F.sum(F.col("v")[c]) for c in range(classes)]).alias("_raw"))
        out = rows.join(total, "_row")
        most = F.array_position("_raw", F.array_max("_raw")) - 1
        return out.select(*df.columns, array_to_vector("_raw").alias("rawPrediction"),
                          array_to_vector(F.transform("_raw", lambda v: v / number)).alias("probability"), most.cast("double").alias("prediction"))


def _shares(x: np.ndarray, feature, threshold, left, shares, classes: int) -> np.ndarray:
    at, live = np.zeros(len(x), np.int64), np.arange(len(x))
    while len(live):
        live = live[feature[at[live]] >= 0]
        now = at[live]
        at[live] = left[now] + (x[live, feature[now]] > threshold[now])
    return shares.reshape(-1, classes)[at]
