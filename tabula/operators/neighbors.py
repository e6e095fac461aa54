"""Exact k-nearest neighbours and SMOTE oversampling.

``knn_join`` is a join over a two-level metric index. There is one pivot per
block of rows, up to a bound in bytes, and the square root of the pivots are
super-pivots. Every row goes to the nearest pivot of its nearest super-pivot, and every cell is cut
along its distance from the pivot into blocks of at most ``block_rows`` rows.
Triangle-inequality bounds on the rings of super-cells, cells, bands of blocks
and blocks decide in turn which reference blocks a query block has to visit.
Blocks are packed into one row each, and neighbouring blocks form strips of about
``STRIP_ROWS`` rows. Visited blocks meet their queries by equi-joins (no driver, no
cross join), one bounded pair of strips at a time, so that a block moves once per
strip that visits it; a pair of strips scores only its visits, and the ``k`` best
per query are merged by a window whose limit is applied before the shuffle. The result is exact; where
the bounds cannot exclude a block (high-dimensional noise), it is visited.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.random import draw_int, draw_uniform
from ..plans.scale import global_rank, global_rank_total

DEFAULT_BLOCK_ROWS = 2048
#: Most bytes of pivot vectors: the only rows (with k + 1 distances each) that are broadcast.
PIVOT_BYTES = 32 << 20
#: Consecutive blocks of a cell that are ruled out together.
BAND_BLOCKS = 64
#: Near reference rows that bound the k-th distance of a query (any number gives a valid bound).
BOUND_ROWS = 256
#: Queries scored at a time against one block.
TILE_ROWS = 128
#: Rows of the strips that meet (and at most one block more): 16 MB of 64 numbers each.
STRIP_ROWS = 1 << 15
#: Stand for a NULL key within packed blocks, of a query and of a neighbour (they never match).
NULL_QUERY, NULL_NEIGHBOUR = -2 ** 63, 2 ** 63 - 1


def _matrix(vectors) -> np.ndarray:
    return np.asarray(np.stack(vectors.to_numpy()), dtype=np.float64)


def _distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of ``x`` to the pivots ``p``, one pivot at a time."""
    return np.stack([np.sqrt(((x - c) ** 2).sum(1)) for c in p], axis=1)


def _topk_block(q: np.ndarray, r: np.ndarray, r_ids: np.ndarray, k: int, q_ids: np.ndarray,
                exclude_self: bool):
    """``(query id, reference id, squared distance)`` arrays of the ``k``
    nearest rows of one block per query, by (distance, reference id). The
    dot-product form only preselects: everything within its rounding error of
    the k-th value is measured again, so that ties fall by id."""
    qn, rn = (q * q).sum(1)[:, None], (r * r).sum(1)[None, :]
    approx = qn + rn - 2.0 * (q @ r.T)
    if exclude_self:
        approx[q_ids[:, None] == r_ids[None, :]] = np.inf
    kth = np.partition(approx, k - 1, axis=1)[:, k - 1:k] if k < len(r) else np.inf
    slack = 1e-9 * (qn + rn.max()) + 1e-300
    row, col = np.nonzero(np.isfinite(approx) & (approx <= kth + slack))
    d = ((r[col] - q[row]) ** 2).sum(1)
    order = np.lexsort((r_ids[col], d, row))
    row, col, d = row[order], col[order], d[order]
    keep = np.arange(len(row)) - np.searchsorted(row, row) < k
    return q_ids[row[keep]], r_ids[col[keep]], d[keep]


@dataclass
class _Index:
    """Pivots, the super-pivots (the first of them), and the super-cell of every pivot."""

    pivots: np.ndarray
    supers: int
    home: np.ndarray

    def place(self, x: np.ndarray):
        """Cell, distance from its pivot and distance from its super-pivot of every row."""
        far = _distances(x, self.pivots[:self.supers])
        top = far.argmin(1)
        cell, dist = np.zeros(len(x), np.int32), np.zeros(len(x))
        for s in np.unique(top):
            rows, cells = np.nonzero(top == s)[0], np.nonzero(self.home == s)[0]
            d = _distances(x[rows], self.pivots[cells])
            near = d.argmin(1)
            cell[rows], dist[rows] = cells[near], d[np.arange(len(rows)), near]
        return cell, dist, far[np.arange(len(x)), top]


def _index(reference: DataFrame, block_rows: int) -> _Index | None:
    """Pivots drawn by key: one per ``block_rows`` rows, at most ``PIVOT_BYTES``
    of vectors. (Beyond that the cells hold several blocks, cut by distance.)"""
    size = reference.agg(F.count(F.lit(1)).alias("m"), F.max(F.size("_v")).alias("d")).first()
    if not size["m"]:
        return None
    n = min(-(-size["m"] // block_rows), PIVOT_BYTES // (8 * max(1, size["d"])))
    chosen = reference.orderBy(draw_int("_id", 46), "_id").limit(max(1, n)).collect()
    pivots = np.array([row["_v"] for row in chosen], dtype=np.float64).reshape(len(chosen), -1)
    supers = math.isqrt(len(pivots) - 1) + 1
    return _Index(pivots, supers, _distances(pivots, pivots[:supers]).argmin(1))


def _cell_blocks(rows: DataFrame, index, block_rows: int) -> DataFrame:
    """``_id, _v, _cell, _dist, _top, _blk``: place in the index, and the block
    of the row among the rows of its cell ordered by (distance, id)."""
    def assign(it):
        for p in it:
            if len(p):
                cell, dist, top = index.value.place(_matrix(p["_v"]))
                yield p.assign(_cell=cell, _dist=dist, _top=top)

    placed = rows.mapInPandas(assign, "_id long, _v array<double>, _cell int, _dist double, _top double")
    ranked = global_rank(placed, ["_cell", "_dist", "_id"], rank_col="_r")
    first = ranked.groupBy("_cell").agg(F.min("_r").alias("_first"))  # at most one row per pivot
    return (ranked.join(F.broadcast(first), "_cell")
            .withColumn("_blk", F.floor((F.col("_r") - F.col("_first")) / block_rows))
            .drop("_r", "_first"))


def _overlap(inner: str, outer: str):
    """Whether a ring may hold a row within ``_theta`` of a query."""
    return (F.col("_low") - F.col(outer) <= F.col("_theta")) & (F.col(inner) - F.col("_high") <= F.col("_theta"))


def _packed(blocks: DataFrame) -> DataFrame:
    """One row per block: its strip, ids and vectors. Strips follow the order of
    the blocks, so they hold neighbouring cells."""
    def pack(key, p):
        ids = p["_id"].fillna(0).to_numpy(np.int64)
        ids = np.where(p["_id"].isna(), NULL_QUERY, ids)
        return pd.DataFrame({"_cell": [key[0]], "_blk": [key[1]], "_rows": [len(p)], "_ids": [ids.tobytes()],
                             "_vs": [_matrix(p["_v"]).tobytes()]})

    packed = (blocks.select("_cell", "_blk", "_id", "_v").groupBy("_cell", "_blk")
              .applyInPandas(pack, "_cell int, _blk long, _rows long, _ids binary, _vs binary").checkpoint())
    # rows before each cell, and before the block within it (every block but a cell's last is full)
    cells = packed.groupBy("_cell").agg(F.sum("_rows").alias("_n"), F.max("_rows").alias("_full")).toPandas().sort_values("_cell")
    before = packed.sparkSession.createDataFrame(
        pd.DataFrame({"_cell": cells["_cell"], "_before": cells["_n"].cumsum() - cells["_n"], "_full": cells["_full"]}),
        "_cell int, _before long, _full long")  # at most one row per pivot
    return (packed.join(F.broadcast(before), "_cell")
            .withColumn("_strip", F.floor((F.col("_before") + F.col("_blk") * F.col("_full")) / STRIP_ROWS))
            .select("_cell", "_blk", "_strip", "_ids", "_vs"))


def plan_visits(qb: DataFrame, rb: DataFrame, index, need: int) -> DataFrame:
    """``(_qcell, _qblk, _rcell, _rblk)``: the reference blocks that may hold
    one of the ``need`` nearest rows of a query block.

    The tasks rule out super-cells, then cells, by rings that are broadcast
    (four numbers and ``need`` distances per pivot). What is left meets the
    bands of its cell by a join, and the blocks of its bands by another.
    """
    sc = qb.sparkSession.sparkContext
    closest = Window.partitionBy("_cell").orderBy("_dist", "_id")
    near = (rb.select("_cell", "_dist", "_id").withColumn("_n", F.row_number().over(closest))
            .filter(F.col("_n") <= need).select("_cell", "_dist").collect())
    rings = rb.groupBy("_cell").agg(F.min("_dist"), F.max("_dist"), F.min("_top"), F.max("_top")).collect()
    held = np.array([tuple(r) for r in rings], dtype=np.float64)
    sent = sc.broadcast((np.array([x["_cell"] for x in near]), np.array([x["_dist"] for x in near]), held))

    def reach(key, p):
        at, (near_cell, near_dist, rings) = index.value, sent.value
        x, cells = _matrix(p["_v"]), rings[:, 0].astype(int)
        centre = _distances(at.pivots, at.pivots[[key[0]]])[:, 0]
        radius = p["_dist"].max()
        theta = np.inf
        if len(near_cell) >= need:
            around = centre[near_cell] + near_dist
            best = np.argsort(around)[:max(need, BOUND_ROWS)]
            used, place = np.unique(near_cell[best], return_inverse=True)
            byrow = _distances(x, at.pivots[used])[:, place] + near_dist[best]
            theta = min(around[best[need - 1]] + radius, np.partition(byrow, need - 1, axis=1)[:, need - 1].max())
        far = _distances(x, at.pivots[:at.supers])
        theta += 1e-9 * (theta + far.max()) if np.isfinite(theta) else 0.0  # rounding of the distances
        inner, outer = np.full(at.supers, np.inf), np.full(at.supers, -np.inf)
        np.minimum.at(inner, at.home[cells], rings[:, 3])
        np.maximum.at(outer, at.home[cells], rings[:, 4])
        open_ = (far.min(0) - outer <= theta) & (inner - far.max(0) <= theta)
        span = radius * (1 + 1e-9)
        left = np.nonzero(open_[at.home[cells]] & (centre[cells] - span - rings[:, 2] <= theta)
                          & (rings[:, 1] - centre[cells] - span <= theta))[0]
        out = []
        for i in range(0, len(left), BOUND_ROWS):
            part = left[i:i + BOUND_ROWS]
            d = _distances(x, at.pivots[cells[part]])
            low, high = d.min(0), d.max(0)
            ok = (low - rings[part, 2] <= theta) & (rings[part, 1] - high <= theta)
            out.append(pd.DataFrame({"_rcell": cells[part][ok].astype(np.int32), "_low": low[ok], "_high": high[ok]}))
        found = pd.concat(out) if out else pd.DataFrame({"_rcell": np.zeros(0, np.int32), "_low": 0.0, "_high": 0.0})
        return found.assign(_qcell=np.int32(key[0]), _qblk=key[1], _theta=theta)

    reached = (qb.select("_cell", "_blk", "_v", "_dist").groupBy("_cell", "_blk")
               .applyInPandas(reach, "_rcell int, _low double, _high double, _qcell int, _qblk long, _theta double"))
    band = F.floor(F.col("_rblk") / BAND_BLOCKS).alias("_band")
    blocks = (rb.groupBy(F.col("_cell").alias("_rcell"), F.col("_blk").alias("_rblk"))
              .agg(F.min("_dist").alias("_in"), F.max("_dist").alias("_out"))
              .select("*", band).checkpoint())
    bands = blocks.groupBy("_rcell", "_band").agg(F.min("_in").alias("_bin"), F.max("_out").alias("_bout"))
    return (reached.join(bands, "_rcell").filter(_overlap("_bin", "_bout"))
            .join(blocks, ["_rcell", "_band"]).filter(_overlap("_in", "_out"))
            .select("_qcell", "_qblk", "_rcell", "_rblk").checkpoint())


def knn_join(queries: DataFrame, reference: DataFrame, q_key: str, r_key: str, vec: str,
             k: int = 5, exclude_self: bool = False, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """``knn_join``: ``(q_key, neighbor_rank, neighbor_id, sq_distance)`` for
    the ``k`` nearest reference rows of every query row (Euclidean; ties by
    neighbour id). ``exclude_self`` skips the row with the same key. Keys are
    unique integers; rows without a vector take no part. Of equal reference
    vectors only the ``k`` (with ``exclude_self`` one more) smallest ids can be
    neighbours; the others leave before the index is built.
    """
    spark = queries.sparkSession
    v = F.transform(F.col(vec), lambda x: x.cast("double")).alias("_v")
    q = queries.filter(F.col(vec).isNotNull()).select(F.col(q_key).cast("long").alias("_id"), v)
    r = reference.filter(F.col(vec).isNotNull()).select(F.col(r_key).cast("long").alias("_id"), v)
    need = k + 1 if exclude_self else k
    copies = Window.partitionBy("_v").orderBy("_id")
    r = r.withColumn("_n", F.row_number().over(copies)).filter(F.col("_n") <= need).drop("_n").checkpoint()
    built = _index(r, block_rows)
    if built is None:
        return spark.createDataFrame([], f"{q_key} long, neighbor_id long, sq_distance double, neighbor_rank int")
    index = spark.sparkContext.broadcast(built)
    rb = _cell_blocks(r, index, block_rows)
    alike = queries is reference and q_key == r_key and q.count() == r.count()  # no copy left
    qb = rb if alike else _cell_blocks(q, index, block_rows)
    visits = plan_visits(qb, rb, index, need)
    rp = _packed(rb)
    qp = rp if alike else _packed(qb)
    where = rp.select(F.col("_cell").alias("_rcell"), F.col("_blk").alias("_rblk"), F.col("_strip").alias("_rstrip"))
    from_strip = qp.select(F.col("_cell").alias("_qcell"), F.col("_blk").alias("_qblk"), F.col("_strip").alias("_qstrip"))
    met = visits.join(where, ["_rcell", "_rblk"]).join(from_strip, ["_qcell", "_qblk"])
    block = F.struct(F.col("_rcell").alias("cell"), F.col("_rblk").alias("blk"))
    pair = ["_qstrip", "_rstrip"]
    left = (met.groupBy(*pair, "_qcell", "_qblk").agg(F.collect_set(block).alias("_visits"))
            .join(qp.select(F.col("_cell").alias("_qcell"), F.col("_blk").alias("_qblk"), "_ids", "_vs"), ["_qcell", "_qblk"])
            .select(*pair, "_ids", "_vs", F.col("_visits.cell").alias("_vcells"), F.col("_visits.blk").alias("_vblks")))
    right = (met.select(*pair, "_rcell", "_rblk").distinct()
             .join(rp.select(F.col("_cell").alias("_rcell"), F.col("_blk").alias("_rblk"), "_ids", "_vs"), ["_rcell", "_rblk"])
             .select(*[F.col(c).alias(f"{c}2") for c in [*pair, "_rcell", "_rblk", "_ids", "_vs"]]))

    def unpacked(ids, vectors):
        n = len(ids) // 8
        return np.frombuffer(ids, np.int64), np.frombuffer(vectors, np.float64).reshape(n, -1)

    def score(a, b):
        held = {}
        for c, j, i, v in zip(b["_rcell2"], b["_rblk2"], b["_ids2"], b["_vs2"]):
            ids, vectors = unpacked(i, v)
            held[c, j] = np.where(ids == NULL_QUERY, NULL_NEIGHBOUR, ids), vectors
        out = []
        for ids, vectors, cells, blks in zip(a["_ids"], a["_vs"], a["_vcells"], a["_vblks"]):
            x_ids, x = unpacked(ids, vectors)
            for i in range(0, len(x), TILE_ROWS):
                parts = [_topk_block(x[i:i + TILE_ROWS], held[at][1], held[at][0], k, x_ids[i:i + TILE_ROWS], exclude_self)
                         for at in zip(cells, blks)]
                q_ids, r_ids, d = map(np.concatenate, zip(*parts))
                order = np.lexsort((r_ids, d, q_ids))
                first = np.searchsorted(q_ids[order], q_ids[order])
                best = order[np.arange(len(order)) - first < k]
                out.append((q_ids[best], r_ids[best], d[best]))
        return pd.DataFrame(dict(zip((q_key, "neighbor_id", "sq_distance"), map(np.concatenate, zip(*out)))))

    found = left.groupBy(*pair).cogroup(right.groupBy(*[f"{c}2" for c in pair])).applyInPandas(
        score, f"{q_key} long, neighbor_id long, sq_distance double")
    found = found.select(F.nullif(q_key, F.lit(NULL_QUERY)).alias(q_key), F.nullif("neighbor_id", F.lit(NULL_NEIGHBOUR)).alias("neighbor_id"), "sq_distance")
    w = Window.partitionBy(q_key).orderBy("sq_distance", "neighbor_id")
    return (found.withColumn("neighbor_rank", F.row_number().over(w).cast("int"))
            .filter(F.col("neighbor_rank") <= k))


def oversample_smote(df: DataFrame, label: str, key: str, vec: str, k: int = 5, seed: int = 46,
                     minority=None, categorical=(), integer=()) -> DataFrame:
    """``oversample_smote``: synthetic minority rows ``x + u * (nn - x)`` until
    the minority class has the majority's size.

    Synthetic row j picks its base row (uniform over the minority), one of the
    base row's k nearest minority neighbours, and the gap ``u`` from keyed
    draws on ``j``; the base/neighbour lookups are equi-joins on a dense rank.
    Returns only the new rows, with ``synthetic_id`` and the label.

    ``categorical`` columns (few levels, which are collected) add the squared
    median of the features' standard deviations to a squared distance per
    mismatch; a new row gets the most frequent level among the neighbours of
    its base row (ties: the smallest). The positions ``integer`` of the vector
    are rounded (half to even).
    """
    categorical = list(categorical)
    counts = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}
    if minority is None:
        minority = min(counts, key=lambda c: (counts[c], str(c)))
    n_min = counts[minority]
    if n_min < 2 or k < 1:
        raise ValueError("oversample_smote needs at least two minority rows and k >= 1")
    n_new = max(counts.values()) - n_min
    spark = df.sparkSession
    mino = df.filter(F.col(label) == F.lit(minority)).select(F.col(key).cast("long").alias(key), vec, *categorical)
    ranked, _ = global_rank_total(mino, [key], rank_col="_r")
    ranked = ranked.withColumn("_r", F.col("_r") - 1)
    space = mino.select(key, vec)
    if categorical:
        spread = mino.select(F.posexplode(vec).alias("i", "x")).groupBy("i").agg(F.stddev_pop("x").alias("s"))
        side = float(np.median([r["s"] for r in spread.collect()])) / np.sqrt(2.0)
        hot = [F.when(F.col(c).eqNullSafe(F.lit(level)), side).otherwise(0.0) for c in categorical
               for level in sorted(r[c] for r in mino.select(c).distinct().collect() if r[c] is not None)]
        hot += [F.when(F.col(c).isNull(), side).otherwise(0.0) for c in categorical]
        numbers = F.transform(F.col(vec), lambda x: x.cast("double"))
        space = mino.select(key, F.concat(numbers, F.array(*hot)).alias(vec))
    nn = knn_join(space, space, key, key, vec, k=k, exclude_self=True)
    kk = min(k, n_min - 1)
    syn = spark.range(n_new).withColumnRenamed("id", "synthetic_id")
    syn = syn.select("synthetic_id",
                     F.pmod(draw_int("synthetic_id", seed), F.lit(n_min)).alias("_r"),
                     (F.pmod(draw_int("synthetic_id", seed + 1), F.lit(kk)) + 1).cast("int")
                     .alias("neighbor_rank"),
                     draw_uniform("synthetic_id", seed + 2).alias("_u"))
    base = ranked.select("_r", F.col(key).alias("_base"), F.col(vec).alias("_x"))
    s = syn.join(base, "_r")
    s = s.join(nn.select(F.col(key).alias("_base"), "neighbor_rank", "neighbor_id"),
               ["_base", "neighbor_rank"])
    nvec = mino.select(F.col(key).alias("neighbor_id"), F.col(vec).alias("_n"))
    s = s.join(nvec, "neighbor_id")
    new = F.zip_with("_x", "_n", lambda a, b: a.cast("double") + F.col("_u") * (b.cast("double") - a.cast("double")))
    if integer:
        spots = [int(i) for i in integer]
        new = F.transform(new, lambda x, i: F.when(i.isin(spots), F.bround(x)).otherwise(x))
    for c in categorical:
        level = mino.select(F.col(key).alias("neighbor_id"), F.col(c).alias("_level"))
        votes = (nn.select(F.col(key).alias("_base"), "neighbor_id").join(level, "neighbor_id")
                 .groupBy("_base", "_level").agg((-F.count(F.lit(1))).alias("_votes")))
        s = s.join(votes.groupBy("_base").agg(F.min(F.struct("_votes", "_level"))["_level"].alias(c)), "_base")
    return s.select("synthetic_id", F.col("_base").alias("base_id"), "neighbor_id",
                    new.alias(vec), *categorical, F.lit(minority).alias(label))
