"""Sampling and splitting with replayable, keyed draws.

Every random choice is a pure function of a row key and a seed
(``functions.random``), so splits and samples are identical across cluster
sizes, retries and re-plans, and exact sizes come from distributed ranks
rather than from fractions.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.random import draw_int
from ..plans.scale import global_rank, global_rank_total


#: Draws are counted by so many of their leading bits before any is ranked.
DRAW_BITS = 16


def _order_cuts(df: DataFrame, order: list, positions, drawn: bool = True):
    """Conditions "after the row at this position", one per position of the
    order. Only the order columns are ranked, and only the rows at the cuts
    (a fixed number) reach the driver; whole rows are neither sorted nor moved.
    Where the order begins with a draw (``drawn``), counts by its leading bits
    tell which few draws lie at a cut, and only these are ranked.
    ``positions`` gets the row count. Returns ``(conditions, row count)``.
    """
    names = [f"_o{i}" for i in range(len(order))]
    narrow = df.select(*[c.alias(n) for c, n in zip(order, names)])
    if drawn:
        lead = lambda draw: F.coalesce(F.shiftright(draw, 31 - DRAW_BITS), F.lit(-1))  # noqa: E731 (NULL comes first)
        counts = sorted((r["lead"], r["count"]) for r in narrow.groupBy(lead("_o0").alias("lead")).count().collect())
        n, skipped, before, at = sum(c for _, c in counts), [], 0, []
        places = positions(n)
        for value, count in counts:
            if any(before < place <= before + count for place in places):
                at.append(value)
            else:
                skipped.append((before, count))
            before += count
        # places among the draws that are ranked
        moved = {place: place - sum(c for b, c in skipped if b < place) for place in places}
        # a filter on the draw would evaluate it many times a row (see ``models.holdout``)
        few = narrow.select(F.inline(F.filter(F.array(F.struct(*names)), lambda r: lead(r["_o0"]).isin(at)))).persist()
        ranked, _ = global_rank_total(few, names, rank_col="_r")
        places = [moved[place] if 0 < place <= n else (place if place < 1 else n + 1) for place in places]
    else:
        ranked, n = global_rank_total(narrow, names, rank_col="_r")
        places = positions(n)
    hits = {r["_r"]: r for r in ranked.filter(F.col("_r").isin(sorted(set(places)))).collect()}
    if drawn:
        few.unpersist()
    types = {f.name: f.dataType for f in narrow.schema}
    row = F.struct(*[c.alias(x) for c, x in zip(order, names)])
    after = []
    for place in places:
        hit = hits.get(place)
        after.append(F.lit(place < 1) if hit is None else
                     row > F.struct(*[F.lit(hit[x]).cast(types[x]).alias(x) for x in names]))
    return after, n


def split_holdout(df: DataFrame, key: str, test_size: float = 0.3, seed: int = 46,
                  out_col: str = "split") -> DataFrame:
    """``split_holdout``: shuffle by keyed draw; the first ``ceil(test_size * n)``
    rows are test, the rest train (exact sizes for a unique key, as a shuffled
    holdout split)."""
    (train,), _ = _order_cuts(df, [draw_int(key, seed), F.col(key)], lambda n: [math.ceil(test_size * n)])
    return df.withColumn(out_col, F.when(train, F.lit("train")).otherwise(F.lit("test")))


def split_kfold(df: DataFrame, key: str, k: int = 10, seed: int = 46, shuffle: bool = True,
                out_col: str = "fold") -> DataFrame:
    """``split_kfold``: contiguous folds over the (shuffled) order of a unique
    key; the first ``n % k`` folds get one extra row, as k-fold splitting does."""
    order = [draw_int(key, seed), F.col(key)] if shuffle else [F.col(key)]
    after, _ = _order_cuts(df, order, lambda n: [(i + 1) * (n // k) + min(i + 1, n % k) for i in range(k - 1)], shuffle)
    fold = F.lit(0)
    for condition in after:
        fold = fold + condition.cast("int")
    return df.withColumn(out_col, fold)


def oversample_binary(df: DataFrame, label: str, key: str, seed: int = 46) -> DataFrame:
    """``oversample_binary``: replicate the smaller class until both classes
    have the larger class's size; the larger class is kept as is.

    Each minority row gets ``M // m`` copies, and the first ``M % m`` rows in
    keyed-draw order one more, so class sizes match exactly. Adds ``copy``.
    """
    counts = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}
    if len(counts) != 2:
        raise ValueError("oversample_binary needs exactly two classes")
    (small, m), (large, big) = sorted(counts.items(), key=lambda kv: (kv[1], str(kv[0])))
    base, rem = divmod(big, m)
    minority = global_rank(df.filter(F.col(label) == F.lit(small)),
                           [draw_int(key, seed), F.col(key)], rank_col="_r")
    copies = F.lit(base) + (F.col("_r") <= rem).cast("int")
    rep = (minority.withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
           .drop("_r"))
    keep = df.filter(F.col(label) == F.lit(large)).withColumn("copy", F.lit(1))
    return keep.unionByName(rep)


def sample_balanced_classes(df: DataFrame, label: str, key: str, dataset_size: int,
                            seed: int = 46) -> DataFrame:
    """``sample_balanced_classes``: ``dataset_size // classes`` rows drawn
    from every class (keyed draw order); a class with too few rows raises.

    The per-class rank comes from one global rank over (label, draw, key)
    minus each class's first rank (one row per class), so a class holding a
    third of all rows is still split across tasks.
    """
    r = global_rank(df, [F.col(label), draw_int(key, seed), F.col(key)], rank_col="_r")
    firsts = r.groupBy(label).agg(F.min("_r").alias("_first"), F.count(F.lit(1)).alias("_n"))
    fr = firsts.collect()
    per = dataset_size // max(len(fr), 1)
    short = [row[label] for row in fr if row["_n"] < per]
    if short:
        raise ValueError(f"classes with fewer than {per} rows: {short}")
    return (r.join(firsts.drop("_n"), label)
            .filter(F.col("_r") - F.col("_first") < per)
            .drop("_r", "_first"))
