"""Plan-shape helpers shared by the operators.

* ``one_row``: run a fixed-width aggregate and bring back its single row, so
  statistics enter later stages as literals (no cross join, no broadcast).
* ``global_rank``: exact, contiguous 1-based row numbers over a total order
  without funnelling all rows through one task (range partitioning, per
  partition counts, prefix offsets).
* ``quantiles``: exact quantiles from (value, count) aggregates;
  ``column_summaries``: the same for many columns in one shuffle.

Lookups are joined without hints: AQE broadcasts a side whose measured bytes
lie below ``spark.sql.autoBroadcastJoinThreshold`` and splits skewed
partitions of the shuffle join otherwise.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

#: Bytes of estimated input per range slice.
SLICE_BYTES = 128 << 20


def one_row(df: DataFrame, *aggs: Column) -> dict:
    """Evaluate ``aggs`` over ``df`` and return the single result row as a dict."""
    row = df.agg(*aggs).first()
    return row.asDict() if row is not None else {}


def sized(df: DataFrame) -> DataFrame:
    """Persist a lookup and fill it, so that its bytes are known before the
    join on it is planned: a small one is broadcast and the other side is not
    shuffled first. A large one is joined by a shuffle as before."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    df.count()
    return df


#: Rows for which one more task pays.
SPREAD_ROWS = 50_000


def spread(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in up to two partitions per core where its scan yields fewer (a
    file of one row group is one task, whatever its rows), but not below
    ``SPREAD_ROWS`` rows each."""
    wanted = min(2 * df.sparkSession.sparkContext.defaultParallelism, rows // SPREAD_ROWS)
    return df.repartition(wanted) if wanted > df.rdd.getNumPartitions() else df


def _num_partitions(df: DataFrame, n: int | None) -> int:
    """Slices of about ``SLICE_BYTES`` of the scanned tables, at least the
    session's shuffle partitions; no job is run. (The estimate of a whole plan
    multiplies the sides of every join, so only its tables are asked.) A leaf
    without files, such as a checkpointed frame, tells its partitions instead:
    they were cut by size before."""
    if n:
        return n
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    bytes_, parts = 0, 0
    for leaf in (leaves.apply(i) for i in range(leaves.size())):
        kind = leaf.getClass().getSimpleName()
        if kind == "LogicalRDD":
            parts += leaf.rdd().getNumPartitions()
        elif kind in ("LogicalRelation", "DataSourceV2ScanRelation"):
            bytes_ += int(leaf.stats().sizeInBytes())
    return max(least, parts, -(-bytes_ // SLICE_BYTES))


def range_slices(df: DataFrame, order: list, num_partitions: int | None = None) -> DataFrame:
    """Range-partition ``df`` on ``order`` and tag each row with its slice.

    ``_pid`` is the slice number (slices follow the order) and ``_loc`` the
    row's position inside its slice. The result is checkpointed to the shared
    checkpoint folder, so later passes see the same slices even if executors
    are lost in between.
    """
    n = _num_partitions(df, num_partitions)
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = (df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_loc", F.monotonically_increasing_id()
                          - F.shiftleft(F.col("_pid").cast("long"), 33)))
    return ranged.checkpoint(eager=True)


def global_rank(df: DataFrame, order: list, rank_col: str = "_grn",
                num_partitions: int | None = None, keep_parts: bool = False) -> DataFrame:
    return global_rank_total(df, order, rank_col, num_partitions, keep_parts)[0]


def global_rank_total(df: DataFrame, order: list, rank_col: str = "_grn",
                      num_partitions: int | None = None, keep_parts: bool = False):
    """Add ``rank_col`` = position (1-based) of each row in ``order``.

    ``order`` must be a total order (end it with a unique key). Rows are
    range-partitioned and sorted within partitions, so every task holds one
    contiguous slice of the order; a per-partition count (one small job) gives
    each slice its starting offset. Returns ``(frame, total_rows)``.
    ``keep_parts`` keeps slice, place in it and rows of it (``_pid``, ``_loc``,
    ``_count``); the frame's partitions are the slices, each in order.
    """
    spark = df.sparkSession
    ranged = range_slices(df, order, num_partitions)
    counts = sorted((r["_pid"], r["count"]) for r in ranged.groupBy("_pid").count().collect())
    offsets, acc = [], 0
    for pid, cnt in counts:
        offsets.append((pid, acc, cnt))
        acc += cnt
    if not offsets:
        out = ranged.withColumn("_count", F.lit(0).cast("long")).withColumn(rank_col, F.lit(None).cast("long"))
    else:
        # One row per partition: a bound known before the join.
        off = spark.createDataFrame(offsets, "_pid INT, _off LONG, _count LONG")
        out = (ranged.join(F.broadcast(off), "_pid")
               .withColumn(rank_col, F.col("_off") + F.col("_loc") + 1)
               .drop("_off"))
    if not keep_parts:
        out = out.drop("_pid", "_loc", "_count")
    return out, acc


def _wanted(ps, n: int) -> dict:
    """For every share: its place among n rows, and the places around it."""
    return {float(p): ((n - 1) * float(p), int(math.floor((n - 1) * float(p))), int(math.ceil((n - 1) * float(p))))
            for p in ps}


def _between(place, low, high):
    """Linear interpolation, with the arithmetic of the percentile aggregate."""
    h, lo, hi = place
    return low if hi == lo else (hi - h) * low + (h - lo) * high


def column_summaries(df: DataFrame, numeric: dict, other: dict, ps) -> tuple[dict, dict]:
    """Exact quantiles of many columns and distinct counts of all, in one pass.

    ``numeric`` and ``other`` name column expressions. All columns are laid out
    as (column, value) rows and summed to counts per task before the one
    shuffle, which range-partitions the distinct values by column and value. One
    number per slice and column tells which slices hold the wanted ranks;
    running counts are formed only there. NULLs and NaN are left out. Numbers
    are ordered as doubles; whole numbers beyond 2^53 also by their text, so
    that they stay distinct.
    """
    names = [*numeric, *other]
    cells = []
    for i, c in enumerate(names):
        if c in numeric:
            v = numeric[c].cast("double") + F.lit(0.0)
            value = F.when(~F.isnan(v), v)
            text = F.when(F.abs(v) >= 2.0 ** 53, numeric[c].cast("string"))
        else:
            value, text = F.lit(None).cast("double"), other[c].cast("string")
        cells.append(F.struct(F.lit(i).alias("c"), value.alias("v"), text.alias("t")))
    long = df.select(F.inline(F.array(*cells))).filter("v IS NOT NULL OR t IS NOT NULL")
    ranged = range_slices(long.groupBy("c", "v", "t").agg(F.count(F.lit(1)).alias("k")), ["c", "v", "t"])
    parts = sorted((r["c"], r["_pid"], r["rows"], r["n"]) for r in ranged.groupBy("c", "_pid").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("k").alias("n")).collect())
    distinct, total = dict.fromkeys(names, 0), dict.fromkeys(names, 0)
    for c, _, rows, n in parts:
        distinct[names[c]] += rows
        total[names[c]] += n
    places = {c: _wanted(ps, total[c]) for c in numeric if total[c]}
    need = {c: sorted({i + 1 for _, lo, hi in p.values() for i in (lo, hi)}) for c, p in places.items()}
    before, seen = {}, dict.fromkeys(names, 0)
    for c, pid, _, n in parts:
        c = names[c]
        if any(seen[c] < r <= seen[c] + n for r in need.get(c, ())):
            before[(names.index(c), pid)] = seen[c]
        seen[c] += n
    got = {}
    if before:
        # one row per slice and column that is asked for
        asked = df.sparkSession.createDataFrame(
            [(c, pid, n, need[names[c]]) for (c, pid), n in before.items()], "c int, _pid int, _before long, _need array<long>")
        w = Window.partitionBy("_pid", "c").orderBy("v", "t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        hits = (ranged.join(F.broadcast(asked), ["c", "_pid"]).withColumn("_hi", F.sum("k").over(w) + F.col("_before"))
                .select("c", "v", F.filter("_need", lambda r: (r <= F.col("_hi")) & (r > F.col("_hi") - F.col("k"))).alias("at"))
                .filter(F.size("at") > 0).collect())
        got = {(names[r["c"]], rank): r["v"] for r in hits for rank in r["at"]}
    found = {c: [_between(p, got[c, p[1] + 1], got[c, p[2] + 1]) for p in places[c].values()] if c in places
             else [None] * len(ps) for c in numeric}
    return found, distinct


def quantiles(df: DataFrame, column: str, ps) -> list:
    """Exact linear-interpolated quantiles (numpy's default) of ``column``.

    Rows are first summed to (value, count), so a value on a third of the rows
    is one row per task before any shuffle. The distinct values are
    range-partitioned, per-slice counts (one row per slice) tell which slices
    hold the wanted ranks, and only there are running counts formed. One path
    for every input size.
    """
    v = F.col(column).cast("double")
    vals = df.select((v + F.lit(0.0)).alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    return _exact_quantiles(vals, ps)


#: Rows from which a bracket pays, and its half width as a share of the rows
#: (the sketch is right to a ten-thousandth).
BRACKET_ROWS, BRACKET_SHARE = 200_000, 3e-4


def bracketed_quantile(df: DataFrame, column: str, p: float, rows: int | None = None) -> float | None:
    """The same exact quantile for a stored frame: a sketch gives two values
    around it, one scan counts the rows below and between, and only those
    between are ranked. Where the wanted ranks do not lie between (checked by
    the counts) or the frame is small (``rows``, if known, saves the scan that
    tells), all rows are ranked."""
    if rows is not None and rows < BRACKET_ROWS:
        return quantiles(df, column, [p])[0]
    v, p = F.col(column).cast("double"), float(p)
    vals = df.select((v + F.lit(0.0)).alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    shares = F.array(F.lit(max(0.0, p - BRACKET_SHARE)), F.lit(min(1.0, p + BRACKET_SHARE)))
    r = one_row(vals, F.count(F.lit(1)).alias("n"), F.percentile_approx("_v", shares, F.lit(10000)).alias("q"))
    if r["n"] >= BRACKET_ROWS:
        low, high = r["q"]
        inside = (F.col("_v") >= low) & (F.col("_v") <= high)
        got = one_row(vals, F.count_if(F.col("_v") < low).alias("below"), F.count_if(inside).alias("inside"))
        _, first, last = _wanted([p], r["n"])[p]
        if got["below"] <= first and last < got["below"] + got["inside"]:
            return _exact_quantiles(vals.filter(inside), [p], got["below"], r["n"])[0]
    return _exact_quantiles(vals, [p])[0]


def _exact_quantiles(vals: DataFrame, ps, below: int = 0, rows: int | None = None) -> list:
    """Quantiles of ``_v`` when ``below`` of all ``rows`` values lie before ``vals``."""
    ranged = range_slices(vals.groupBy("_v").agg(F.count(F.lit(1)).alias("_c")), ["_v"])
    sums = sorted((r["_pid"], r["n"]) for r in ranged.groupBy("_pid").agg(F.sum("_c").alias("n")).collect())
    n = sum(c for _, c in sums)
    ps = [float(p) for p in ps]
    if n == 0:
        return [None] * len(ps)
    pos = _wanted(ps, rows or n)
    need = sorted({i + 1 for _, lo, hi in pos.values() for i in (lo, hi)})
    before, acc = {}, below
    for pid, c in sums:
        if any(acc < r <= acc + c for r in need):
            before[pid] = acc
        acc += c
    w = Window.partitionBy("_pid").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.create_map(*[F.lit(x) for kv in before.items() for x in kv])[F.col("_pid")]
    upto = F.sum("_c").over(w) + start
    hits = (ranged.filter(F.col("_pid").isin(list(before))).withColumn("_hi", upto)
            .withColumn("_at", F.filter(F.array(*[F.lit(r) for r in need]),
                                        lambda r: (r <= F.col("_hi")) & (r > F.col("_hi") - F.col("_c"))))
            .filter(F.size("_at") > 0).select("_v", "_at").collect())
    got = {r: row["_v"] for row in hits for r in row["_at"]}
    return [_between(pos[p], got[pos[p][1] + 1], got[pos[p][2] + 1]) for p in ps]
