"""Ordered (window-style) operators that stay distributed under skew.

A ``Window.partitionBy(entity)`` puts every row of one entity into one task;
if one user holds a third of the table, so does that task. The operators
below instead cut the *total* order ``(entity, order..., key)`` into range
slices of even size (``plans.scale.range_slices``): each slice is processed
in its own task and the little state that crosses a slice boundary (the last
value seen, a running count) is carried over through a per-slice summary
with one row per slice.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions.scalar import missing
from ..plans.scale import global_rank, global_rank_total, range_slices, sized


def _as_list(x) -> list:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def _codes(table: pa.Table, names: list) -> np.ndarray:
    """Number of the run of equal entities (NULLs equal) each row is in."""
    change = np.zeros(table.num_rows, dtype=bool)
    for name in names:
        codes = table[name].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
        change[1:] |= codes[1:] != codes[:-1]
    return np.cumsum(change)


def _slice_tables(batches, back: int, names: list):
    """``(batch, table, start)``: every batch of one slice, and a table of the
    columns ``names`` that holds up to ``back`` rows before it as well; the
    batch begins at row ``start``. Refuses rows that are not one slice in order."""
    tail, at = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        loc = batch.column(batch.schema.get_field_index("_loc")).to_numpy()
        pid = batch.column(batch.schema.get_field_index("_pid")).to_numpy()
        at = at or (pid[0], loc[0])
        if (pid != at[0]).any() or (loc != at[1] + np.arange(len(loc))).any():
            raise RuntimeError("a task must hold one slice in its order")
        at = (at[0], at[1] + len(loc))
        cur = pa.Table.from_batches([batch]).select(names)
        table = pa.concat_tables([tail, cur]) if tail is not None else cur
        yield batch, table, table.num_rows - batch.num_rows
        tail = table.slice(max(0, table.num_rows - back)) if back else None


def _with_columns(batch: pa.RecordBatch, added: dict, keep: np.ndarray) -> pa.RecordBatch:
    out = pa.RecordBatch.from_arrays([*batch.columns, *added.values()], names=[*batch.schema.names, *added])
    return out.filter(pa.array(keep))


def _ddl(df: DataFrame, **added) -> StructType:
    return StructType([*df.schema.fields, *[StructField(n, t) for n, t in added.items()]])


def _by_slice(df: DataFrame, ent: list, order: list, back: int, inside, border) -> DataFrame:
    """Run an operator that looks ``back`` rows behind over the total order.

    Rows with ``back`` rows of their own slice before them (``inside``, Arrow
    batches within the task) need no second shuffle; the first ``back`` rows of
    every slice (``border``, an equi-join on row numbers) see only the rows
    beside the slice edges.
    """
    r, _ = global_rank_total(df, ent + order, keep_parts=True)
    edges = r.filter((F.col("_loc") < back) | (F.col("_count") - F.col("_loc") <= back))
    out = inside(r).unionByName(border(edges).filter(F.col("_loc") < back))
    return out.drop("_grn", "_pid", "_loc", "_count")


def lag_variable(df: DataFrame, column, order_by, entity=None, offset: int = 12, *,
                 key, out_col=None) -> DataFrame:
    """``lag_variable``: the value ``offset`` rows earlier within ``entity``.

    Exact over the total order ``entity, order_by, key``. ``column`` may be a
    list: all its lags share one ranking.
    """
    ent, order, key, columns = _as_list(entity), _as_list(order_by), _as_list(key), _as_list(column)
    outs = _as_list(out_col) or [f"previous_{c}" for c in columns]

    def inside(r):
        def shift(batches):
            for batch, table, start in _slice_tables(batches, offset, [*dict.fromkeys([*ent, *columns])]):
                here = start + np.arange(batch.num_rows)
                there = np.maximum(here - offset, 0)
                run = _codes(table, ent)
                index = pa.array(there, mask=run[here] != run[there])
                added = {o: table[c].combine_chunks().take(index) for c, o in zip(columns, outs)}
                loc = batch.column(batch.schema.get_field_index("_loc")).to_numpy()
                yield _with_columns(batch, added, loc >= offset)
        return r.mapInArrow(shift, _ddl(r, **{o: df.schema[c].dataType for c, o in zip(columns, outs)}))

    def border(r):
        prev = r.select((F.col("_grn") + offset).alias("_grn"),
                        *[F.col(c).alias(f"_lag_v{i}") for i, c in enumerate(columns)],
                        *[F.col(e).alias(f"_lag_e{i}") for i, e in enumerate(ent)])
        j = r.join(prev, "_grn", "left")
        same = F.lit(True)
        for i, e in enumerate(ent):
            same = same & (F.col(e).eqNullSafe(F.col(f"_lag_e{i}")))
        return j.select(*r.columns, *[F.when(same, F.col(f"_lag_v{i}")).alias(o) for i, o in enumerate(outs)])

    return _by_slice(df, ent, order + key, offset, inside, border)


def _fill(df: DataFrame, column: str, order_by, entity, key, backward: bool,
          out_col: str | None) -> DataFrame:
    """Backward filling is forward filling over the reversed total order."""
    ent, order, key = _as_list(entity), _as_list(order_by), _as_list(key)
    out_col = out_col or column
    spark = df.sparkSession
    total = [F.desc(c) if backward else F.asc(c) for c in ent + order + key]
    s = range_slices(df.withColumn("_present", ~missing(df, column)), total)
    val_type = s.schema[column].dataType

    def fill(batches):
        state = None
        for batch, table, _ in _slice_tables(batches, 0, [*dict.fromkeys([*ent, column])]):
            value = table[column].combine_chunks()
            here = np.asarray(batch.column(batch.schema.get_field_index("_present")).to_numpy(zero_copy_only=False))
            rows = table.select(ent).append_column("_value", value)
            if state is not None:  # the row before, with its filled value
                rows = pa.concat_tables([state, rows])
                here = np.concatenate([[state["_value"][0].is_valid], here])
            run = _codes(rows, ent)
            source = np.maximum.accumulate(np.where(here, np.arange(len(here)), -1))
            none = (source < 0) | (run[np.maximum(source, 0)] != run)
            filled = rows["_value"].combine_chunks().take(pa.array(np.maximum(source, 0), mask=none))
            state = rows.select(ent).append_column("_value", filled).slice(len(here) - 1)
            yield _with_columns(batch, {"_filled": filled.slice(len(here) - batch.num_rows)},
                                np.ones(batch.num_rows, dtype=bool))

    # One row per slice: the value that crosses its boundary.
    tagged = F.struct(F.col(column).alias("v"), F.struct(*[F.col(e) for e in ent]).alias("e"))
    edge = F.max_by(tagged, F.when(F.col("_present"), F.col("_loc")))
    edges = sorted((r["_pid"], r["edge"]) for r in
                   s.groupBy("_pid").agg(F.when(F.bool_or("_present"), edge).alias("edge")).collect())
    carry, last = [], None
    for pid, e in edges:
        carry.append((pid, last))
        if e is not None:
            last = e
    ent_type = ",".join(f"`{e}`:{s.schema[e].dataType.simpleString()}" for e in ent)
    carry_schema = f"_pid INT, _carry STRUCT<v:{val_type.simpleString()}, e:STRUCT<{ent_type}>>"
    rows = [(pid, None if c is None else (c["v"], tuple(c["e"]))) for pid, c in carry]
    carry_df = spark.createDataFrame(rows, carry_schema)
    cur = F.struct(*[F.col(e) for e in ent])
    local = s.mapInArrow(fill, _ddl(s, _filled=val_type))
    return (local.join(F.broadcast(carry_df), "_pid", "left")
            .withColumn(out_col, F.coalesce("_filled", F.when(F.col("_carry.e") == cur, F.col("_carry.v"))))
            .drop("_filled", "_carry", "_pid", "_loc", "_present"))


def forward_fill(df: DataFrame, column: str, order_by, entity=None, *, key,
                 out_col: str | None = None) -> DataFrame:
    """``forward_fill``: carry the last present value forward within ``entity``."""
    return _fill(df, column, order_by, entity, key, backward=False, out_col=out_col)


def backward_fill(df: DataFrame, column: str, order_by, entity=None, *, key,
                  out_col: str | None = None) -> DataFrame:
    """``backward_fill``: carry the next present value backward within ``entity``."""
    return _fill(df, column, order_by, entity, key, backward=True, out_col=out_col)


def rolling_mean(df: DataFrame, column: str, order_by, window: int = 5, entity=None, *, key,
                 min_periods: int | None = None, out_col: str | None = None) -> DataFrame:
    """``rolling_mean``: mean (double) of the current and ``window - 1`` preceding rows.

    Like pandas ``rolling(window)``, the mean is NULL until ``min_periods``
    (default: ``window``) present values are in the frame.
    """
    ent, order, key = _as_list(entity), _as_list(order_by), _as_list(key)
    out_col = out_col or f"{column}_rolling_mean"
    minp = max(window if min_periods is None else min_periods, 1)
    back = window - 1
    val = F.col(column).cast("double")
    df = df.withColumn("_v", F.when(~F.isnan(val), val))

    def inside(r):
        def roll(batches):
            for batch, table, start in _slice_tables(batches, back, [*ent, "_v"]):
                v = table["_v"].combine_chunks().to_numpy(zero_copy_only=False)
                run = _codes(table, ent)
                here = start + np.arange(batch.num_rows)
                total, n = np.zeros(len(here)), np.zeros(len(here), dtype=np.int64)
                for step in range(back, -1, -1):
                    there = np.maximum(here - step, 0)
                    ok = (run[there] == run[here]) & ~np.isnan(v[there])
                    total += np.where(ok, v[there], 0.0)
                    n += ok
                mean = pa.array(total / np.maximum(n, 1), mask=n < minp)
                loc = batch.column(batch.schema.get_field_index("_loc")).to_numpy()
                yield _with_columns(batch, {out_col: mean}, loc >= back)
        return r.mapInArrow(roll, _ddl(r, **{out_col: DoubleType()}))

    def border(r):
        goal = F.explode(F.sequence(F.col("_grn"), F.col("_grn") + back)).alias("_grn")
        copies = r.select(goal, "_v", *[F.col(e).alias(f"_e{i}") for i, e in enumerate(ent)])
        agg = copies.groupBy("_grn", *[f"_e{i}" for i in range(len(ent))]).agg(
            F.sum("_v").alias("_s"), F.count("_v").alias("_n"))
        cond = [r["_grn"] == agg["_grn"]] + [r[e].eqNullSafe(agg[f"_e{i}"]) for i, e in enumerate(ent)]
        j = r.join(agg, cond, "left").drop(agg["_grn"])
        return j.select(*r.columns, F.when(F.col("_n") >= minp, F.col("_s") / F.col("_n")).alias(out_col))

    return _by_slice(df, ent, order + key, back, inside, border).drop("_v")


def window_number(df: DataFrame, order_by, num_windows: int, *, key,
                  out_col: str = "window_num"):
    """``window_number``: equal consecutive windows over the order.

    ``size = round(n / num_windows)``; window = ``floor((rank - 1) / size) + 1``.
    Rows past ``num_windows * size`` get a number above ``num_windows`` (the
    remainder), as in the reference, and callers skip them. Returns
    ``(frame, n, size)``.
    """
    order, key = _as_list(order_by), _as_list(key)
    r, n = global_rank_total(df, order + key, rank_col="_grn")
    size = max(round(n / num_windows), 1)
    out = (r.withColumn(out_col, (F.floor((F.col("_grn") - 1) / F.lit(size)) + 1).cast("int"))
           .withColumn("row_in_window",
                       F.col("_grn") - (F.col(out_col).cast("long") - 1) * F.lit(size).cast("long"))
           .drop("_grn"))
    return out, n, size


def head_per_window(df: DataFrame, order_by, num_windows: int, test_size: float = 0.2, *,
                    key) -> DataFrame:
    """``head_per_window`` / ``split_sliding_window``: per window, the first
    ``round(n * (1 - test_size) / num_windows)`` rows (in order) are train and
    the rest of the window is test. Remainder rows are dropped, as in the
    reference."""
    w, n, size = window_number(df, order_by, num_windows, key=key)
    n_train = round(n * (1 - test_size) / num_windows)
    return (w.filter(F.col("window_num") <= num_windows)
            .withColumn("split", F.when(F.col("row_in_window") <= n_train, F.lit("train"))
                        .otherwise(F.lit("test"))))


def sort_order_rank(df: DataFrame, order: list, out_col: str = "order_rank") -> DataFrame:
    """``sort_order_rank``: 0-based dense row position in the given total order."""
    r = global_rank(df, order, rank_col="_grn")
    return r.withColumn(out_col, F.col("_grn") - 1).drop("_grn")


def share_of_group(df: DataFrame, value: str, group, out_col: str | None = None) -> DataFrame:
    """``share_of_group``: value / group total.

    The totals are a partial (map-side combined) aggregate of known size when
    the join is planned, so few groups are broadcast and the rows of a hot
    group stay where they are read.
    """
    grp = _as_list(group)
    out_col = out_col or f"{value}_share"
    totals = sized(df.groupBy(*grp).agg(F.sum(value).alias("_total")))
    return (df.join(totals, grp, "left")
            .withColumn(out_col, F.try_divide(F.col(value), F.col("_total")))
            .drop("_total"))


def assign_codes(df: DataFrame, column: str, out_col: str | None = None) -> DataFrame:
    """``assign_codes``: 0-based position of the value among the sorted
    distinct values; -1 when missing (pandas ``cat.codes``)."""
    out_col = out_col or f"{column}_code"
    levels = df.select(column).filter(~missing(df, column)).distinct()
    ranked = global_rank(levels, [column], rank_col="_code")
    codes = ranked.select(column, (F.col("_code") - 1).alias(out_col))
    return (df.join(codes, column, "left")
            .withColumn(out_col, F.coalesce(F.col(out_col), F.lit(-1)).cast("int")))


def minibatch_number(df: DataFrame, key: str, batch_size: int = 128, shuffle: bool = False,
                     seed: int = 46, out_col: str = "batch") -> DataFrame:
    """``minibatch_number``: optional keyed shuffle, then complete batches only."""
    from ..functions.random import draw_int
    order = [draw_int(key, seed), F.col(key)] if shuffle else [F.col(key)]
    r, n = global_rank_total(df, order, rank_col="_grn")
    full = n // batch_size
    return (r.withColumn(out_col, F.floor((F.col("_grn") - 1) / F.lit(batch_size)).cast("long"))
            .filter(F.col(out_col) < F.lit(full))
            .withColumn("pos_in_batch", ((F.col("_grn") - 1) % F.lit(batch_size)).cast("int"))
            .drop("_grn"))


def split_ordered_tail(df: DataFrame, order_by, fraction: float = 0.1, *, key,
                       out_col: str = "is_validation") -> DataFrame:
    """``split_ordered_tail``: last ``fraction`` of rows (by order) flagged,
    as a framework's unshuffled validation split takes them."""
    order, key = _as_list(order_by), _as_list(key)
    r, n = global_rank_total(df, order + key, rank_col="_grn")
    n_train = int(n * (1.0 - fraction))
    return r.withColumn(out_col, F.col("_grn") > F.lit(n_train)).drop("_grn")


def rows_by_position(df: DataFrame, order: list, start: int, stop: int) -> DataFrame:
    """``rows_by_position``: ``iloc[start:stop]`` over an explicit total order."""
    r = global_rank(df, order, rank_col="_grn")
    return r.filter((F.col("_grn") > start) & (F.col("_grn") <= stop)).drop("_grn")

