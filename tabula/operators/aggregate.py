"""Aggregations. All of them are partial/final (map-side combined) aggregates,
so a hot group key costs a shuffle of one partial row per task, not its rows."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import missing, nan_to_null, safe_corr
from ..plans.scale import one_row, quantiles


def _as_list(x):
    return [x] if isinstance(x, str) else list(x)


def count_rows(df: DataFrame) -> DataFrame:
    """``count_rows``: one-row frame with the row count."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def value_counts(df: DataFrame, column: str, out_col: str = "count") -> DataFrame:
    """``value_counts``: count per value (missing values excluded, as pandas)."""
    return df.filter(~missing(df, column)).groupBy(column).agg(F.count(F.lit(1)).alias(out_col))


def rarest_value(df: DataFrame, column: str):
    """``value_counts().idxmin()``: the least frequent value (ties: smallest value)."""
    vc = value_counts(df, column)
    return vc.agg(F.min_by(F.col(column), F.struct(F.col("count"), F.col(column))).alias("v")).first()["v"]


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """``distinct_values``: the distinct non-missing values."""
    return df.select(column).filter(~missing(df, column)).distinct()


def group_mean_count(df: DataFrame, key, y: str) -> DataFrame:
    """``group_mean_count``: mean and non-missing count of ``y`` per group."""
    v = nan_to_null(df, y)
    return df.groupBy(*_as_list(key)).agg(F.avg(v).alias("mean"), F.count(v).alias("count"))


def group_size_share(df: DataFrame, first: str, second: str, percent: bool = False) -> DataFrame:
    """``group_size_share``: rows per (first, second) and their share within
    ``first`` (x100 when ``percent``).

    The share's window runs over the aggregated table (one row per group
    pair), never over raw rows.
    """
    counts = df.groupBy(first, second).agg(F.count(F.lit(1)).alias("size"))
    total = F.sum("size").over(Window.partitionBy(first))
    share = (F.col("size") * 100.0 / total) if percent else (F.col("size") / total)
    return counts.withColumn("percent" if percent else "share", share)


def column_means(df: DataFrame, columns=None) -> DataFrame:
    """``column_means``: mean of each column skipping NULL and NaN (one pass)."""
    columns = columns or df.columns
    return df.agg(*[F.avg(nan_to_null(df, c)).alias(c) for c in columns])


def column_std_pop(df: DataFrame, columns=None) -> DataFrame:
    """``column_std_pop``: population standard deviation per column."""
    columns = columns or df.columns
    return df.agg(*[F.stddev_pop(nan_to_null(df, c)).alias(c) for c in columns])


def percentiles(df: DataFrame, column: str, ps=(0.25, 0.75), exact: bool = True,
                accuracy: int = 10000) -> list:
    """``percentiles_exact``: linear-interpolated percentiles (numpy's default).

    ``exact=False`` switches to the streaming quantile sketch
    (``percentile_approx``), whose memory does not grow with the data.
    """
    if exact:
        return quantiles(df, column, ps)
    v = nan_to_null(df, column)
    agg = F.percentile_approx(v, F.array(*[F.lit(float(p)) for p in ps]), accuracy)
    return list(one_row(df, agg.alias("p"))["p"] or [])


def percentiles_frame(df: DataFrame, column: str, ps=(0.25, 0.5, 0.75)) -> DataFrame:
    """One row per requested percentile: ``(p, value)``."""
    vals = quantiles(df, column, ps)
    return df.sparkSession.createDataFrame([(float(p), v) for p, v in zip(ps, vals)],
                                           "p DOUBLE, value DOUBLE")


def min_max_global(df: DataFrame, columns) -> DataFrame:
    """``min_max_global``: overall min and max across several columns."""
    return df.agg(F.least(*[F.min(nan_to_null(df, c)) for c in columns]).alias("global_min"),
                  F.greatest(*[F.max(nan_to_null(df, c)) for c in columns]).alias("global_max"))


def correlation_pairs(df: DataFrame, columns) -> DataFrame:
    """``correlation_matrix``: Pearson r for every column pair, long form
    ``(col_a, col_b, r)``; one aggregate pass for all pairs."""
    pairs = list(itertools.combinations(columns, 2))
    if not pairs:
        return df.sparkSession.createDataFrame([], "col_a STRING, col_b STRING, r DOUBLE")
    wide = df.agg(*[safe_corr(nan_to_null(df, a).cast("double"), nan_to_null(df, b).cast("double"))
                    .alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    stack = F.inline(F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                                        F.col(f"`{i}`").alias("r"))
                               for i, (a, b) in enumerate(pairs)]))
    return wide.select(stack)


def rejected_correlated(df: DataFrame, columns, threshold: float = 0.9) -> list:
    """Columns a profile report rejects: for each pair above ``threshold``
    (absolute r), the later column of the pair."""
    # a constant column has no correlation (NaN), which must not count as high
    pairs = correlation_pairs(df, columns).filter(~F.isnan("r") & (F.abs("r") > threshold)).collect()
    order = {c: i for i, c in enumerate(columns)}
    rejected = []
    for p in sorted(pairs, key=lambda p: (order[p["col_a"]], order[p["col_b"]])):
        if p["col_a"] not in rejected and p["col_b"] not in rejected:
            rejected.append(p["col_b"])
    return rejected


def missing_comatrix(df: DataFrame, columns) -> DataFrame:
    """``missing_comatrix``: correlation of missingness between columns, long
    form. Columns never (or always) missing have no defined correlation and
    are left out, as the heat map does."""
    flags = df.select(*[missing(df, c).cast("double").alias(c) for c in columns])
    sums = one_row(flags, *[F.sum(c).alias(c) for c in columns], F.count(F.lit(1)).alias("_n"))
    varying = [c for c in columns if sums[c] and sums[c] < sums["_n"]]
    return correlation_pairs(flags, varying)


def cluster_moments(df: DataFrame, cluster: str, x: str, y: str) -> DataFrame:
    """``cluster_moments``: per cluster mean/std (sample)/count of x and y."""
    return df.groupBy(cluster).agg(
        F.avg(x).alias("x"), F.avg(y).alias("y"),
        F.stddev_samp(x).alias("x_std"), F.stddev_samp(y).alias("y_std"),
        F.count(F.lit(1)).alias("num_observations"))


def bubble_frame(df: DataFrame, colour: str, x: str, y: str) -> DataFrame:
    """``bubble_frame``: (colour, mean x, mean y, size) for a bubble chart."""
    return df.groupBy(colour).agg(F.avg(x).alias("x"), F.avg(y).alias("y"),
                                  F.count(F.lit(1)).alias("size"))


def best_row(df: DataFrame, metric: str, tie_break: str, group=None) -> DataFrame:
    """``best_row``: the row with the largest ``metric``; the first (smallest
    ``tie_break``) among equals. Optional per-group."""
    key = F.struct(F.col(metric), -F.col(tie_break))
    best = F.max_by(F.struct(*[F.col(c) for c in df.columns]), key).alias("_b")
    if group:
        return df.groupBy(*_as_list(group)).agg(best).select("_b.*")
    return df.agg(best).select("_b.*")


def mean_over_folds(df: DataFrame, group, metric: str) -> DataFrame:
    """``mean_over_folds``: average of a metric over folds/windows."""
    return df.groupBy(*_as_list(group)).agg(F.avg(metric).alias(f"mean_{metric}"))
