"""Regression diagnostics: normality (Anderson-Darling), multicollinearity
(VIF), autocorrelation (Durbin-Watson), residual spread by fitted decile,
and the largest usable quantile-bin count.

Every test is a handful of aggregates; ranks come from the distributed
global rank, never from a single-partition window.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.scale import global_rank_total, one_row, quantiles
from .window import lag_variable

# Hart's rational approximation of the normal upper tail
# (algorithm 5666, highest power first) below HART_EDGE, relative error ~1e-15.
HART_NUM = (3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383,
            112.079291497871, 221.213596169931, 220.206867912376)
HART_DEN = (8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461,
            296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752)
HART_EDGE = 7.07106781186547
# D'Agostino & Stephens p-value pieces for the adjusted A^2.
AD_PIECES = ((0.6, (1.2937, -5.709, 0.0186)), (0.34, (0.9177, -4.279, -1.38)),
             (0.2, (-8.318, 42.796, -59.938)), (0.0, (-13.436, 101.14, -223.73)))
AD_ZERO = 13.0


def log_upper_tail(x: Column) -> Column:
    """ln(1 - Phi(x)) for x >= 0; beyond the edge a continued fraction, so the
    logarithm stays finite however far out the value lies."""
    def horner(coefficients):
        out = F.lit(coefficients[0])
        for c in coefficients[1:]:
            out = out * x + F.lit(c)
        return out
    tail = x + 0.65
    for k in (4, 3, 2, 1):
        tail = x + F.lit(float(k)) / tail
    near = F.log(horner(HART_NUM) / horner(HART_DEN))
    far = -F.log(tail * math.sqrt(2 * math.pi))
    return -x * x / 2.0 + F.when(x < HART_EDGE, near).otherwise(far)


def log_cdf_pair(z: Column):
    """(ln Phi(z), ln(1 - Phi(z))), each with full relative precision."""
    tail = log_upper_tail(F.abs(z))
    body = F.log1p(-F.exp(tail))
    return F.when(z >= 0, body).otherwise(tail), F.when(z >= 0, tail).otherwise(body)


def anderson_darling(df: DataFrame, column: str, key: str, group: str | None = None,
                     alpha: float = 0.05) -> DataFrame:
    """``assume_normal_errors`` / ``normality_by_feature``: Anderson-Darling
    normality statistic (mean and sample std estimated), adjusted statistic
    and p-value, per ``group`` if given.

    ``A2 = -n - (1/n) sum((2i - 1) ln Phi(z_i) + (2(n - i) + 1) ln(1 - Phi(z_i)))``
    needs only each value's rank ``i`` within its group.
    """
    g = [group] if group else []
    stats = df.groupBy(*g).agg(F.avg(column).alias("_m"), F.stddev_samp(column).alias("_s"),
                               F.count(column).alias("_n"))
    vals = df.filter(F.col(column).isNotNull())
    r, _ = global_rank_total(vals, [*g, column, key], rank_col="_r")
    first = r.groupBy(*g).agg(F.min("_r").alias("_f"))
    if g:
        st = stats.join(first, g)
        j = r.join(st, g)
    else:
        s1 = one_row(stats, F.first("_m").alias("m"), F.first("_s").alias("s"),
                     F.first("_n").alias("n"))
        j = r.withColumn("_m", F.lit(s1["m"])).withColumn("_s", F.lit(s1["s"])) \
             .withColumn("_n", F.lit(s1["n"]).cast("long")).withColumn("_f", F.lit(1).cast("long"))
    i = (F.col("_r") - F.col("_f") + 1).cast("double")
    z = (F.col(column) - F.col("_m")) / F.col("_s")
    ln_phi, ln_sf = log_cdf_pair(z)
    term = (2 * i - 1) * ln_phi + (2 * (F.col("_n") - i) + 1) * ln_sf
    agg = j.groupBy(*g).agg(F.sum(term).alias("_t"), F.first("_n").cast("double").alias("n"))
    a2 = -F.col("n") - F.col("_t") / F.col("n")
    a2a = a2 * (1 + 0.75 / F.col("n") + 2.25 / (F.col("n") * F.col("n")))
    # above 13 the rule returns 0: its last piece turns upward further out
    pv = F.when(a2a > AD_ZERO, F.lit(0.0))
    for bound, (c0, c1, c2) in AD_PIECES:
        e = F.exp(F.lit(c0) + F.lit(c1) * a2a + F.lit(c2) * a2a * a2a)
        val = e if bound >= 0.34 else 1 - e
        cond = (a2a >= bound) if bound == 0.6 else (a2a > bound) if bound > 0 else F.lit(True)
        pv = pv.when(cond, val)
    return agg.select(*g, a2.alias("ad_stat"), a2a.alias("ad_adjusted"), pv.alias("p_value"),
                      F.col("n").cast("long").alias("n"), (pv >= alpha).alias("is_normal"))


def non_normal_count(tests: DataFrame) -> DataFrame:
    """How many of the tested features are not normal, of how many."""
    return tests.agg(F.count_if(~F.col("is_normal")).alias("n_not_normal"), F.count(F.lit(1)).alias("n_features"))


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Counts in equal-width bins over [min, max] (the last bin is closed);
    empty bins are kept. One aggregate for the ends, one for the counts."""
    ends = one_row(df, F.min(column).cast("double").alias("a"), F.max(column).cast("double").alias("b"))
    low, high = ends["a"], ends["b"]
    if low is None:
        return df.sparkSession.createDataFrame([], "bin INT, bin_start DOUBLE, count BIGINT")
    width = (high - low) / bins or 1.0
    number = F.least(F.floor((F.col(column).cast("double") - low) / width), F.lit(bins - 1)).cast("int")
    got = df.filter(F.col(column).isNotNull()).groupBy(number.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    return (df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).join(got, "bin", "left")
            .select("bin", (F.lit(low) + F.col("bin") * F.lit(width)).alias("bin_start"),
                    F.coalesce("count", F.lit(0)).alias("count")))


def vif(df: DataFrame, features) -> DataFrame:
    """``assume_no_multicollinearity``: uncentered VIF per feature,
    ``VIF_i = G_ii / rss_i`` from one Gram-matrix aggregate (d x d on the
    driver); infinity for a feature that the others add up to."""
    d = len(features)
    aggs = [F.sum(F.col(a).cast("double") * F.col(b).cast("double")).alias(f"g{i}_{j}")
            for i, a in enumerate(features) for j, b in enumerate(features) if j >= i]
    g = one_row(df, *aggs)
    G = np.zeros((d, d))
    for i in range(d):
        for j in range(i, d):
            G[i, j] = G[j, i] = g[f"g{i}_{j}"]
    rows = []
    for i, f in enumerate(features):
        rest = [j for j in range(d) if j != i]
        fit = np.linalg.lstsq(G[np.ix_(rest, rest)], G[rest, i], rcond=None)[0] if rest else np.zeros(0)
        left = G[i, i] - G[rest, i] @ fit  # residual sum of squares
        rows.append((f, float(G[i, i] / left) if left > 1e-10 * G[i, i] else math.inf))
    return df.sparkSession.createDataFrame(rows, "feature STRING, vif DOUBLE")


def vif_verdict(vifs: DataFrame) -> DataFrame:
    """Counts of features above 10 (possible) and above 100 (certain
    multicollinearity) and the verdict."""
    out = vifs.agg(F.count_if(F.col("vif") > 10).alias("n_above_10"), F.count_if(F.col("vif") > 100).alias("n_above_100"))
    return out.withColumn("verdict", F.when(F.col("n_above_100") > 0, F.lit("certain"))
                          .when(F.col("n_above_10") > 0, F.lit("possible")).otherwise(F.lit("none")))


def durbin_watson(df: DataFrame, residual: str, order_by, *, key) -> DataFrame:
    """``assume_no_autocorrelation``: ``sum((e_t - e_{t-1})^2) / sum(e_t^2)``
    over an explicit order, with the verdict bands 1.5 / 2.5."""
    lagged = lag_variable(df, residual, order_by=order_by, key=key, offset=1, out_col="_prev")
    d = F.col(residual) - F.col("_prev")
    out = lagged.agg((F.sum(d * d) / F.sum(F.col(residual) * F.col(residual))).alias("durbin_watson"))
    return out.withColumn("verdict", F.when(F.col("durbin_watson") < 1.5, F.lit("positive"))
                          .when(F.col("durbin_watson") > 2.5, F.lit("negative"))
                          .otherwise(F.lit("none")))


def residual_spread(df: DataFrame, residual: str, fitted: str, key: str, bins: int = 10) -> DataFrame:
    """``assume_homoscedastic``: residual variance per fitted-value decile."""
    r, n = global_rank_total(df, [fitted, key], rank_col="_r")
    b = F.floor((F.col("_r") - 1) * bins / F.lit(n)).cast("int")
    return r.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"),
                                         F.avg(fitted).alias("mean_fitted"),
                                         F.var_samp(residual).alias("residual_var"))


def max_quantile_bins(df: DataFrame, column: str, max_bins: int = 25) -> int:
    """``max_quantile_bins``: the largest q <= max_bins whose q-quantile edges
    are all distinct (1 always qualifies). One exact percentile pass for the
    union of all candidate edges."""
    fr = sorted({float(x) for q in range(2, max_bins + 1) for x in np.linspace(0, 1, q + 1)})
    vals = quantiles(df, column, fr)
    if vals[0] is None:
        return 1
    edge = dict(zip(fr, vals))
    for q in range(max_bins, 1, -1):
        e = [edge[float(x)] for x in np.linspace(0, 1, q + 1)]
        if all(a != b for a, b in zip(e, e[1:])):
            return q
    return 1
