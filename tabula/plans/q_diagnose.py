"""Registered queries: regression diagnostics with SQL oracles.

Each test runs on a fixture column with a known construction, so every
statistic is checkable in plain SQL; fitted-model residuals are in q_models.
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..operators import diagnose as D
from .fixtures import t
from .registry import query


def _log_tail_sql(x):
    """ln(1 - Phi(x)), x >= 0, by other means than the operator: Kummer's
    series near 0, the Laplace continued fraction (120 levels) further out."""
    density = f"(exp(-({x}) * ({x}) / 2.0) / {math.sqrt(2 * math.pi)})"
    series = f"list_reduce(range(80, 0, -1), lambda a, k: 1.0 + ({x}) * ({x}) / (2 * k + 1) * a, CAST(1.0 AS DOUBLE))"
    fraction = f"list_reduce(range(120, 0, -1), lambda a, k: ({x}) + k / a, CAST({x} AS DOUBLE) + 1)"
    return (f"CASE WHEN {x} < 2.5 THEN ln(0.5 - {density} * ({x}) * {series}) "
            f"ELSE -({x}) * ({x}) / 2.0 - ln({math.sqrt(2 * math.pi)} * {fraction}) END")


#: The p-value rule as published, written out once more for the oracle.
_AD_P_SQL = """CASE WHEN {a} > 13 THEN 0.0
  WHEN {a} >= 0.6 THEN exp(1.2937 - 5.709 * {a} + 0.0186 * {a} * {a})
  WHEN {a} > 0.34 THEN exp(0.9177 - 4.279 * {a} - 1.38 * {a} * {a})
  WHEN {a} > 0.2 THEN 1 - exp(-8.318 + 42.796 * {a} - 59.938 * {a} * {a})
  ELSE 1 - exp(-13.436 + 101.14 * {a} - 223.73 * {a} * {a}) END"""


def _ad_sql(src, col, key, group=None):
    g = f"{group}, " if group else ""
    part = f"PARTITION BY {group}" if group else ""
    z = f"(({col} - m) / s)"
    a2 = "(-n - t / n)"
    a2a = f"({a2} * (1 + 0.75 / n + 2.25 / (n * n)))"
    p = _AD_P_SQL.format(a=a2a)
    return f"""
WITH v AS (SELECT {g}{col}, {key} FROM {src} WHERE {col} IS NOT NULL),
r AS (SELECT {g}{col}, CAST(row_number() OVER ({part} ORDER BY {col}, {key}) AS DOUBLE) AS i,
             avg({col}) OVER ({part}) AS m, stddev_samp({col}) OVER ({part}) AS s,
             count(*) OVER ({part}) AS n FROM v),
z AS (SELECT *, {z} AS z, {_log_tail_sql(f"abs({z})")} AS tail FROM r),
a AS (SELECT {g}sum((2 * i - 1) * CASE WHEN z >= 0 THEN ln(1 - exp(tail)) ELSE tail END
             + (2 * (n - i) + 1) * CASE WHEN z >= 0 THEN tail ELSE ln(1 - exp(tail)) END) AS t, first(n) AS n
      FROM z {"GROUP BY " + group if group else ""})
SELECT {g}round({a2}, 6) AS ad_stat, round({a2a}, 6) AS ad_adjusted,
       round({p}, 6) AS p_value, CAST(n AS BIGINT) AS n, {p} >= 0.05 AS is_normal FROM a"""


@query("assume_normal_errors", _ad_sql("events", "value", "event_id"))
def q_assume_normal_errors(spark, sf):
    e = t(spark, sf, "events", ["event_id", "value"])
    out = D.anderson_darling(e, "value", "event_id")
    return out.select(*[F.round(c, 6).alias(c) for c in ["ad_stat", "ad_adjusted", "p_value"]], "n", "is_normal")


_FEAT = f"""(SELECT o_orderkey AS k, 'o_totalprice' AS feature, o_totalprice AS x FROM orders
 UNION ALL SELECT o_orderkey, 'o_custkey', CAST(o_custkey AS DOUBLE) FROM orders)"""


@query("normality_by_feature", _ad_sql(_FEAT + " f", "x", "k", group="feature"))
def q_normality_by_feature(spark, sf):
    o = t(spark, sf, "orders", ["o_orderkey", "o_totalprice", "o_custkey"])
    long = o.select(F.col("o_orderkey").alias("k"), F.col("o_totalprice"),
                    F.col("o_custkey").cast("double")) \
        .unpivot("k", ["o_totalprice", "o_custkey"], "feature", "x")
    out = D.anderson_darling(long, "x", "k", group="feature")
    return out.select("feature", *[F.round(c, 6).alias(c) for c in
                                   ["ad_stat", "ad_adjusted", "p_value"]], "n", "is_normal")


def _orders_long(spark, sf):
    o = t(spark, sf, "orders", ["o_orderkey", "o_totalprice", "o_custkey"])
    return o.select(F.col("o_orderkey").alias("k"), F.col("o_totalprice"), F.col("o_custkey").cast("double")) \
        .unpivot("k", ["o_totalprice", "o_custkey"], "feature", "x")


@query("normality_count", f"""
SELECT count(*) FILTER (NOT is_normal) AS n_not_normal, count(*) AS n_features
FROM ({_ad_sql(_FEAT + " f", "x", "k", group="feature")}) tests""")
def q_normality_count(spark, sf):
    return D.non_normal_count(D.anderson_darling(_orders_long(spark, sf), "x", "k", group="feature"))


@query("error_histogram", """
WITH e AS (SELECT min(value) AS a, max(value) AS b FROM events),
c AS (SELECT CAST(least(floor((value - a) / ((b - a) / 10)), 9) AS INTEGER) AS bin, count(*) AS count
      FROM events, e GROUP BY 1)
SELECT CAST(i AS INTEGER) AS bin, round(a + i * ((b - a) / 10), 9) AS bin_start, coalesce(count, 0) AS count
FROM range(10) r(i), e LEFT JOIN c ON c.bin = r.i""")
def q_error_histogram(spark, sf):
    out = D.histogram(t(spark, sf, "events", ["value"]), "value", 10)
    return out.withColumn("bin_start", F.round("bin_start", 9))


def _vif_sql(fs, src):
    g = {}
    for i, a in enumerate(fs):
        for j, b in enumerate(fs):
            g[(i, j)] = f"sum(CAST({a} AS DOUBLE) * CAST({b} AS DOUBLE))"
    # cofactor diagonal of a 3 x 3 symmetric matrix
    cof = {0: f"({g[1,1]} * {g[2,2]} - {g[1,2]} * {g[1,2]})",
           1: f"({g[0,0]} * {g[2,2]} - {g[0,2]} * {g[0,2]})",
           2: f"({g[0,0]} * {g[1,1]} - {g[0,1]} * {g[0,1]})"}
    det = (f"({g[0,0]} * {cof[0]} - {g[0,1]} * ({g[0,1]} * {g[2,2]} - {g[1,2]} * {g[0,2]})"
           f" + {g[0,2]} * ({g[0,1]} * {g[1,2]} - {g[1,1]} * {g[0,2]}))")
    parts = [f"SELECT '{f}' AS feature, round({cof[i]} / {det} * {g[i, i]}, 6) AS vif FROM {src}"
             for i, f in enumerate(fs)]
    return "\nUNION ALL ".join(parts)


_VIF_F = ["l_quantity", "l_discount", "l_tax"]


@query("assume_no_multicollinearity", _vif_sql(_VIF_F, "lineitem"))
def q_assume_no_multicollinearity(spark, sf):
    out = D.vif(t(spark, sf, "lineitem"), _VIF_F)
    return out.withColumn("vif", F.round("vif", 6))


@query("multicollinearity_verdict", f"""
SELECT count(*) FILTER (vif > 10) AS n_above_10, count(*) FILTER (vif > 100) AS n_above_100,
  CASE WHEN count(*) FILTER (vif > 100) > 0 THEN 'certain' WHEN count(*) FILTER (vif > 10) > 0 THEN 'possible'
       ELSE 'none' END AS verdict FROM ({_vif_sql(_VIF_F, "lineitem")}) v""")
def q_multicollinearity_verdict(spark, sf):
    return D.vif_verdict(D.vif(t(spark, sf, "lineitem"), _VIF_F))


@query("assume_no_autocorrelation", """
SELECT round(sum((r - p) * (r - p)) / sum(r * r), 9) AS durbin_watson,
  CASE WHEN sum((r - p) * (r - p)) / sum(r * r) < 1.5 THEN 'positive'
       WHEN sum((r - p) * (r - p)) / sum(r * r) > 2.5 THEN 'negative' ELSE 'none' END AS verdict
FROM (SELECT value - 50.0 AS r, lag(value - 50.0) OVER (ORDER BY ts, event_id) AS p FROM events)""")
def q_assume_no_autocorrelation(spark, sf):
    e = t(spark, sf, "events", ["event_id", "ts", "value"]).withColumn("r", F.col("value") - 50.0)
    out = D.durbin_watson(e, "r", order_by="ts", key="event_id")
    return out.select(F.round("durbin_watson", 9).alias("durbin_watson"), "verdict")


@query("assume_homoscedastic", """
SELECT CAST(floor((rn - 1) * 10 / n) AS INTEGER) AS bin, count(*) AS n,
       round(avg(fitted), 6) AS mean_fitted, round(var_samp(resid), 6) AS residual_var FROM (
  SELECT o_totalprice / 1000.0 AS fitted, (o_custkey % 97) - 48.0 AS resid,
         row_number() OVER (ORDER BY o_totalprice / 1000.0, o_orderkey) AS rn, count(*) OVER () AS n
  FROM orders) GROUP BY 1""")
def q_assume_homoscedastic(spark, sf):
    o = t(spark, sf, "orders", ["o_orderkey", "o_totalprice", "o_custkey"])
    o = o.select("o_orderkey", (F.col("o_totalprice") / 1000.0).alias("fitted"),
                 ((F.col("o_custkey") % 97) - 48.0).alias("resid"))
    out = D.residual_spread(o, "resid", "fitted", "o_orderkey", 10)
    return out.select("bin", "n", F.round("mean_fitted", 6).alias("mean_fitted"),
                      F.round("residual_var", 6).alias("residual_var"))


def _qbins_sql(col, src, max_bins=25):
    import numpy as np
    checks = []
    for q in range(max_bins, 1, -1):
        fr = [float(x) for x in np.linspace(0, 1, q + 1)]
        qs = ", ".join(repr(f) for f in fr)
        checks.append(f"WHEN len(list_distinct(quantile_cont({col}, [{qs}]))) = {q + 1} THEN {q}")
    return f"SELECT CASE {' '.join(checks)} ELSE 1 END AS max_bins FROM {src}"


@query("max_quantile_bins", _qbins_sql("l_quantity", "lineitem"))
def q_max_quantile_bins(spark, sf):
    q = D.max_quantile_bins(t(spark, sf, "lineitem", ["l_quantity"]), "l_quantity", 25)
    return spark.range(1).select(F.lit(q).alias("max_bins"))


@query("max_quantile_bins_events", _qbins_sql("value", "events"))
def q_max_quantile_bins_events(spark, sf):
    q = D.max_quantile_bins(t(spark, sf, "events", ["value"]), "value", 25)
    return spark.range(1).select(F.lit(q).alias("max_bins"))
