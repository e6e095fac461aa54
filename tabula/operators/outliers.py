"""Outlier detectors. Each returns the flagged rows (with the caller's key),
never row positions: Spark rows have no intrinsic order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import nan_to_null
from ..plans.scale import one_row, quantiles


def iqr_bounds(df: DataFrame, column: str, exact: bool = True, k: float = 1.5):
    if exact:
        q1, q3 = quantiles(df, column, (0.25, 0.75))
    else:
        v = nan_to_null(df, column)
        ps = F.array(F.lit(0.25), F.lit(0.75))
        q1, q3 = one_row(df, F.percentile_approx(v, ps, 10000).alias("q"))["q"]
    iqr = q3 - q1
    return q1 - iqr * k, q3 + iqr * k


def outliers_iqr(df: DataFrame, column: str, exact: bool = True, k: float = 1.5) -> DataFrame:
    """``outliers_iqr``: rows strictly outside ``[q1 - 1.5 IQR, q3 + 1.5 IQR]``.

    Quartiles are linear-interpolated like numpy; ``exact=False`` uses the
    bounded-memory quantile sketch instead. Bounds enter as literals.
    """
    lo, hi = iqr_bounds(df, column, exact, k)
    c = F.col(column)
    return df.filter((c > F.lit(hi)) | (c < F.lit(lo)))


def outliers_zscore(df: DataFrame, column: str, threshold: float = 3.0,
                    z_col: str = "z_score") -> DataFrame:
    """``outliers_zscore``: rows with ``abs((x - mean) / population std) > t``.
    A constant column (std 0) flags nothing."""
    v = nan_to_null(df, column)
    st = one_row(df, F.avg(v).alias("m"), F.stddev_pop(v).alias("s"))
    if not st.get("s"):
        return df.withColumn(z_col, F.lit(None).cast("double")).limit(0)
    z = (F.col(column) - F.lit(st["m"])) / F.lit(st["s"])
    return df.withColumn(z_col, z).filter(F.abs(F.col(z_col)) > threshold)


def outlier_report(df: DataFrame, features, key: str,
                   methods=("iqr", "zscore", "elliptic", "isolation_forest", "one_class")) -> DataFrame:
    """``outlier_report``: long table ``(method, feature, key)`` of every
    flagged row: per feature for the one-variable methods (``iqr``,
    ``zscore``), with the comma-joined features for the others."""
    from . import anomaly
    single = {"iqr": outliers_iqr, "zscore": outliers_zscore}
    joint = {"elliptic": anomaly.outliers_elliptic, "isolation_forest": anomaly.outliers_isolation_forest,
             "one_class": anomaly.outliers_one_class}
    features, parts = list(features), []
    for m in methods:
        if m in single:
            flagged = [(f, single[m](df, f)) for f in features]
        elif m in joint:
            flagged = [(",".join(features), joint[m](df, features, key).filter("is_outlier"))]
        else:
            raise ValueError(f"unknown method {m}")
        parts += [rows.select(F.lit(m).alias("method"), F.lit(f).alias("feature"), F.col(key))
                  for f, rows in flagged]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
