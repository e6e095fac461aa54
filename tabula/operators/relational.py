"""Projections, filters, schema-driven column choice, reshaping, joins, set ops."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import missing, safe_corr
from ..plans.scale import one_row

# ---------------------------------------------------------------- projection


def project_alias(df: DataFrame, columns) -> DataFrame:
    """``project_alias``: keep columns, renaming on the way ({old: new} or list)."""
    if isinstance(columns, dict):
        return df.select(*[F.col(k).alias(v) for k, v in columns.items()])
    return df.select(*columns)


def rename_columns(df: DataFrame, mapping: dict) -> DataFrame:
    """``rename_columns``."""
    return df.withColumnsRenamed(mapping)


def drop_columns(df: DataFrame, columns) -> DataFrame:
    """``drop_columns``."""
    return df.drop(*columns)


def add_column(df: DataFrame, columns: dict) -> DataFrame:
    """``add_column``: derived columns {name: Column}."""
    return df.withColumns(columns)


# ------------------------------------------------------------------- filters


def filter_equal(df: DataFrame, column: str, value) -> DataFrame:
    """``filter_equal``."""
    return df.filter(F.col(column) == F.lit(value))


def filter_null_rows(df: DataFrame, column: str) -> DataFrame:
    """``filter_null_rows``: rows whose ``column`` is NULL (or NaN)."""
    return df.filter(missing(df, column))


def filter_or_bounds(df: DataFrame, column: str, lo, hi) -> DataFrame:
    """``filter_or_bounds``: rows strictly outside ``[lo, hi]``."""
    c = F.col(column)
    return df.filter((c > F.lit(hi)) | (c < F.lit(lo)))


# -------------------------------------------------------- schema-driven picks

_KINDS = {
    "number": T.NumericType,
    "string": T.StringType,
    "bool": T.BooleanType,
    "datetime": (T.TimestampType, T.TimestampNTZType, T.DateType),
}


def select_by_dtype(df: DataFrame, include=None, exclude=None) -> DataFrame:
    """``select_by_dtype``: like pandas ``select_dtypes`` (kinds: number,
    string, bool, datetime)."""
    def kind_match(dt, kinds):
        return any(isinstance(dt, _KINDS[k]) for k in kinds)
    keep = []
    for f in df.schema.fields:
        if include and not kind_match(f.dataType, include):
            continue
        if exclude and kind_match(f.dataType, exclude):
            continue
        keep.append(f.name)
    return df.select(*keep)


def distinct_counts(df: DataFrame, columns=None, exact: bool = True) -> dict:
    """Distinct (non-null) count per column, one aggregate pass.

    ``exact=False`` uses HyperLogLog++ (``approx_count_distinct``), which
    needs no per-column shuffle and is what to use on very wide tables.
    """
    columns = columns or df.columns
    fn = F.count_distinct if exact else F.approx_count_distinct
    return one_row(df, *[fn(F.col(c)).alias(c) for c in columns])


def select_by_cardinality(df: DataFrame, min_distinct: int = 30, columns=None,
                          exact: bool = True) -> DataFrame:
    """``select_by_cardinality``: keep columns with more than ``min_distinct``
    distinct values."""
    counts = distinct_counts(df, columns, exact)
    return df.select(*[c for c in (columns or df.columns) if counts[c] > min_distinct])


def select_by_correlation(df: DataFrame, target: str, threshold: float = 0.5,
                          columns=None) -> DataFrame:
    """``select_by_correlation``: numeric columns with ``abs(corr) >= threshold``
    against ``target`` (the target itself always qualifies)."""
    num = [c for c in (columns or df.columns)
           if isinstance(df.schema[c].dataType, T.NumericType)]
    r = one_row(df, *[safe_corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c)
                      for c in num])
    keep = [c for c in num if c == target or (r[c] is not None and abs(r[c]) >= threshold)]
    return df.select(*keep)


# ----------------------------------------------------------------- reshaping


def unpivot_melt(df: DataFrame, ids, values=None, var_name: str = "variable",
                 value_name: str = "value") -> DataFrame:
    """``unpivot_melt``: wide to long (pandas ``melt``)."""
    ids = [ids] if isinstance(ids, str) else list(ids)
    values = values or [c for c in df.columns if c not in ids]
    return df.unpivot(ids, values, var_name, value_name)


def dummy_pivot(df: DataFrame, columns, drop_first: bool = True,
                prefix_sep: str = "_") -> DataFrame:
    """``dummy_pivot``: pandas ``get_dummies`` — one 0/1 column per sorted
    level, the first level dropped; missing values give all zeros.

    The level lists come from one distinct-values job per column. The result
    is as wide as the columns have levels; for keys with very many levels use
    the long form (``assign_codes``) instead.
    """
    columns = [columns] if isinstance(columns, str) else list(columns)
    new_cols = []
    for c in columns:
        levels = [r[0] for r in df.select(c).filter(~missing(df, c)).distinct().orderBy(c).collect()]
        if drop_first:
            levels = levels[1:]
        for lvl in levels:
            new_cols.append(F.coalesce((F.col(c) == F.lit(lvl)).cast("int"), F.lit(0))
                            .alias(f"{c}{prefix_sep}{lvl}"))
    keep = [F.col(c) for c in df.columns if c not in columns]
    return df.select(*keep, *new_cols)


# --------------------------------------------------------------------- joins


def join_natural_inner(left: DataFrame, right: DataFrame, null_safe: bool = False) -> DataFrame:
    """``join_natural_inner``: inner join on every shared column name.

    pandas ``merge`` matches NULL keys to each other; ``null_safe=True``
    reproduces that with ``<=>``.
    """
    common = [c for c in left.columns if c in right.columns]
    if not common:
        raise ValueError("no shared columns")
    if not null_safe:
        return left.join(right, common, "inner")
    cond = [left[c].eqNullSafe(right[c]) for c in common]
    j = left.join(right, cond, "inner")
    return j.select(*[left[c] for c in left.columns],
                    *[right[c] for c in right.columns if c not in common])


def join_left_default(df: DataFrame, lookup: DataFrame, key, value: str, default,
                      out_col: str | None = None) -> DataFrame:
    """``join_left_default``: left lookup; unmatched and NULL keys get ``default``.

    No broadcast hint: the join strategy is left to AQE's measured sizes.
    """
    keys = [key] if isinstance(key, str) else list(key)
    out_col = out_col or value
    lk = lookup.select(*keys, F.col(value).alias("_lk_v"))
    return (df.join(lk, keys, "left")
            .withColumn(out_col, F.coalesce(F.col("_lk_v"), F.lit(default)))
            .drop("_lk_v"))


def concat_columns(df: DataFrame, *groups) -> DataFrame:
    """``concat_columns``: side-by-side columns of one row set (no join needed)."""
    cols = [c for g in groups for c in ([g] if isinstance(g, str) else g)]
    return df.select(*cols)


def update_where_missing(df: DataFrame, column: str, replacement: str,
                         out_col: str | None = None) -> DataFrame:
    """``update_where_missing``: keep present cells, fill missing ones."""
    out_col = out_col or column
    return df.withColumn(out_col, F.when(missing(df, column), F.col(replacement))
                         .otherwise(F.col(column)))


# ------------------------------------------------------------------ set ops


def union_all(*dfs: DataFrame) -> DataFrame:
    """``union_all``: append rows by column name."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def except_rows(df: DataFrame, other: DataFrame, distinct: bool = True) -> DataFrame:
    """``except_rows``: set difference (``subtract`` de-duplicates; ``exceptAll``
    keeps multiplicities)."""
    return df.subtract(other) if distinct else df.exceptAll(other)


def distinct_rows(df: DataFrame, columns=None) -> DataFrame:
    """``distinct_rows``."""
    return (df.select(*columns) if columns else df).distinct()
