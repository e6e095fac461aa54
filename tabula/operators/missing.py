"""Profiling and missing data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import is_numeric, missing, nan_to_null
from ..plans.scale import column_summaries, one_row


def percent_missing(df: DataFrame, columns=None) -> DataFrame:
    """``percent_missing``: percent of missing cells per column, only columns
    with any (an empty result means "No missing values"). One pass."""
    columns = columns or df.columns
    wide = df.agg(*[(F.avg(missing(df, c).cast("double")) * 100).alias(c) for c in columns])
    return (wide.unpivot([], columns, "column_name", "percent_missing")
            .filter(F.col("percent_missing") > 0))


def format_percent(pm: DataFrame) -> DataFrame:
    """``format_percent``: the report line ``name: 12.34%`` per column."""
    return pm.select("column_name", F.format_string("%s: %.2f%%", F.col("column_name"),
                                               F.col("percent_missing")).alias("line"))


def drop_missing(df: DataFrame, how: str = "any", thresh: int | None = None,
                 subset=None) -> DataFrame:
    """``drop_missing``: pandas ``dropna`` (NaN counts as missing)."""
    return df.na.drop(how=how, thresh=thresh, subset=subset)


def impute_mean(df: DataFrame, columns=None) -> DataFrame:
    """``impute_mean``: fill NULL/NaN in numeric columns with the column mean.

    Means and missing counts come from one aggregate; the means enter the
    projection as literals. Columns with nothing missing are left untouched;
    a filled column becomes double (pandas upcasts an int column with gaps).
    """
    columns = columns or [c for c in df.columns if is_numeric(df, c)]
    aggs = []
    for i, c in enumerate(columns):
        aggs += [F.avg(nan_to_null(df, c)).alias(f"a{i}"),
                 F.sum(missing(df, c).cast("long")).alias(f"m{i}")]
    st = one_row(df, *aggs)
    fills = {c: st[f"a{i}"] for i, c in enumerate(columns)
             if st[f"m{i}"] and st[f"a{i}"] is not None}
    return df.select(*[
        F.when(missing(df, c), F.lit(float(fills[c]))).otherwise(F.col(c).cast("double")).alias(c)
        if c in fills else F.col(c) for c in df.columns])


def _distinct_counts(df: DataFrame, columns) -> dict:
    """Exact distinct present values of every column: the (column, value) rows
    are combined per task before the one shuffle, and no task holds the
    distinct values of a whole column."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("c"), nan_to_null(df, c).cast("string").alias("v")) for c in columns])).alias("x"))
    values = long.filter(F.col("x.v").isNotNull()).select("x.c", "x.v").distinct()
    return {r["c"]: r["count"] for r in values.groupBy("c").count().collect()}


def profile_columns(df: DataFrame, columns=None, exact_distinct: bool = True) -> DataFrame:
    """``profile_columns``: one row per column with count, missing, distinct,
    and for numeric columns mean, sample std, min, quartiles and max.

    Moments and missing counts of all columns come from one aggregate;
    quartiles and distinct counts of all columns from one range partitioning of
    their (column, value, count) rows; the wide result row is reshaped to long
    form. With ``exact_distinct=False`` only numeric columns are laid out.
    """
    columns = columns or df.columns
    values = {c: nan_to_null(df, c) for c in columns}
    numeric = {c: v for c, v in values.items() if is_numeric(df, c)}
    other = {c: v for c, v in values.items() if c not in numeric} if exact_distinct else {}
    quartiles, distinct = column_summaries(df, numeric, other, (0.25, 0.5, 0.75))
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(columns):
        v = nan_to_null(df, c)
        aggs += [F.sum(missing(df, c).cast("long")).alias(f"m{i}"), (F.lit(distinct.get(c, 0)) if exact_distinct else F.approx_count_distinct(v)).alias(f"d{i}")]
        if is_numeric(df, c):
            vd = v.cast("double")
            q = F.array(*[F.lit(x).cast("double") for x in quartiles[c]])
            aggs += [F.avg(vd).alias(f"mean{i}"), F.stddev_samp(vd).alias(f"std{i}"),
                     F.min(vd).alias(f"min{i}"), F.max(vd).alias(f"max{i}"), q.alias(f"q{i}")]
    wide = df.agg(*aggs)
    structs = []
    for i, c in enumerate(columns):
        num = is_numeric(df, c)
        nul = F.lit(None).cast("double")
        structs.append(F.struct(
            F.lit(c).alias("column_name"),
            F.lit(df.schema[c].dataType.simpleString()).alias("type"),
            F.col("_n").alias("n_rows"),
            F.col(f"m{i}").alias("n_missing"),
            (F.col(f"m{i}") * 100.0 / F.col("_n")).alias("percent_missing"),
            F.col(f"d{i}").alias("n_distinct"),
            (F.col(f"mean{i}") if num else nul).alias("mean"),
            (F.col(f"std{i}") if num else nul).alias("std"),
            (F.col(f"min{i}") if num else nul).alias("min"),
            (F.col(f"q{i}")[0] if num else nul).alias("p25"),
            (F.col(f"q{i}")[1] if num else nul).alias("p50"),
            (F.col(f"q{i}")[2] if num else nul).alias("p75"),
            (F.col(f"max{i}") if num else nul).alias("max")))
    return wide.select(F.inline(F.array(*structs)))


def top_values(df: DataFrame, columns, k: int = 1) -> DataFrame:
    """Most frequent value(s) per column (the profile's "top" and "freq").

    Long form first, then a partial aggregate per (column, value): a value
    holding a third of the rows is combined map-side before the shuffle.
    Ties break on the value's text.
    """
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
        for c in columns]))).filter(F.col("value").isNotNull())
    counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("freq"))
    if k == 1:
        best = F.min_by(F.struct("value", "freq"), F.struct(-F.col("freq"), F.col("value")))
        return counts.groupBy("column_name").agg(best.alias("t")).select("column_name", "t.value", "t.freq")
    from pyspark.sql import Window
    w = Window.partitionBy("column_name").orderBy(F.desc("freq"), "value")
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def write_profile(profile: DataFrame, path: str, fmt: str = "json") -> None:
    """``write_profile``: persist a profile table (one small file)."""
    profile.coalesce(1).write.mode("overwrite").format(fmt).save(path)
