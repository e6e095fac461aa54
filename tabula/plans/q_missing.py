"""Registered queries: profiling, missing data, outliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import missing as M
from ..operators import outliers as O
from .fixtures import SQL_EVENTS_MISSING, events_missing, t
from .registry import query

_EM = SQL_EVENTS_MISSING


def _miss_sql(c, typ):
    if typ == "double":
        return f"({c} IS NULL OR isnan({c}))"
    return f"({c} IS NULL)"


_EV_TYPES = {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint",
             "event_type": "string", "value": "double", "props": "string"}

_PM_SQL = "SELECT column_name, percent_missing FROM (\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, avg(CAST({_miss_sql(c, ty)} AS DOUBLE)) * 100 AS percent_missing "
    f"FROM {_EM} e" for c, ty in _EV_TYPES.items()) + ") WHERE percent_missing > 0"


@query("percent_missing", _PM_SQL)
def q_percent_missing(spark, sf):
    return M.percent_missing(events_missing(spark, sf))


@query("format_percent", f"""
SELECT column_name, printf('%s: %.2f%%', column_name, percent_missing) AS line FROM ({_PM_SQL})""")
def q_format_percent(spark, sf):
    return M.format_percent(M.percent_missing(events_missing(spark, sf)))


@query("drop_missing", f"""
SELECT * FROM {_EM} e WHERE event_type IS NOT NULL AND value IS NOT NULL AND NOT isnan(value)
  AND props IS NOT NULL""")
def q_drop_missing(spark, sf):
    return M.drop_missing(events_missing(spark, sf), how="any")


@query("drop_missing_thresh", f"""
SELECT * FROM {_EM} e WHERE (CAST(event_type IS NOT NULL AS INTEGER)
  + CAST(value IS NOT NULL AND NOT isnan(value) AS INTEGER) + CAST(props IS NOT NULL AS INTEGER)) >= 2""")
def q_drop_missing_thresh(spark, sf):
    # thresh = 5 of the 6 columns present
    return M.drop_missing(events_missing(spark, sf), thresh=5)


@query("impute_mean", f"""
SELECT event_id, user_id, round(CASE WHEN value IS NULL OR isnan(value)
  THEN (SELECT avg(CASE WHEN isnan(value) THEN NULL ELSE value END) FROM {_EM} x)
  ELSE value END, 9) AS value FROM {_EM} e""")
def q_impute_mean(spark, sf):
    out = M.impute_mean(events_missing(spark, sf).select("event_id", "user_id", "value"))
    return out.withColumn("value", F.round("value", 9))


def _profile_sql():
    parts = []
    for c, ty in [("user_id", "bigint"), ("value", "double"), ("event_type", "string")]:
        v = f"(CASE WHEN isnan({c}) THEN NULL ELSE {c} END)" if ty == "double" else c
        num = ty != "string"
        stat = (lambda e: f"round(CAST({e} AS DOUBLE), 6)") if num else (lambda e: "CAST(NULL AS DOUBLE)")
        q = f"quantile_cont(CAST({v} AS DOUBLE), [0.25, 0.5, 0.75])"
        parts.append(f"""SELECT '{c}' AS column_name, '{ty}' AS type, count(*) AS n_rows,
  sum(CAST({_miss_sql(c, ty)} AS BIGINT)) AS n_missing,
  round(sum(CAST({_miss_sql(c, ty)} AS BIGINT)) * 100.0 / count(*), 9) AS percent_missing,
  count(DISTINCT {v}) AS n_distinct,
  {stat(f'avg({v})')} AS mean, {stat(f'stddev_samp({v})')} AS std,
  {stat(f'min({v})')} AS min, {stat(q + '[1]')} AS p25, {stat(q + '[2]')} AS p50,
  {stat(q + '[3]')} AS p75, {stat(f'max({v})')} AS max FROM {_EM} e""")
    return "\nUNION ALL ".join(parts)


@query("profile_columns", _profile_sql())
def q_profile_columns(spark, sf):
    p = M.profile_columns(events_missing(spark, sf), ["user_id", "value", "event_type"])
    r6 = ["mean", "std", "min", "p25", "p50", "p75", "max"]
    return p.select("column_name", "type", "n_rows", "n_missing",
                    F.round("percent_missing", 9).alias("percent_missing"), "n_distinct",
                    *[F.round(c, 6).alias(c) for c in r6])


@query("top_values", """
SELECT column_name, value, freq FROM (
  SELECT column_name, value, freq, row_number() OVER (PARTITION BY column_name ORDER BY freq DESC, value) AS rk
  FROM (SELECT 'event_type' AS column_name, event_type AS value, count(*) AS freq FROM events GROUP BY 2
        UNION ALL
        SELECT 'user_id', CAST(user_id AS VARCHAR), count(*) FROM events GROUP BY 2))
WHERE rk = 1""")
def q_top_values(spark, sf):
    return M.top_values(t(spark, sf, "events"), ["event_type", "user_id"], k=1)


@query("outliers_iqr", """
SELECT event_id, value FROM events, (
  SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events) b
WHERE value > q3 + (q3 - q1) * 1.5 OR value < q1 - (q3 - q1) * 1.5""")
def q_outliers_iqr(spark, sf):
    e = t(spark, sf, "events", ["event_id", "value"])
    return O.outliers_iqr(e, "value")


@query("outliers_zscore", """
SELECT event_id, value, round((value - m) / s, 9) AS z_score FROM events, (
  SELECT avg(value) AS m, stddev_pop(value) AS s FROM events) b
WHERE abs((value - m) / s) > 3""")
def q_outliers_zscore(spark, sf):
    e = t(spark, sf, "events", ["event_id", "value"])
    return O.outliers_zscore(e, "value", 3.0).withColumn("z_score", F.round("z_score", 9))


@query("write_profile", _profile_sql())
def q_write_profile(spark, sf):
    """The profile persisted as JSON in the shared folder and read back."""
    from ..session import shared_path
    p = M.profile_columns(events_missing(spark, sf), ["user_id", "value", "event_type"])
    path = shared_path(spark, "profile")
    M.write_profile(p, path)
    back = spark.read.schema(p.schema).json(path)
    r6 = ["mean", "std", "min", "p25", "p50", "p75", "max"]
    return back.select("column_name", "type", "n_rows", "n_missing",
                       F.round("percent_missing", 9).alias("percent_missing"), "n_distinct",
                       *[F.round(c, 6).alias(c) for c in r6])


@query("profile_rejected", """
WITH d AS (SELECT doc_id, len(regexp_extract_all(text, '[\\p{L}\\p{N}_]+')) AS n_words, n_chars,
                  length(lang) AS lang_len FROM documents),
p AS (SELECT 'n_words' AS a, 'n_chars' AS b, corr(n_words, n_chars) AS r FROM d
      UNION ALL SELECT 'n_words', 'lang_len', corr(n_words, lang_len) FROM d
      UNION ALL SELECT 'n_chars', 'lang_len', corr(n_chars, lang_len) FROM d)
SELECT b AS rejected FROM p WHERE r IS NOT NULL AND NOT isnan(r) AND abs(r) > 0.9""")
def q_profile_rejected(spark, sf):
    """The profile's rejected variables: for each column pair with |r| > 0.9,
    the later column (word count and character count are near collinear)."""
    from ..functions.scalar import tokens
    from ..operators.aggregate import rejected_correlated
    d = t(spark, sf, "documents", ["doc_id", "text", "n_chars", "lang"])
    d = d.select(F.size(tokens("text")).alias("n_words"), "n_chars",
                 F.length("lang").alias("lang_len"))
    rej = rejected_correlated(d, ["n_words", "n_chars", "lang_len"], 0.9)
    return spark.createDataFrame([(c,) for c in rej], "rejected STRING")
