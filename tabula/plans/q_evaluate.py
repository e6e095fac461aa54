"""Registered queries: evaluation metrics, confusion matrix, cutoffs, residuals."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as V
from .fixtures import SQL_DOC_SCORES, SQL_LINEITEM_LABEL, doc_scores, lineitem_label, t
from .registry import query

# A fixed linear predictor (the noise-free part of the derived label) makes
# regression metrics SQL-checkable; fitted models are in q_models.
_PRED = "3.0 * l_quantity - 200.0 * l_discount"


@query("residual_frame", f"""
SELECT l_orderkey, l_linenumber, l_partkey, round(y, 9) + 0.0 AS actual,
  round({_PRED}, 9) + 0.0 AS predicted, round(y - ({_PRED}), 9) + 0.0 AS residual,
  round(abs(y) - abs({_PRED}), 9) + 0.0 AS abs_difference
FROM {SQL_LINEITEM_LABEL} li""")
def q_residual_frame(spark, sf):
    li = lineitem_label(spark, sf).withColumn("prediction", 3.0 * F.col("l_quantity")
                                              - 200.0 * F.col("l_discount"))
    r = V.residual_frame(li, "y", "prediction", keep=["l_orderkey", "l_linenumber", "l_partkey"])
    return r.select("l_orderkey", "l_linenumber", "l_partkey",
                    *[F.round(c, 9).alias(c) for c in
                      ["actual", "predicted", "residual", "abs_difference"]])


@query("metrics_regression", f"""
SELECT l_returnflag, round(sqrt(avg((y - ({_PRED})) * (y - ({_PRED})))), 9) AS rmse,
  round(avg(abs(y - ({_PRED}))), 9) AS mae,
  round(1 - sum((y - ({_PRED})) * (y - ({_PRED}))) / (var_pop(y) * count(y)), 9) AS r2,
  count(*) AS n
FROM {SQL_LINEITEM_LABEL} li GROUP BY l_returnflag""")
def q_metrics_regression(spark, sf):
    li = lineitem_label(spark, sf).withColumn("prediction", 3.0 * F.col("l_quantity")
                                              - 200.0 * F.col("l_discount"))
    m = V.metrics_regression(li, "y", "prediction", group="l_returnflag")
    return m.select("l_returnflag", *[F.round(c, 9).alias(c) for c in ["rmse", "mae", "r2"]], "n")


@query("confusion_matrix", f"""
WITH s AS (SELECT quality AS label, CAST(score > 0.5 AS INTEGER) AS prediction FROM {SQL_DOC_SCORES} d),
g AS (SELECT a.c AS label, b.c AS prediction FROM (SELECT DISTINCT label AS c FROM s UNION SELECT DISTINCT prediction FROM s) a,
      (SELECT DISTINCT label AS c FROM s UNION SELECT DISTINCT prediction FROM s) b),
c AS (SELECT label, prediction, count(*) AS count FROM s GROUP BY ALL)
SELECT g.label, g.prediction, coalesce(c.count, 0) AS count,
       coalesce(c.count, 0) / sum(coalesce(c.count, 0)) OVER (PARTITION BY g.label) AS share
FROM g LEFT JOIN c USING (label, prediction)""")
def q_confusion_matrix(spark, sf):
    s = doc_scores(spark, sf).withColumn("pred", (F.col("score") > 0.5).cast("int"))
    return V.confusion_matrix(s, "quality", "pred", normalize=True)


_F1_SQL = f"""
WITH g AS (SELECT i * CAST(0.01 AS DOUBLE) AS threshold, i FROM range(0, 31) t(i)),
s AS (SELECT quality, score FROM {SQL_DOC_SCORES} d),
c AS (SELECT threshold, i, sum(CAST(quality = 1 AND score > threshold AS INTEGER)) AS tp,
        sum(CAST(quality = 0 AND score > threshold AS INTEGER)) AS fp,
        sum(CAST(quality = 1 AND NOT score > threshold AS INTEGER)) AS fn
      FROM g, s GROUP BY threshold, i),
f AS (SELECT threshold, i, CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0
        ELSE 2.0 * tp / (2 * tp + fp + fn) END AS f1 FROM c)
SELECT threshold, f1, i = (SELECT i FROM f ORDER BY f1 DESC, i LIMIT 1) AS is_best FROM f"""


@query("f1_by_threshold", _F1_SQL)
def q_f1_by_threshold(spark, sf):
    return V.f1_by_threshold(doc_scores(spark, sf), "quality", "score", 0.3, 0.01)


@query("f1_best_cutoff", f"""
SELECT threshold, f1 FROM ({_F1_SQL}) x WHERE is_best""")
def q_f1_best_cutoff(spark, sf):
    f = V.f1_by_threshold(doc_scores(spark, sf), "quality", "score", 0.3, 0.01)
    return f.filter("is_best").select("threshold", "f1")


@query("metrics_classification", f"""
WITH s AS (SELECT quality AS y, CAST(score > 0.5 AS INTEGER) AS p,
                  least(greatest(score, 1e-15), 1 - 1e-15) AS q, score FROM {SQL_DOC_SCORES} d),
c AS (SELECT avg(CAST(y = p AS DOUBLE)) AS accuracy,
        sum(CAST(y = 1 AND p = 1 AS BIGINT)) AS tp, sum(CAST(y = 0 AND p = 1 AS BIGINT)) AS fp,
        sum(CAST(y = 1 AND p = 0 AS BIGINT)) AS fn, count(*) AS n,
        -avg(y * ln(q) + (1 - y) * ln(1 - q)) AS log_loss FROM s),
r AS (SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk FROM s),
a AS (SELECT (sum(CASE WHEN y = 1 THEN rk END) - sum(y) * (sum(y) + 1) / 2.0)
             / (sum(y) * (count(*) - sum(y))) AS auc FROM r)
SELECT round(accuracy, 9) AS accuracy, round(tp / (tp + fp), 9) AS precision,
       round(tp / (tp + fn), 9) AS recall,
       round(2 * (tp / (tp + fp)) * (tp / (tp + fn)) / ((tp / (tp + fp)) + (tp / (tp + fn))), 9) AS f1,
       round(log_loss, 9) AS log_loss, round(auc, 9) AS auc, n FROM c, a""")
def q_metrics_classification(spark, sf):
    s = doc_scores(spark, sf).withColumn("pred", (F.col("score") > 0.5).cast("int"))
    m = V.metrics_classification(s, "quality", "pred", "score")
    return m.select(*[F.round(c, 9).alias(c) for c in
                      ["accuracy", "precision", "recall", "f1", "log_loss", "auc"]], "n")


_TEN = "(SELECT label AS y, CASE WHEN vec_id % 5 = 0 THEN (label + vec_id) % 9 ELSE label END AS p FROM embeddings)"


@query("metrics_by_class", f"""
WITH s AS (SELECT CAST(y AS VARCHAR) AS y, CAST(p AS VARCHAR) AS p FROM {_TEN} x),
k AS (SELECT y AS class FROM s UNION SELECT p FROM s),
c AS (SELECT class, (SELECT count(*) FROM s WHERE y = class AND p = class) AS tp,
      (SELECT count(*) FROM s WHERE y = class) AS support, (SELECT count(*) FROM s WHERE p = class) AS said FROM k),
r AS (SELECT class, CASE WHEN said = 0 THEN 0.0 ELSE tp / said END AS precision,
      CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS recall, support FROM c
      UNION ALL SELECT 'micro', sum(tp) / sum(said), sum(tp) / sum(support), sum(support) FROM c),
f AS (SELECT class, precision, recall, CASE WHEN precision + recall = 0 THEN 0.0
      ELSE 2 * precision * recall / (precision + recall) END AS f1, CAST(support AS BIGINT) AS support FROM r)
SELECT class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, support FROM f
UNION ALL SELECT 'macro', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9), CAST(sum(support) AS BIGINT)
FROM f WHERE class <> 'micro'""")
def q_metrics_by_class(spark, sf):
    e = t(spark, sf, "embeddings", ["vec_id", "label"])
    e = e.withColumn("p", F.when(F.col("vec_id") % 5 == 0, (F.col("label") + F.col("vec_id")) % 9).otherwise(F.col("label")))
    m = V.metrics_by_class(e, "label", "p")
    return m.select("class", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("f1_micro_multiclass", """
WITH s AS (SELECT label % 3 AS y, (vec_id * 37 % 101) / CAST(100 AS DOUBLE) AS score FROM embeddings),
g AS (SELECT i, i * CAST(0.01 AS DOUBLE) AS threshold FROM range(31) r(i)),
f AS (SELECT threshold, i, avg(CAST(y = CAST(score > threshold AS INTEGER) AS DOUBLE)) AS f1 FROM g, s GROUP BY threshold, i)
SELECT round(threshold, 9) AS threshold, round(f1, 9) AS f1, i = (SELECT i FROM f ORDER BY f1 DESC, i LIMIT 1) AS is_best FROM f""")
def q_f1_micro_multiclass(spark, sf):
    e = t(spark, sf, "embeddings", ["vec_id", "label"]).select(
        (F.col("label") % 3).alias("y"), ((F.col("vec_id") * 37 % 101) / 100.0).alias("score"))
    f = V.f1_by_threshold(e, "y", "score", 0.3, 0.01, average="micro")
    return f.select(F.round("threshold", 9).alias("threshold"), F.round("f1", 9).alias("f1"), "is_best")


_LIN_GRID = [float(x) for x in __import__("numpy").linspace(0, 0.1, 100)]


@query("append_results", f"""
WITH g AS (SELECT unnest(CAST([{", ".join(repr(x) for x in _LIN_GRID)}] AS DOUBLE[])) AS threshold,
                  unnest(range(0, {len(_LIN_GRID)})) AS i),
s AS (SELECT toxic, score FROM {SQL_DOC_SCORES} d),
c AS (SELECT threshold, i, sum(CAST(toxic = 1 AND score > threshold AS INTEGER)) AS tp,
        sum(CAST(toxic = 0 AND score > threshold AS INTEGER)) AS fp,
        sum(CAST(toxic = 1 AND NOT score > threshold AS INTEGER)) AS fn
      FROM g, s GROUP BY threshold, i),
f AS (SELECT threshold, i, CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0
        ELSE 2.0 * tp / (2 * tp + fp + fn) END AS f1 FROM c)
SELECT threshold, f1, i = (SELECT i FROM f ORDER BY f1 DESC, i LIMIT 1) AS is_best FROM f""")
def q_append_results(spark, sf):
    """The grow-by-append threshold table (100 cutoffs on [0, 0.1]) built by
    one aggregate instead of a row-by-row loop."""
    return V.f1_by_threshold(doc_scores(spark, sf), "toxic", "score", grid=_LIN_GRID)
