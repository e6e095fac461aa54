"""Registered queries: exact k-nearest neighbours and SMOTE oversampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.random import sql_draw_int, sql_draw_uniform
from ..operators import neighbors as N
from .fixtures import t
from .registry import query


def _pairs_sql(src_q, src_r):
    d = ("list_sum(list_transform(range(1, 65), lambda i: "
         "(CAST(q.embedding[i] AS DOUBLE) - CAST(r.embedding[i] AS DOUBLE)) * "
         "(CAST(q.embedding[i] AS DOUBLE) - CAST(r.embedding[i] AS DOUBLE))))")
    return (f"SELECT q.vec_id, r.vec_id AS neighbor_id, {d} AS d "
            f"FROM {src_q} q, {src_r} r WHERE q.vec_id <> r.vec_id")


@query("knn_join", f"""
SELECT vec_id, neighbor_id, CAST(neighbor_rank AS INTEGER) AS neighbor_rank FROM (
  SELECT vec_id, neighbor_id, row_number() OVER (PARTITION BY vec_id ORDER BY d, neighbor_id) AS neighbor_rank
  FROM ({_pairs_sql('embeddings', 'embeddings')}) p) WHERE neighbor_rank <= 5""")
def q_knn_join(spark, sf):
    e = t(spark, sf, "embeddings", ["vec_id", "embedding"])
    nn = N.knn_join(e, e, "vec_id", "vec_id", "embedding", k=5, exclude_self=True)
    return nn.select("vec_id", "neighbor_id", "neighbor_rank")


_SMOTE_SQL = f"""
WITH c AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label),
mi AS (SELECT label, n FROM c ORDER BY n, CAST(label AS VARCHAR) LIMIT 1),
m AS (SELECT vec_id, embedding, row_number() OVER (ORDER BY vec_id) - 1 AS r
      FROM embeddings WHERE label = (SELECT label FROM mi)),
nn AS (SELECT vec_id AS base, neighbor_id, neighbor_rank FROM (
         SELECT vec_id, neighbor_id, row_number() OVER (PARTITION BY vec_id ORDER BY d, neighbor_id) AS neighbor_rank
         FROM ({_pairs_sql('m', 'm')}) p) WHERE neighbor_rank <= 5),
s AS (SELECT i AS synthetic_id,
             {sql_draw_int('i', 46)} % (SELECT n FROM mi) AS r,
             {sql_draw_int('i', 47)} % least(5, (SELECT n FROM mi) - 1) + 1 AS neighbor_rank,
             {sql_draw_uniform('i', 48)} AS u
      FROM range(0, (SELECT max(n) FROM c) - (SELECT n FROM mi)) t(i))
SELECT s.synthetic_id, b.vec_id AS base_id, nn.neighbor_id,
       list_transform(range(1, 65), lambda i: CAST(b.embedding[i] AS DOUBLE)
         + s.u * (CAST(x.embedding[i] AS DOUBLE) - CAST(b.embedding[i] AS DOUBLE))) AS embedding,
       (SELECT label FROM mi) AS label
FROM s JOIN m b ON b.r = s.r JOIN nn ON nn.base = b.vec_id AND nn.neighbor_rank = s.neighbor_rank
JOIN m x ON x.vec_id = nn.neighbor_id"""


@query("oversample_smote", _SMOTE_SQL)
def q_oversample_smote(spark, sf):
    e = t(spark, sf, "embeddings")
    return N.oversample_smote(e, "label", "vec_id", "embedding", k=5, seed=46)


@query("outliers_isolation_forest")
def q_outliers_isolation_forest(spark, sf):
    """Isolation forest (100 trees of at most 256 keyed-draw rows) over the
    64-d embeddings; every row with its score and the 'auto' flag."""
    from ..operators.anomaly import outliers_isolation_forest
    e = t(spark, sf, "embeddings")
    wide = e.select("vec_id", *[F.col("embedding")[i].alias(f"e{i}") for i in range(64)])
    return outliers_isolation_forest(wide, [f"e{i}" for i in range(64)], "vec_id", 100, 256)


@query("outliers_elliptic")
def q_outliers_elliptic(spark, sf):
    """Robust-covariance distances over the numeric order columns; the top
    10% flagged. (The rule asks for rows >= features^2, which the embeddings
    of the small fixtures do not have.)"""
    from ..operators.anomaly import outliers_elliptic
    o = t(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"])
    o = o.withColumn("day", F.datediff("o_orderdate", F.lit("1990-01-01")).cast("double"))
    return outliers_elliptic(o, ["o_custkey", "o_totalprice", "day"], "o_orderkey", 0.1)


@query("outliers_one_class")
def q_outliers_one_class(spark, sf):
    """Approximate RBF one-class SVM (random Fourier features) over the
    numeric order columns; nu = 0.5 as the default detector."""
    from ..operators.anomaly import outliers_one_class
    o = t(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"])
    o = o.withColumn("day", F.datediff("o_orderdate", F.lit("1990-01-01")).cast("double"))
    return outliers_one_class(o, ["o_custkey", "o_totalprice", "day"], "o_orderkey", nu=0.5)


@query("outlier_report_joint")
def q_outlier_report_joint(spark, sf):
    """The report by the three detectors that look at all features together."""
    from ..operators.outliers import outlier_report
    o = t(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"])
    o = o.withColumn("day", F.datediff("o_orderdate", F.lit("1990-01-01")).cast("double"))
    return outlier_report(o, ["o_custkey", "o_totalprice", "day"], "o_orderkey",
                          methods=("elliptic", "isolation_forest", "one_class"))
