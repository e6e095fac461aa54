"""Registered queries: splits, resampling, balanced class samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.random import sql_draw_int
from ..operators import sample as P
from .fixtures import t
from .registry import query


@query("split_holdout", f"""
SELECT event_id, CASE WHEN rn <= CAST(ceil(0.3 * n) AS BIGINT) THEN 'test' ELSE 'train' END AS split
FROM (SELECT event_id, row_number() OVER (ORDER BY {sql_draw_int('event_id', 46)}, event_id) AS rn,
             count(*) OVER () AS n FROM events)""")
def q_split_holdout(spark, sf):
    e = t(spark, sf, "events", ["event_id"])
    return P.split_holdout(e, "event_id", 0.3, seed=46)


@query("split_kfold", f"""
SELECT o_orderkey, CAST(CASE WHEN j < r * (q + 1) THEN floor(j / (q + 1))
                             ELSE r + floor((j - r * (q + 1)) / q) END AS INTEGER) AS fold
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY {sql_draw_int('o_orderkey', 46)}, o_orderkey) - 1 AS j,
             count(*) OVER () // 10 AS q, count(*) OVER () % 10 AS r FROM orders)""")
def q_split_kfold(spark, sf):
    o = t(spark, sf, "orders", ["o_orderkey"])
    return P.split_kfold(o, "o_orderkey", 10, seed=46)


@query("oversample_binary", f"""
WITH c AS (SELECT toxic, count(*) AS n FROM labels GROUP BY toxic),
mi AS (SELECT toxic, n FROM c ORDER BY n, CAST(toxic AS VARCHAR) LIMIT 1),
ma AS (SELECT toxic, n FROM c ORDER BY n DESC, CAST(toxic AS VARCHAR) DESC LIMIT 1),
r AS (SELECT l.doc_id, l.toxic, row_number() OVER (ORDER BY {sql_draw_int('l.doc_id', 46)}, l.doc_id) AS rn
      FROM labels l JOIN mi USING (toxic))
SELECT doc_id, toxic, CAST(1 AS INTEGER) AS copy FROM labels WHERE toxic = (SELECT toxic FROM ma)
UNION ALL
SELECT doc_id, toxic, CAST(unnest(range(1, CAST((SELECT n FROM ma) // (SELECT n FROM mi)
  + CASE WHEN rn <= (SELECT n FROM ma) % (SELECT n FROM mi) THEN 1 ELSE 0 END + 1 AS BIGINT))) AS INTEGER) AS copy
FROM r""")
def q_oversample_binary(spark, sf):
    lab = t(spark, sf, "labels", ["doc_id", "toxic"])
    return P.oversample_binary(lab, "toxic", "doc_id", seed=46)


@query("sample_balanced_classes", f"""
SELECT vec_id, label FROM (
  SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY {sql_draw_int('vec_id', 46)}, vec_id) AS rn
  FROM embeddings) WHERE rn <= 400 // (SELECT count(DISTINCT label) FROM embeddings)""")
def q_sample_balanced_classes(spark, sf):
    e = t(spark, sf, "embeddings", ["vec_id", "label"])
    return P.sample_balanced_classes(e, "label", "vec_id", 400, seed=46).select("vec_id", "label")
