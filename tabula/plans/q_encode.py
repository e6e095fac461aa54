"""Registered queries: encoding, scaling, projection."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import encode as E
from .fixtures import t
from .registry import query


@query("assemble_features", """
SELECT l_orderkey, l_linenumber, [l_quantity, l_discount, l_tax] AS features,
       l_extendedprice AS label FROM lineitem""")
def q_assemble_features(spark, sf):
    li = t(spark, sf, "lineitem")
    out = E.assemble_features(li, ["l_quantity", "l_discount", "l_tax"], "l_extendedprice",
                              keep=["l_orderkey", "l_linenumber"])
    return out.withColumn("features", vector_to_array("features"))


@query("one_hot_encode", """
WITH lv AS (SELECT o_orderpriority, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS idx,
                   count(*) OVER () AS k
            FROM orders GROUP BY o_orderpriority)
SELECT o_orderkey, list_transform(range(0, k - 1), lambda i: CAST(i = idx AS INTEGER)) AS o_orderpriority_one_hot
FROM orders JOIN lv USING (o_orderpriority)""")
def q_one_hot_encode(spark, sf):
    o = t(spark, sf, "orders", ["o_orderkey", "o_orderpriority"])
    out = E.one_hot_index_array(E.one_hot_encode(o, "o_orderpriority"), "o_orderpriority")
    return out.select("o_orderkey", "o_orderpriority_one_hot")


_TE_SQL = """
WITH tr AS (SELECT * FROM lineitem WHERE l_orderkey % 4 <> 0 AND l_suppkey % 10 <> 3),
te AS (SELECT * FROM lineitem WHERE l_orderkey % 4 = 0),
pr AS (SELECT avg(l_quantity) AS p FROM tr),
st AS (SELECT l_suppkey, avg(l_quantity) AS m, count(l_quantity) AS n FROM tr GROUP BY l_suppkey),
enc AS (SELECT l_suppkey, p * (1 - w) + m * w AS e
        FROM (SELECT st.*, pr.p, 1.0 / (1.0 + exp(-(n - 1) / 1.0)) AS w FROM st, pr))
SELECT 'train' AS split, l_orderkey, l_linenumber, l_suppkey,
       round(coalesce(e, p), 9) AS l_suppkey_mean FROM tr LEFT JOIN enc USING (l_suppkey), pr
UNION ALL
SELECT 'test', l_orderkey, l_linenumber, l_suppkey, round(coalesce(e, p), 9)
FROM te LEFT JOIN enc USING (l_suppkey), pr"""


@query("target_encode", _TE_SQL)
def q_target_encode(spark, sf):
    li = t(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_suppkey", "l_quantity"])
    tr = li.filter((F.col("l_orderkey") % 4 != 0) & (F.col("l_suppkey") % 10 != 3))
    te = li.filter(F.col("l_orderkey") % 4 == 0)
    a, b = E.target_encode(tr, te, "l_suppkey", "l_quantity", smoothing=1, min_samples_leaf=1)
    cols = ["l_orderkey", "l_linenumber", "l_suppkey", F.round("l_suppkey_mean", 9).alias("l_suppkey_mean")]
    return a.select(F.lit("train").alias("split"), *cols).unionByName(
        b.select(F.lit("test").alias("split"), *cols))


@query("scale_minmax", """
SELECT l_orderkey, l_linenumber, l_partkey,
  round((l_quantity - min(l_quantity) OVER ()) / (max(l_quantity) OVER () - min(l_quantity) OVER ()), 12) AS l_quantity,
  round((l_extendedprice - min(l_extendedprice) OVER ()) / (max(l_extendedprice) OVER () - min(l_extendedprice) OVER ()), 12) AS l_extendedprice
FROM lineitem""")
def q_scale_minmax(spark, sf):
    li = t(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
                                   "l_extendedprice"])
    out = E.scale_minmax(li, ["l_quantity", "l_extendedprice"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey",
                      *[F.round(c, 12).alias(c) for c in ["l_quantity", "l_extendedprice"]])


@query("scale_standard", """
SELECT event_id, round((value - avg(value) OVER ()) / stddev_pop(value) OVER (), 6) AS value,
  round((user_id - avg(user_id) OVER ()) / stddev_pop(user_id) OVER (), 6) AS user_id FROM events""")
def q_scale_standard(spark, sf):
    e = t(spark, sf, "events", ["event_id", "value", "user_id"])
    out = E.scale_standard(e, ["value", "user_id"])
    return out.select("event_id", F.round("value", 6).alias("value"),
                      F.round("user_id", 6).alias("user_id"))


@query("scale_maxabs", """
SELECT o_orderkey, round(o_totalprice / (SELECT max(abs(o_totalprice)) FROM orders
  WHERE o_orderkey % 10 < 7), 12) AS o_totalprice FROM orders""")
def q_scale_maxabs(spark, sf):
    o = t(spark, sf, "orders", ["o_orderkey", "o_totalprice"])
    train = o.filter(F.col("o_orderkey") % 10 < 7)
    out = E.scale_maxabs(o, ["o_totalprice"], fitted_on=train)
    return out.select("o_orderkey", F.round("o_totalprice", 12).alias("o_totalprice"))


@query("pca_fit")
def q_pca_fit(spark, sf):
    """PCA on the 64-d embeddings (reaching 99% variance); per-component
    explained variance percent. No oracle: DuckDB has no eigensolver."""
    emb = t(spark, sf, "embeddings")
    wide = emb.select("vec_id", *[F.col("embedding")[i].cast("double").alias(f"e{i}")
                                  for i in range(64)])
    scores, explained = E.pca_fit(wide, [f"e{i}" for i in range(64)], 0.99, key="vec_id")
    k = len(explained.collect())
    return scores.select("vec_id", F.size("pc").alias("k"), F.col("pc")[0].alias("pc1")) \
        .withColumn("k_expected", F.lit(k))
