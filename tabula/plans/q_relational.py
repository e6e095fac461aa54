"""Registered queries: projections, filters, reshaping, joins, aggregates, set ops."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import aggregate as A
from ..operators import relational as R
from .fixtures import SQL_EVENTS_MISSING, events_missing, t
from .registry import query


@query("read_table", "SELECT * FROM orders")
def q_read_table(spark, sf):
    return t(spark, sf, "orders")


@query("group_size_share", """
SELECT l_returnflag, l_linestatus, count(*) AS size,
       count(*) / sum(count(*)) OVER (PARTITION BY l_returnflag) AS share
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def q_group_size_share(spark, sf):
    return A.group_size_share(t(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")


@query("group_size_percent", """
SELECT o_orderstatus, o_orderpriority, count(*) AS size,
       count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY o_orderstatus) AS percent
FROM orders GROUP BY o_orderstatus, o_orderpriority""")
def q_group_size_percent(spark, sf):
    return A.group_size_share(t(spark, sf, "orders"), "o_orderstatus", "o_orderpriority",
                              percent=True)


@query("project_alias", """
SELECT l_orderkey AS order_key, l_linenumber AS line, l_extendedprice AS price FROM lineitem""")
def q_project_alias(spark, sf):
    return R.project_alias(t(spark, sf, "lineitem"), {"l_orderkey": "order_key",
                                                      "l_linenumber": "line",
                                                      "l_extendedprice": "price"})


@query("rename_columns", """
SELECT n_nationkey AS nation_key, n_name AS nation, n_regionkey AS region_key FROM nation""")
def q_rename_columns(spark, sf):
    return R.rename_columns(t(spark, sf, "nation"), {"n_nationkey": "nation_key",
                                                     "n_name": "nation",
                                                     "n_regionkey": "region_key"})


@query("drop_columns", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders""")
def q_drop_columns(spark, sf):
    return R.drop_columns(t(spark, sf, "orders"), ["o_orderdate", "o_orderpriority"])


@query("add_column", """
SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS revenue,
       l_quantity > 25 AS big FROM lineitem""")
def q_add_column(spark, sf):
    li = t(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_extendedprice",
                                   "l_discount", "l_quantity"])
    out = R.add_column(li, {"revenue": F.col("l_extendedprice") * (1 - F.col("l_discount")),
                            "big": F.col("l_quantity") > 25})
    return out.select("l_orderkey", "l_linenumber", "revenue", "big")


@query("filter_equal", "SELECT * FROM lineitem WHERE l_returnflag = 'R'")
def q_filter_equal(spark, sf):
    return R.filter_equal(t(spark, sf, "lineitem"), "l_returnflag", "R")


@query("filter_null_rows", f"""
SELECT event_id, user_id FROM {SQL_EVENTS_MISSING} e WHERE value IS NULL OR isnan(value)""")
def q_filter_null_rows(spark, sf):
    return R.filter_null_rows(events_missing(spark, sf), "value").select("event_id", "user_id")


@query("filter_or_bounds", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 400000 OR o_totalprice < 50000""")
def q_filter_or_bounds(spark, sf):
    o = t(spark, sf, "orders", ["o_orderkey", "o_totalprice"])
    return R.filter_or_bounds(o, "o_totalprice", 50000, 400000)


@query("select_by_dtype", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def q_select_by_dtype(spark, sf):
    return R.select_by_dtype(t(spark, sf, "customer"), include=["number"])


@query("select_by_cardinality", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def q_select_by_cardinality(spark, sf):
    return R.select_by_cardinality(t(spark, sf, "orders"), 30)


@query("select_by_correlation", """
SELECT len(regexp_extract_all(text, '[\\p{L}\\p{N}_]+')) AS n_words, n_chars FROM documents""")
def q_select_by_correlation(spark, sf):
    d = t(spark, sf, "documents", ["doc_id", "text", "n_chars"])
    d = d.select("doc_id", F.size(S.tokens("text")).alias("n_words"), "n_chars")
    return R.select_by_correlation(d, "n_chars", 0.5)


@query("unpivot_melt", """
SELECT c_custkey, variable, value FROM (
  SELECT c_custkey, 'c_nationkey' AS variable, CAST(c_nationkey AS DOUBLE) AS value FROM customer
  UNION ALL
  SELECT c_custkey, 'c_acctbal', c_acctbal FROM customer)""")
def q_unpivot_melt(spark, sf):
    c = t(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").cast("double"),
                                        "c_acctbal")
    return R.unpivot_melt(c, "c_custkey", ["c_nationkey", "c_acctbal"])


@query("dummy_pivot", """
SELECT o_orderkey,
  CAST(o_orderstatus = 'O' AS INTEGER) AS o_orderstatus_O,
  CAST(o_orderstatus = 'P' AS INTEGER) AS o_orderstatus_P,
  CAST(o_orderpriority = '2-HIGH' AS INTEGER) AS "o_orderpriority_2-HIGH",
  CAST(o_orderpriority = '3-MEDIUM' AS INTEGER) AS "o_orderpriority_3-MEDIUM",
  CAST(o_orderpriority = '4-NOT SPECIFIED' AS INTEGER) AS "o_orderpriority_4-NOT SPECIFIED",
  CAST(o_orderpriority = '5-LOW' AS INTEGER) AS "o_orderpriority_5-LOW"
FROM orders""")
def q_dummy_pivot(spark, sf):
    o = t(spark, sf, "orders", ["o_orderkey", "o_orderstatus", "o_orderpriority"])
    return R.dummy_pivot(o, ["o_orderstatus", "o_orderpriority"])


@query("join_left_default", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, coalesce(p.p_retailprice, 0.0) AS price
FROM lineitem l LEFT JOIN (SELECT p_partkey, p_retailprice FROM part WHERE p_size <= 25) p
  ON l.l_partkey = p.p_partkey""")
def q_join_left_default(spark, sf):
    li = t(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey"])
    p = (t(spark, sf, "part").filter(F.col("p_size") <= 25)
         .select(F.col("p_partkey").alias("l_partkey"), F.col("p_retailprice").alias("price")))
    return R.join_left_default(li, p, "l_partkey", "price", 0.0)


@query("join_natural_inner", """
SELECT c.c_custkey, c.c_name, n.n_nationkey, n.n_name, r.r_name
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey""")
def q_join_natural_inner(spark, sf):
    c = t(spark, sf, "customer", ["c_custkey", "c_name", "c_nationkey"]) \
        .withColumnRenamed("c_nationkey", "n_nationkey")
    n = t(spark, sf, "nation")
    r = t(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return (R.join_natural_inner(R.join_natural_inner(c, n), r)
            .select("c_custkey", "c_name", "n_nationkey", "n_name", "r_name"))


@query("concat_columns", "SELECT l_orderkey, l_linenumber, l_tax, l_discount FROM lineitem")
def q_concat_columns(spark, sf):
    return R.concat_columns(t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"],
                            ["l_tax", "l_discount"])


@query("update_where_missing", f"""
SELECT event_id, CASE WHEN value IS NULL OR isnan(value) THEN CAST(event_id % 100 AS DOUBLE)
                      ELSE value END AS value
FROM {SQL_EVENTS_MISSING} e""")
def q_update_where_missing(spark, sf):
    e = events_missing(spark, sf).withColumn("pred", (F.col("event_id") % 100).cast("double"))
    return R.update_where_missing(e, "value", "pred").select("event_id", "value")


@query("union_all", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 300000""")
def q_union_all(spark, sf):
    o = t(spark, sf, "orders", ["o_orderkey", "o_orderstatus", "o_totalprice"])
    a = o.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice")
    b = o.filter(F.col("o_totalprice") > 300000).select("o_orderkey", "o_totalprice")
    return R.union_all(a, b)


@query("except_rows", """
SELECT o_custkey, o_orderpriority FROM orders
EXCEPT SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F'""")
def q_except_rows(spark, sf):
    o = t(spark, sf, "orders", ["o_custkey", "o_orderpriority", "o_orderstatus"])
    return R.except_rows(o.select("o_custkey", "o_orderpriority"),
                         o.filter(F.col("o_orderstatus") == "F").select("o_custkey", "o_orderpriority"))


@query("distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_tax FROM lineitem")
def q_distinct_rows(spark, sf):
    return R.distinct_rows(t(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus", "l_tax"])


# ---------------------------------------------------------------- aggregates


@query("count_rows", "SELECT count(*) AS n_rows FROM lineitem")
def q_count_rows(spark, sf):
    return A.count_rows(t(spark, sf, "lineitem"))


@query("value_counts", f"""
SELECT event_type, count(*) AS count FROM {SQL_EVENTS_MISSING} e
WHERE event_type IS NOT NULL GROUP BY event_type""")
def q_value_counts(spark, sf):
    return A.value_counts(events_missing(spark, sf), "event_type")


@query("rarest_value", """
SELECT o_orderpriority AS rarest FROM (
  SELECT o_orderpriority, count(*) AS c FROM orders GROUP BY 1) x ORDER BY c, o_orderpriority LIMIT 1""")
def q_rarest_value(spark, sf):
    v = A.rarest_value(t(spark, sf, "orders", ["o_orderpriority"]), "o_orderpriority")
    return spark.range(1).select(F.lit(v).alias("rarest"))


@query("distinct_values", "SELECT DISTINCT c_mktsegment FROM customer")
def q_distinct_values(spark, sf):
    return A.distinct_values(t(spark, sf, "customer"), "c_mktsegment")


@query("group_mean_count", f"""
SELECT event_type, round(avg(CASE WHEN isnan(value) THEN NULL ELSE value END), 9) AS mean,
       count(CASE WHEN isnan(value) THEN NULL ELSE value END) AS count
FROM {SQL_EVENTS_MISSING} e GROUP BY event_type""")
def q_group_mean_count(spark, sf):
    g = A.group_mean_count(events_missing(spark, sf), "event_type", "value")
    return g.withColumn("mean", F.round("mean", 9))


@query("column_means", f"""
SELECT round(avg(CASE WHEN isnan(value) THEN NULL ELSE value END), 9) AS value,
       round(avg(user_id), 9) AS user_id FROM {SQL_EVENTS_MISSING} e""")
def q_column_means(spark, sf):
    m = A.column_means(events_missing(spark, sf), ["value", "user_id"])
    return m.select(*[F.round(c, 9).alias(c) for c in m.columns])


@query("column_std_pop", """
SELECT round(stddev_pop(o_totalprice), 6) AS o_totalprice FROM orders""")
def q_column_std_pop(spark, sf):
    s = A.column_std_pop(t(spark, sf, "orders"), ["o_totalprice"])
    return s.select(F.round("o_totalprice", 6).alias("o_totalprice"))


@query("percentiles_exact", """
SELECT unnest([0.25, 0.5, 0.75]) AS p,
       unnest(quantile_cont(o_totalprice, [0.25, 0.5, 0.75])) AS value FROM orders""")
def q_percentiles_exact(spark, sf):
    return A.percentiles_frame(t(spark, sf, "orders"), "o_totalprice", (0.25, 0.5, 0.75))


@query("min_max_global", """
SELECT least(min(l_quantity), min(l_discount), min(l_tax)) AS global_min,
       greatest(max(l_quantity), max(l_discount), max(l_tax)) AS global_max FROM lineitem""")
def q_min_max_global(spark, sf):
    return A.min_max_global(t(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax"])


_CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _corr_sql(cols, src):
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 9) AS r FROM {src}")
    return "\nUNION ALL ".join(parts)


@query("correlation_matrix", _corr_sql(_CORR_COLS, "lineitem"))
def q_correlation_matrix(spark, sf):
    c = A.correlation_pairs(t(spark, sf, "lineitem"), _CORR_COLS)
    return c.withColumn("r", F.round("r", 9))


_MISS_SRC = f"""(SELECT CAST(event_type IS NULL AS DOUBLE) AS event_type,
  CAST(value IS NULL OR isnan(value) AS DOUBLE) AS value,
  CAST(props IS NULL AS DOUBLE) AS props FROM {SQL_EVENTS_MISSING} e) m"""


@query("missing_comatrix", _corr_sql(["event_type", "value", "props"], _MISS_SRC))
def q_missing_comatrix(spark, sf):
    c = A.missing_comatrix(events_missing(spark, sf), ["event_type", "value", "props"])
    return c.withColumn("r", F.round("r", 9))


@query("cluster_moments", """
SELECT event_type, round(avg(value), 9) AS x, round(avg(user_id), 9) AS y,
  round(stddev_samp(value), 9) AS x_std, round(stddev_samp(user_id), 9) AS y_std,
  count(*) AS num_observations FROM events GROUP BY event_type""")
def q_cluster_moments(spark, sf):
    m = A.cluster_moments(t(spark, sf, "events"), "event_type", "value", "user_id")
    return m.select("event_type", *[F.round(c, 9).alias(c) for c in ["x", "y", "x_std", "y_std"]],
                    "num_observations")


@query("bubble_frame", """
SELECT l_returnflag, round(avg(l_quantity), 9) AS x, round(avg(l_extendedprice), 6) AS y,
       count(*) AS size FROM lineitem GROUP BY l_returnflag""")
def q_bubble_frame(spark, sf):
    b = A.bubble_frame(t(spark, sf, "lineitem"), "l_returnflag", "l_quantity", "l_extendedprice")
    return b.select("l_returnflag", F.round("x", 9).alias("x"), F.round("y", 6).alias("y"), "size")


@query("best_row", """
SELECT event_type, event_id, value FROM (
  SELECT event_type, event_id, value,
    row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS rn FROM events)
WHERE rn = 1""")
def q_best_row(spark, sf):
    e = t(spark, sf, "events", ["event_type", "event_id", "value"])
    return A.best_row(e, "value", "event_id", group="event_type")


@query("mean_over_folds", """
SELECT event_id % 5 AS fold, round(avg(value), 9) AS mean_value FROM events GROUP BY 1""")
def q_mean_over_folds(spark, sf):
    e = t(spark, sf, "events").withColumn("fold", F.col("event_id") % 5)
    return A.mean_over_folds(e, "fold", "value").withColumn("mean_value", F.round("mean_value", 9))


@query("argmax_array", """
SELECT vec_id, list_position(embedding, list_max(embedding)) - 1 AS argmax FROM embeddings""")
def q_argmax_array(spark, sf):
    e = t(spark, sf, "embeddings")
    return e.select("vec_id", S.argmax_array("embedding").alias("argmax"))


@query("sort_desc", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def q_sort_desc(spark, sf):
    o = t(spark, sf, "orders", ["o_orderkey", "o_totalprice"])
    return o.orderBy(F.desc("o_totalprice"), "o_orderkey")


@query("top_n", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def q_top_n(spark, sf):
    # The limit is the operator (top-k report): planned as TakeOrderedAndProject.
    o = t(spark, sf, "orders", ["o_orderkey", "o_totalprice"])
    return o.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)

