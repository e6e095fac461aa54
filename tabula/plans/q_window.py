"""Registered queries: ordered/window operators, sort, shuffles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.random import draw_int, sql_draw_int
from ..operators import window as W
from .fixtures import SQL_EVENTS_MISSING, SQL_EVENTS_NULL, events_missing, events_null, t
from .registry import query

_EV_W = "PARTITION BY user_id ORDER BY ts, event_id"


@query("lag_variable", f"""
SELECT event_id, user_id, value,
       lag(value, 12) OVER ({_EV_W}) AS previous_value FROM events""")
def q_lag_variable(spark, sf):
    e = t(spark, sf, "events", ["event_id", "ts", "user_id", "value"])
    out = W.lag_variable(e, "value", order_by="ts", entity="user_id", key="event_id", offset=12)
    return out.select("event_id", "user_id", "value", "previous_value")


@query("forward_fill", f"""
SELECT event_id, user_id, last_value(value IGNORE NULLS) OVER ({_EV_W}
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM {SQL_EVENTS_NULL} e""")
def q_forward_fill(spark, sf):
    out = W.forward_fill(events_null(spark, sf), "value", order_by="ts", entity="user_id",
                         key="event_id")
    return out.select("event_id", "user_id", "value")


@query("backward_fill", f"""
SELECT event_id, user_id, first_value(value IGNORE NULLS) OVER ({_EV_W}
  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS value FROM {SQL_EVENTS_NULL} e""")
def q_backward_fill(spark, sf):
    out = W.backward_fill(events_null(spark, sf), "value", order_by="ts", entity="user_id",
                          key="event_id")
    return out.select("event_id", "user_id", "value")


@query("rolling_mean", f"""
SELECT event_id, CASE WHEN count(value) OVER w >= 5 THEN round(avg(value) OVER w, 9) END
  AS value_rolling_mean
FROM {SQL_EVENTS_NULL} e WINDOW w AS ({_EV_W} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""")
def q_rolling_mean(spark, sf):
    out = W.rolling_mean(events_null(spark, sf), "value", order_by="ts", window=5,
                         entity="user_id", key="event_id")
    return out.select("event_id", F.round("value_rolling_mean", 9).alias("value_rolling_mean"))


@query("window_number", """
SELECT event_id, CAST(floor((rn - 1) / size) + 1 AS INTEGER) AS window_num,
       CAST(rn - floor((rn - 1) / size) * size AS BIGINT) AS row_in_window
FROM (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS rn,
             CAST(round(count(*) OVER () / 5.0) AS BIGINT) AS size FROM events)""")
def q_window_number(spark, sf):
    e = t(spark, sf, "events", ["event_id", "ts"])
    out, _, _ = W.window_number(e, "ts", 5, key="event_id")
    return out.select("event_id", "window_num", "row_in_window")


@query("head_per_window", """
SELECT event_id, window_num, CASE WHEN row_in_window <= n_train THEN 'train' ELSE 'test' END AS split
FROM (SELECT event_id, CAST(floor((rn - 1) / size) + 1 AS INTEGER) AS window_num,
             rn - floor((rn - 1) / size) * size AS row_in_window, n_train
      FROM (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS rn,
                   CAST(round(count(*) OVER () / 3.0) AS BIGINT) AS size,
                   CAST(round(count(*) OVER () * 0.8 / 3.0) AS BIGINT) AS n_train FROM events))
WHERE window_num <= 3""")
def q_head_per_window(spark, sf):
    e = t(spark, sf, "events", ["event_id", "ts"])
    out = W.head_per_window(e, "ts", 3, test_size=0.2, key="event_id")
    return out.select("event_id", "window_num", "split")


@query("sort_order_rank", """
SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) - 1 AS order_rank
FROM customer""")
def q_sort_order_rank(spark, sf):
    c = t(spark, sf, "customer", ["c_custkey", "c_acctbal"])
    out = W.sort_order_rank(c, [F.desc("c_acctbal"), F.col("c_custkey")])
    return out.select("c_custkey", "order_rank")


@query("assign_codes", f"""
SELECT event_id, CAST(CASE WHEN event_type IS NULL THEN -1
  ELSE dense_rank() OVER (ORDER BY event_type) - 1 END AS INTEGER) AS event_type_code
FROM {SQL_EVENTS_MISSING} e""")
def q_assign_codes(spark, sf):
    out = W.assign_codes(events_missing(spark, sf), "event_type")
    return out.select("event_id", "event_type_code")


@query("share_of_group", """
SELECT l_orderkey, l_linenumber, l_partkey,
       round(l_extendedprice / sum(l_extendedprice) OVER (PARTITION BY l_returnflag), 12)
         AS l_extendedprice_share FROM lineitem""")
def q_share_of_group(spark, sf):
    li = t(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey",
                                   "l_returnflag", "l_extendedprice"])
    out = W.share_of_group(li, "l_extendedprice", "l_returnflag")
    return out.select("l_orderkey", "l_linenumber", "l_partkey",
                      F.round("l_extendedprice_share", 12).alias("l_extendedprice_share"))


@query("minibatch_number", f"""
SELECT event_id, (rn - 1) // 128 AS batch, CAST((rn - 1) % 128 AS INTEGER) AS pos_in_batch FROM (
  SELECT event_id, row_number() OVER (ORDER BY {sql_draw_int('event_id', 46)}, event_id) AS rn,
         count(*) OVER () AS n FROM events)
WHERE (rn - 1) // 128 < n // 128""")
def q_minibatch_number(spark, sf):
    e = t(spark, sf, "events", ["event_id"])
    out = W.minibatch_number(e, "event_id", batch_size=128, shuffle=True, seed=46)
    return out.select("event_id", "batch", "pos_in_batch")


@query("split_ordered_tail", """
SELECT event_id, rn > CAST(floor(n * 0.9) AS BIGINT) AS is_validation FROM (
  SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS rn, count(*) OVER () AS n
  FROM events)""")
def q_split_ordered_tail(spark, sf):
    e = t(spark, sf, "events", ["event_id", "ts"])
    out = W.split_ordered_tail(e, "ts", 0.1, key="event_id")
    return out.select("event_id", "is_validation")


@query("shuffle_rows", f"""
SELECT event_id, row_number() OVER (ORDER BY {sql_draw_int('event_id', 7)}, event_id) - 1 AS position
FROM events""")
def q_shuffle_rows(spark, sf):
    e = t(spark, sf, "events", ["event_id"])
    out = W.sort_order_rank(e, [draw_int("event_id", 7), F.col("event_id")], out_col="position")
    return out.select("event_id", "position")


@query("rows_by_position", """
SELECT o_orderkey, o_totalprice FROM (
  SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders)
WHERE rn > 100 AND rn <= 200""")
def q_rows_by_position(spark, sf):
    o = t(spark, sf, "orders", ["o_orderkey", "o_totalprice"])
    return W.rows_by_position(o, ["o_orderkey"], 100, 200)


_SPLIT_SQL = """
SELECT event_id, window_num, CASE WHEN row_in_window <= n_train THEN 'train' ELSE 'test' END AS split
FROM (SELECT event_id, CAST(floor((rn - 1) / size) + 1 AS INTEGER) AS window_num,
             rn - floor((rn - 1) / size) * size AS row_in_window, n_train
      FROM (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS rn,
                   CAST(round(count(*) OVER () / 5.0) AS BIGINT) AS size,
                   CAST(round(count(*) OVER () * 0.8 / 5.0) AS BIGINT) AS n_train FROM events))
WHERE window_num <= 5"""


@query("split_sliding_window", _SPLIT_SQL)
def q_split_sliding_window(spark, sf):
    e = t(spark, sf, "events", ["event_id", "ts"])
    out = W.head_per_window(e, "ts", 5, test_size=0.2, key="event_id")
    return out.select("event_id", "window_num", "split")


@query("rows_to_frame", f"SELECT event_id, window_num FROM ({_SPLIT_SQL}) s WHERE split = 'train'")
def q_rows_to_frame(spark, sf):
    """The first n rows of every window as a frame: a row-number filter in
    place of collecting ``head(n)`` to the driver and sending it back."""
    e = t(spark, sf, "events", ["event_id", "ts"])
    out = W.head_per_window(e, "ts", 5, test_size=0.2, key="event_id")
    return out.filter(F.col("split") == "train").select("event_id", "window_num")
