"""Multi-party perspective rotation of conversations.

For every participant of a conversation the whole dialogue is rendered with
that speaker as ``assistant`` and everybody else as a user with a name; the
loss mask covers the assistant's own words and end marks. ``system`` messages
belong to nobody and stay system messages.

The result has one row per perspective and message: its text, its place in
the rendered dialogue (code points) and the masked part. The rows in order of
``position`` joined together are the training text, so no conversation has to
fit into one task. Places are running sums; a conversation is summed block by
block of ``BLOCK`` turns, then over its blocks, so that a conversation with a
third of all rows spreads over many tasks.

Order within a conversation: turn (NULL last), then role, then text; equal
rows are interchangeable.

Defined results: a NULL text is an empty message; a NULL role is a nameless
user and no participant; rows with a NULL conversation form one conversation;
markers inside a text are broken up by a space; a conversation without
participants and an empty table give no rows; further columns are ignored.
Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabula.sources.tables import read_table

START, END = "<|start|>", "<|end|>\n"
#: Turns per block of the running sums.
BLOCK = 64
SYSTEM = "system"


def _head(role: Column, perspective: Column) -> Column:
    return F.concat(F.lit(START), F.when(role == SYSTEM, F.lit("system"))
                    .when(role == perspective, F.lit("assistant"))
                    .otherwise(F.concat(F.lit("user"), F.coalesce(F.concat(F.lit(" name="), _clean(role)), F.lit("")))),
                    F.lit("\n"))


def _clean(text: Column) -> Column:
    """Nothing inside a message can look like a marker."""
    return F.replace(F.replace(text, F.lit("<|"), F.lit("< |")), F.lit("|>"), F.lit("| >"))


def rotate(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conversation, ``perspective``, ``position`` (from 1), ``turn``,
    ``segment``, ``seg_start``, ``seg_end``, ``mask_start``, ``mask_end``
    (NULL unless the message is the assistant's)."""
    rows = messages.select(F.col(conv_col).alias("c"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"),
                           F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    people = rows.filter(F.col("role").isNotNull() & (F.col("role") != SYSTEM)).select(
        F.col("c").alias("pc"), F.col("role").alias("perspective")).distinct()
    head = _head(F.col("role"), F.col("perspective"))
    seen = (rows.join(people, F.col("c").eqNullSafe(F.col("pc"))).drop("pc")
            .withColumn("block", F.floor(F.coalesce(F.col("turn"), F.lit(2**62)) / BLOCK))
            .withColumn("head", head).withColumn("segment", F.concat("head", _clean(F.col("text")), F.lit(END)))
            .withColumn("size", F.length("segment").cast("long")))
    keys = ["c", "perspective", "block"]
    inside = Window.partitionBy(*keys).orderBy(F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_last(), "text") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    over = Window.partitionBy("c", "perspective").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (seen.groupBy(*keys).agg(F.sum("size").alias("b_size"), F.count("*").alias("b_rows"))
              .select(*[F.col(k).alias(f"b_{k}") for k in keys],
                      F.coalesce(F.sum("b_size").over(over), F.lit(0)).alias("chars_before"),
                      F.coalesce(F.sum("b_rows").over(over), F.lit(0)).alias("rows_before")))
    placed = seen.withColumn("upto", F.sum("size").over(inside)).withColumn("n", F.count("*").over(inside))
    joined = placed.join(blocks, F.col("c").eqNullSafe(F.col("b_c")) & (F.col("perspective") == F.col("b_perspective"))
                         & F.col("block").eqNullSafe(F.col("b_block")))
    end = F.col("chars_before") + F.col("upto")
    own = F.col("role") == F.col("perspective")
    return joined.select(
        F.col("c").alias(conv_col), "perspective", (F.col("rows_before") + F.col("n")).alias("position"),
        F.col("turn").alias(turn_col), "segment", (end - F.col("size")).alias("seg_start"), end.alias("seg_end"),
        F.when(own, end - F.col("size") + F.length("head")).alias("mask_start"),
        F.when(own, end - 1).alias("mask_end"))  # the end mark counts, its line end does not


def op9(spark, sf_dir: str) -> DataFrame:
    return rotate(read_table(spark, sf_dir, "conversations"))


OP9_SQL = r"""
WITH m AS (SELECT conv_id, turn, role, replace(replace(coalesce(text, ''), '<|', '< |'), '|>', '| >') AS body,
                  coalesce(text, '') AS raw FROM conversations),
p AS (SELECT DISTINCT conv_id, role AS perspective FROM conversations WHERE role IS NOT NULL AND role <> 'system'),
s AS (SELECT m.*, p.perspective, '<|start|>' || CASE WHEN role = 'system' THEN 'system'
        WHEN role = p.perspective THEN 'assistant' WHEN role IS NULL THEN 'user'
        ELSE 'user name=' || replace(replace(role, '<|', '< |'), '|>', '| >') END || chr(10) AS head
      FROM m JOIN p ON m.conv_id IS NOT DISTINCT FROM p.conv_id),
x AS (SELECT *, head || body || '<|end|>' || chr(10) AS segment FROM s),
y AS (SELECT *, row_number() OVER w AS position, CAST(sum(length(segment)) OVER w AS BIGINT) AS seg_end FROM x
      WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS LAST, role NULLS LAST, raw
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT conv_id, perspective, position, turn, segment, seg_end - length(segment) AS seg_start, seg_end,
       CASE WHEN role = perspective THEN seg_end - length(segment) + length(head) END AS mask_start,
       CASE WHEN role = perspective THEN seg_end - 1 END AS mask_end
FROM y
"""
