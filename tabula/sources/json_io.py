"""JSON in and out: split-orient documents and one-object-per-row records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPLIT_SCHEMA = "STRUCT<columns: ARRAY<STRING>, index: ARRAY<BIGINT>, data: ARRAY<ARRAY<STRING>>>"


def to_split_json(df: DataFrame, group, columns, index: str, out_col: str = "payload") -> DataFrame:
    """Build one split-orient document ``{"columns", "index", "data"}`` per
    group (the writer side of ``read_split_json``). Rows keep ``index`` order."""
    group = [group] if isinstance(group, str) else list(group)
    cells = F.concat(F.lit("["), F.concat_ws(",", *[
        F.regexp_replace(F.to_json(F.array(F.col(c))), r"^\[|\]$", "") for c in columns]), F.lit("]"))
    rows = df.select(*group, F.col(index).cast("long").alias("_i"), cells.alias("_row"))
    agg = rows.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("_i", "_row"))).alias("_r"))
    cols_json = F.to_json(F.array(*[F.lit(c) for c in columns]))
    doc = F.concat(F.lit('{"columns":'), cols_json,
                   F.lit(',"index":['), F.array_join(F.transform("_r", lambda s: s["_i"].cast("string")), ","),
                   F.lit('],"data":['), F.array_join(F.transform("_r", lambda s: s["_row"]), ","),
                   F.lit("]}"))
    return agg.select(*group, doc.alias(out_col))


def read_split_json(df: DataFrame, json_col: str, schema: list, keep=(),
                    index_col: str = "index") -> DataFrame:
    """``read_split_json``: rows out of a split-orient JSON document column.

    ``schema`` is ``[(name, type), ...]``; columns are found by name in the
    document's ``columns`` list, cells converted with ``try_cast`` (a bad
    cell becomes NULL instead of failing the job under ANSI mode).
    """
    parsed = df.select(*keep, F.from_json(F.col(json_col), SPLIT_SCHEMA).alias("_d"))
    rows = parsed.select(*keep, "_d.columns",
                         F.posexplode(F.arrays_zip(F.col("_d.index"), F.col("_d.data")))
                         .alias("_p", "_z"))
    out = [F.col("_z.index").alias(index_col)]
    for name, typ in schema:
        pos = F.array_position(F.col("columns"), F.lit(name)).cast("int")
        cell = F.try_element_at(F.col("_z.data"), pos)
        out.append(cell.try_cast(typ).alias(name))
    return rows.select(*keep, *out)


def records_json(df: DataFrame, columns=None, out_col: str = "record") -> DataFrame:
    """``write_records_json`` (column form): one JSON object per row."""
    cols = columns or df.columns
    return df.withColumn(out_col, F.to_json(F.struct(*cols)))


def write_records_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``write_records_json``: JSON-lines files, one object per row."""
    df.write.mode(mode).json(path)


def read_records_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read JSON-lines records back with a declared schema."""
    return spark.read.schema(schema).json(path)
