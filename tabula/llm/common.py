"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabula.session import shared_path
from tabula.sources.tables import read_table

#: ASCII white space of the text contracts: space and 0x09-0x0D.
WS = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared checkpoint folder and reread it.

    Cuts the lineage: later passes read finished files, whichever executors
    are lost in between.
    """
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def crc_mod(id_col: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (NULL ids count as '')."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, every other character unchanged."""
    return F.translate(text, UPPER, LOWER)


def blocks(batches: Iterator[pa.RecordBatch], text_col: str,
           max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that one block holds about ``max_bytes`` of text
    (a single longer text is a block of its own)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        col = batch.column(batch.schema.get_field_index(text_col))
        sizes = pa.compute.fill_null(pa.compute.binary_length(col), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i in range(n):
            if i > start and held + sizes[i] > max_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(sizes[i])
        yield batch.slice(start, n - start)


def spread(df: DataFrame, column: str, parts: int) -> Column:
    """A stable shard number in ``[0, parts)`` for a key column."""
    return F.pmod(F.xxhash64(column), F.lit(parts)).cast("int")
