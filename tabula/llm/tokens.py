"""Byte-level BPE encoding and decoding of documents (merge replay, ``bpe.py``).

Defined results: a NULL or empty text has no ids; texts of any length are
encoded whole; repeated rows and repeated ids give one result row per input
row; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.llm.bpe import load_encoder
from tabula.llm.common import blocks, documents

#: Bytes of text whose distinct words are replayed together in one task.
BLOCK_BYTES = 16 << 20


def encode(docs: DataFrame, vocab: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id and ``ids array<int>``."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        enc = load_encoder(vocab)
        for block in blocks(batches, "text", BLOCK_BYTES):
            ids, at = enc.encode_block(block.column(1))
            yield pa.RecordBatch.from_arrays(
                [block.column(0), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))],
                names=["id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, vocab: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The reverse: one row per document with the decoded ``bytes binary``
    (a NULL list decodes to no bytes)."""
    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))

    def run(batches):
        enc = load_encoder(vocab)
        for batch in batches:
            out = [enc.decode(x or ()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["id", "bytes"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, bytes binary").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, vocab: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, decode the ids again, and keep the count and both digests:
    ``n_tokens``, ``ids_sha256`` (decimal ids joined by one space) and
    ``decoded_sha256``. The ids themselves never leave the worker."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        enc = load_encoder(vocab)
        decimal = [str(i) for i in range(len(enc.bytes_of))]
        for block in blocks(batches, "text", BLOCK_BYTES):
            ids, at = enc.encode_block(block.column(1))
            counts, shas, back = [], [], []
            for a, b in zip(at[:-1], at[1:]):
                own = ids[a:b].tolist()
                counts.append(len(own))
                shas.append(hashlib.sha256(" ".join([decimal[i] for i in own]).encode()).hexdigest())
                back.append(hashlib.sha256(enc.decode(own)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [block.column(0), pa.array(counts, pa.int64()), pa.array(shas), pa.array(back)],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (rows.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
            .withColumnRenamed("id", id_col))


def op6(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"))
