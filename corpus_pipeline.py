"""Corpus pipeline: language ID, exact dedup, near dedup, secrets, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the
stage before it kept; its result is written as Parquet and read again as the
next stage's ``docs``. All but the last return the columns of ``documents``
(and any further ones, under whatever names: inside a stage the columns go by
their place).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabula.llm import exact_dedup, langid, packing, secrets, simhash
from tabula.llm.common import documents, stash
from tabula.session import ensure_checkpoint_dir


def _by_place(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """``docs`` with columns c0, c1, ..., and those of the id and the text."""
    place = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*place.values()), place["doc_id"], place["text"]


def _by_name(frame: DataFrame, docs: DataFrame) -> DataFrame:
    return frame.select(*[f"c{i}" for i in range(len(docs.columns))]).toDF(*docs.columns)


def _one_row_each(rows: DataFrame, key: Column, kept: DataFrame) -> DataFrame:
    """One row of ``rows`` for every ``key`` that ``kept`` (column ``k``) lists.

    The list grows with the input: both sides are sorted and may spill. The
    rows are partitioned by the key then, so the last step needs no shuffle."""
    keys = kept.select(F.col("k").alias("listed")).distinct().hint("merge")
    return rows.withColumn("k", key).join(keys, F.col("k") == F.col("listed"), "left_semi").dropDuplicates(["k"])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no language is found go.

    NULL and empty texts and texts without a letter have none; repeated rows
    and rows without an id are each judged by their text; without labelled
    rows to learn from no language is found and nothing stays; an empty table
    stays empty."""
    ensure_checkpoint_dir(spark)
    model = langid.train_split(docs.select("doc_id", "text", "lang"))
    rows, _, text = _by_place(docs)
    found = langid.label(rows, model, text_col=text, found=("lang_found", "lang_score", "lang_spans"))
    return _by_name(found.filter("lang_found <> 'und'"), docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays, one with the smallest id.

    NULL counts as empty, and one empty text stays; a row without an id stays
    only if no copy has one; rows with one id and different texts are decided
    each by its text; of rows that share id and text any one stays; an empty
    table stays empty."""
    ensure_checkpoint_dir(spark)
    rows, doc_id, text = _by_place(docs)
    decided = exact_dedup.exact_dedup(rows, exact_dedup.older_half(rows, doc_id), doc_id, text)
    kept = decided.filter("kept").select(F.struct(F.col(doc_id).alias("id"), F.col("text_sha256").alias("sha")).alias("k"))
    digest = F.sha2(exact_dedup.normalised(F.col(text)), 256)
    return _by_name(_one_row_each(rows, F.struct(F.col(doc_id).alias("id"), digest.alias("sha")), kept), docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies one row stays, one with the smallest id.

    Rows are told apart by id and text, so rows with one id and different
    texts are decided each by its fingerprint; rows without an id come last in
    a class; texts without words form one class; of rows that share id and
    text any one stays; an empty table stays empty."""
    ensure_checkpoint_dir(spark)
    rows, doc_id, text = _by_place(docs)
    key = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.xxhash64(text).alias("text"))
    classes = simhash.near_dedup(rows.select(key.alias("k"), text), words=3, max_bits=2, id_col="k", text_col=text)
    return _by_name(_one_row_each(rows, key, classes.filter("k = component_id")), docs)


def secret(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are cut out of the texts and ``n_chars`` is set anew; every row
    stays. NULL texts stay NULL (``n_chars`` too), rows that repeat an id are
    each cut, an empty table stays empty."""
    ensure_checkpoint_dir(spark)
    rows, doc_id, text = _by_place(docs)
    out = _by_name(secrets.redact(rows, id_col=doc_id, text_col=text), docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 1024 tokens along the curve, one row per piece. A NULL or
    empty text is its end token; rows that repeat an id are packed each."""
    ensure_checkpoint_dir(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)


STAGES = [("language_id", language), ("exact_dedup", exact), ("near_dedup", near), ("secrets", secret),
          ("packing", pack)]

#: Language ID and SimHash have no SQL form; the tests hold ``run`` against
#: the plain composition of the operators' brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
