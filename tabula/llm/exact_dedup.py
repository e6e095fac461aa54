"""Exact dedup through a minimal perfect hash over historical digests.

Every text is normalised and reduced to its SHA-256. The distinct digests of
the historical rows are cut into shards by digest, and for each shard a
minimal perfect hash is built: bit vectors, level by level, in which a key
owns the place that no other key of its level hashes to; the rank of that bit
is its slot. Slots hold the full digest and the locator (smallest id) of the
text. New digests are looked up shard by shard; a lookup counts only if all
32 bytes in the slot agree. New digests that are not members were grouped by
digest before and keep their own smallest id.

Hot texts are one row per task before any shuffle (partial aggregation), so a
shard never holds more than its distinct digests.

Defined results: NULL text counts as empty; an empty text is a text like any
other; rows that repeat an id belong to one document and stay or go together;
rows without an id stay only if no copy has one; an empty table or an empty
history gives an empty result or no members; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabula.llm.common import WS, documents, stash

#: Distinct digests per shard, a memory bound of one lookup task (~4 MB).
SHARD_KEYS = 20_000
LEVELS = 48


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WS, " ")


def _halves(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words = digests.view("<u8").reshape(len(digests), 4)
    return words[:, 1], words[:, 2] | np.uint64(1)


def _places(k1, k2, level: int, size: int) -> np.ndarray:
    x = k1 + np.uint64(level + 1) * k2
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return ((x ^ (x >> np.uint64(29))) % np.uint64(size)).astype(np.int64)


def build_mph(digests: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Level sizes, their bits, and the slot of every (distinct) digest."""
    n = len(digests)
    k1, k2 = _halves(digests)
    slot, open_ = np.full(n, -1, np.int64), np.arange(n)
    sizes, bits, taken = [], [], 0
    while len(open_) and len(sizes) < LEVELS:
        size = len(open_) + len(open_) // 2 + 1
        at = _places(k1[open_], k2[open_], len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        own = alone[at]
        rank = np.cumsum(alone) - 1
        slot[open_[own]] = taken + rank[at[own]]
        taken += int(alone.sum())
        sizes.append(size)
        bits.append(alone)
        open_ = open_[~own]
    # Keys left after all levels agree in 16 digest bytes; they take the last
    # slots, which a lookup reads through.
    slot[open_] = taken + np.arange(len(open_))
    return sizes, np.concatenate(bits) if bits else np.zeros(0, bool), slot


def find_slots(digests: np.ndarray, sizes, bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Slot of every digest whose bytes stand there, -1 for nonmembers."""
    found = np.full(len(digests), -1, np.int64)
    if not len(slots) or not len(digests):
        return found
    k1, k2 = _halves(digests)
    rank = np.cumsum(bits) - 1
    open_, base = np.arange(len(digests)), 0
    for level, size in enumerate(sizes):
        at = base + _places(k1[open_], k2[open_], level, int(size))
        hit = bits[at]
        found[open_[hit]] = rank[at[hit]]
        open_, base = open_[~hit], base + int(size)
    taken = int(bits.sum())
    for s in range(taken, len(slots)):
        found[open_[(digests[open_] == slots[s]).all(axis=1)]] = s
    member = found >= 0
    member[member] = (slots[found[member]] == digests[member]).all(axis=1)
    return np.where(member, found, -1)


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(map(bytes, column)), np.uint8).reshape(-1, 32).copy()


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """One row per shard: the hash function and its slots, as a written table.

    ``history``: distinct ``digest``, ``locator`` (as text) and ``copies``.
    """

    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        digests = _matrix(pdf["digest"])
        sizes, bits, slot = build_mph(digests)
        order = np.argsort(slot)
        return pd.DataFrame({"shard": [key[0]], "sizes": [sizes], "bits": [np.packbits(bits).tobytes()],
                             "slots": [digests[order].tobytes()],
                             "locators": [pdf["locator"].to_numpy(object)[order]],
                             "copies": [pdf["copies"].to_numpy()[order]]})

    return stash(history.withColumn("shard", shard_of("digest", shards)).groupBy("shard").applyInPandas(
        build, "shard int, sizes array<long>, bits binary, slots binary, locators array<string>, "
               "copies array<long>"), "digest-index")


def shard_of(column: str, shards: int) -> Column:
    first = F.conv(F.substring(F.hex(column), 1, 8), 16, 10).cast("long")
    return (first % F.lit(shards)).cast("int")


def look_up(index: DataFrame, fresh: DataFrame, shards: int) -> DataFrame:
    """Winner and number of copies of every digest, of the index or fresh."""
    def probe(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if len(left):
            row = left.iloc[0]
            slots = np.frombuffer(row["slots"], np.uint8).reshape(-1, 32)
            total = int(np.sum(row["sizes"]))
            bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8))[:total].astype(bool)
            locators, copies = np.array(row["locators"], object), np.array(row["copies"], np.int64)
            sizes = row["sizes"]
        else:
            slots, bits, sizes = np.zeros((0, 32), np.uint8), np.zeros(0, bool), []
            locators, copies = np.zeros(0, object), np.zeros(0, np.int64)
        asked = _matrix(right["digest"])
        found = find_slots(asked, sizes, bits, slots)
        member = found >= 0
        extra = right["copies"].to_numpy()
        np.add.at(copies, found[member], extra[member])
        for s, new in zip(found[member], right["locator"][member]):
            if locators[s] is None:  # no copy in the history has an id
                locators[s] = new
        alone = right[~member]
        return pd.DataFrame({"digest": [s.tobytes() for s in slots] + list(alone["digest"]),
                             "keep_id": list(locators) + list(alone["locator"].to_numpy(object)),
                             "group_size": list(copies) + list(alone["copies"])},
                            columns=["digest", "keep_id", "group_size"])

    asked = fresh.withColumn("shard", shard_of("digest", shards))
    return index.groupBy("shard").cogroup(asked.groupBy("shard")).applyInPandas(
        probe, "digest binary, keep_id string, group_size long")


def exact_dedup(docs: DataFrame, historical: Column, id_col: str = "doc_id",
                text_col: str = "text", shard_keys: int = SHARD_KEYS) -> DataFrame:
    """One row per document: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    ``historical`` marks the rows that the index is built from. Their ids must
    be the smaller ones for the smallest id of a text to win (a locator of the
    history wins over any new copy).
    """
    keyed = stash(docs.select(F.col(id_col).alias("id"), F.coalesce(historical, F.lit(False)).alias("old"),
                              F.unhex(F.sha2(normalised(F.col(text_col)), 256)).alias("digest")), "digests")
    kind = keyed.schema["id"].dataType
    distinct = keyed.groupBy("old", "digest").agg(F.min("id").cast("string").alias("locator"),
                                                  F.count("*").alias("copies"))
    sizes = {r["old"]: r["n"] for r in distinct.groupBy("old").agg(F.count("*").alias("n")).collect()}
    shards = max(1, math.ceil(max(sizes.values(), default=0) / shard_keys))
    index = build_index(distinct.filter("old").drop("old"), shards)
    decided = look_up(index, distinct.filter("NOT old").drop("old"), shards)
    return (keyed.join(decided.withColumn("keep_id", F.col("keep_id").cast(kind)), "digest")
            .select(F.col("id").alias(id_col), "keep_id", "group_size",
                    F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))


def older_half(docs: DataFrame, id_col: str = "doc_id") -> Column:
    """Rows up to the middle of the id range; rows without id count as new."""
    ends = docs.agg(F.min(id_col).alias("a"), F.max(id_col).alias("b")).first()
    if ends["a"] is None:
        return F.lit(False)
    return F.coalesce(F.col(id_col) <= (ends["a"] + ends["b"]) // 2, F.lit(False))


def op2(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return exact_dedup(docs, older_half(docs))


OP2_SQL = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
           FROM documents),
g AS (SELECT *, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size FROM t
      WINDOW w AS (PARTITION BY text_sha256))
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""
