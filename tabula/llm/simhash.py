"""SimHash near-dedup by multi-index hashing.

Distinct fingerprints are cut into ``max_bits + 2`` segments. Two fingerprints
within ``max_bits`` agree in at least two segments, and at least one further
segment differs in at most one bit. Each index (two exact segments, one ball
segment) keys the table by those three segments; a probe enumerates the
Hamming ball of radius 1 in the ball segment. Of a pair that differs there,
the side with the zero bit reaches the other by setting it, so only zero bits
are flipped. Table matches are fetched by an equi-join and every match's whole
distance is verified. ``indexes`` picks the indexes so that every way to
spread the differing bits is covered: the links are exact.

Copies meet first: the join works on distinct fingerprints, and each document
gets its class by a join that Spark can split. Classes are connected
components by alternating large-star and small-star steps, which only
aggregate minima; each round is written to the shared folder.

Defined results: a NULL text counts as empty; texts without words have
fingerprint zero and link like any other; rows with a repeated id are in one
class if their fingerprints are; a class of rows without ids has a NULL
component; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.llm.common import documents, stash
from tabula.llm.fingerprint import fingerprints

BITS = 64


def segments(count: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each segment."""
    cuts = [BITS * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def indexes(max_bits: int) -> list[tuple[tuple[int, int], int]]:
    """(two exact segments, ball segment) for each index, so that every way
    to spread up to ``max_bits`` differing bits over the segments is found."""
    m = max_bits + 2
    spreads = {s for s in itertools.product(range(max_bits + 1), repeat=m) if sum(s) <= max_bits}
    options = [(e, b) for e in itertools.combinations(range(m), 2) for b in range(m) if b not in e]
    chosen = []
    while spreads:
        covered = lambda o: {s for s in spreads if s[o[0][0]] == s[o[0][1]] == 0 and s[o[1]] <= 1}
        best = max(options, key=lambda o: len(covered(o)))
        spreads -= covered(best)
        chosen.append(best)
    return chosen


def _keys(fps: np.ndarray, number: int, index, segs) -> np.ndarray:
    """Table keys: the three segments and the index number, mixed to 64 bits
    (equal keys of different segments are told apart by the verification)."""
    key = np.full(len(fps), number, np.uint64)
    for s in (*index[0], index[1]):
        low, width = segs[s]
        part = (fps >> np.uint64(low)) & np.uint64((1 << width) - 1)
        key = (key << np.uint64(width)) | part if 3 * max(w for _, w in segs) <= 58 else \
            (key ^ part) * np.uint64(0x9E3779B97F4A7C15)
    return key


def _rows(fps: DataFrame, max_bits: int, probe: bool) -> DataFrame:
    segs, chosen = segments(max_bits + 2), indexes(max_bits)

    def run(batches):
        for batch in batches:
            own = batch.column(0).to_numpy().view(np.uint64)
            for n, index in enumerate(chosen):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_keys(own, n, index, segs).view(np.int64)), batch.column(0)], names=["key", "fp"])
                low, width = segs[index[1]]
                for bit in range(low, low + width) if probe else ():
                    zero = (own >> np.uint64(bit)) & np.uint64(1) == 0
                    at = own[zero]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(_keys(at | np.uint64(1 << bit), n, index, segs).view(np.int64)),
                         pa.array(at.view(np.int64))], names=["key", "fp"])

    return fps.select("fp").mapInArrow(run, "key long, fp long")


def links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Distinct pairs ``a < b`` of the (distinct, written) fingerprints ``fp``
    that differ in 1 to ``max_bits`` bits."""
    if max_bits < 1:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    table = _rows(fps, max_bits, False).withColumnRenamed("fp", "t")
    probes = _rows(fps, max_bits, True).withColumnRenamed("fp", "p")
    return (probes.join(table, "key")
            .filter((F.col("p") != F.col("t")) & (F.bit_count(F.col("p").bitwiseXOR(F.col("t"))) <= max_bits))
            .select(F.least("p", "t").alias("a"), F.greatest("p", "t").alias("b")).distinct())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) for every node of
    the undirected ``edges`` (a, b)."""
    pairs = stash(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .distinct(), "links")
    before = None
    while True:
        # large star: every larger neighbour of u points to u's smallest neighbour
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = stash(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .filter("u <> v").distinct(), "large-star")
        # small star: u and its smaller neighbours point to the smallest
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = stash(large.join(least, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(
            F.col("u").alias("v"), "m"))).alias("x")).select(F.col("x.v").alias("u"), F.col("x.m").alias("v"))
            .filter("u <> v").distinct(), "small-star")
        mark = pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if mark == before:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = mark


def near_dedup(docs: DataFrame, words: int = 3, max_bits: int = 2,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hex digits) and
    ``component_id``, the smallest id of its class."""
    marked = stash(fingerprints(docs, words, id_col, text_col), "fingerprints")
    distinct = stash(marked.groupBy("fp").agg(F.min("id").alias("first")), "distinct-fingerprints")
    found = components(links(distinct, max_bits))
    # smallest id per class, then per fingerprint that has links
    linked = found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())
    roots = distinct.join(linked, distinct["fp"] == linked["node"])
    least = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = roots.join(least, "root").select("fp", "component_id")
    # written, so that the last join stands alone and Spark can split a hot fingerprint
    every = stash(distinct.join(classes, "fp", "left").select(
        "fp", F.coalesce("component_id", "first").alias("component_id")), "classes")
    return marked.join(every, "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op1(spark, sf_dir: str) -> DataFrame:
    return near_dedup(documents(spark, sf_dir), words=3, max_bits=2)
