"""Substring dedup with an FM-index per shard.

A window is ``window`` consecutive words of a document; each word covered by a
window whose words also start earlier (smaller id, or same document and an
earlier start) is removed. All windows are judged on the input.

1. Anchors. The smallest hash among the ``GRAM``-word grams of a window is its
   anchor; consecutive windows with the same anchor place make a segment (at
   most 2 * window - GRAM words). Equal windows have equal anchors, so a window
   can recur only if its anchor does: anchors that occur once in the corpus leave.
2. Documents with recurring anchors are written once as compressed words,
   bucketed by document, so that later joins do not shuffle texts again.
3. Segments with recurring anchors are reduced to the distinct ones, each with
   its earliest place (partial aggregates: a passage on a third of all rows is one
   row per task). Only these travel with their words, to the shard of their
   anchor. An anchor with more than ``HOT`` occurrences does not share one
   shard: its windows are segments of their own, dealt by their words.
4. A shard builds a compressed FM-index (``fm_index``) of its segments and
   streams the segments of the documents through it: backward search gives
   matching statistics, and of every interval of length ``window`` the earliest
   place of its suffixes. Segments of other places are copies of an indexed one
   and are wholly covered. Words are compared as words: hashes only pick anchors
   and name segments (128 bits: anchor and content).
5. The intervals go back to the documents, which drop the covered words.

Defined results: NULL and empty texts have no words; texts shorter than a
window keep all words; texts of any length are treated whole; rows that share
an id are one document for the question of what is earlier, and each is cut;
fully repeated rows are alike and none of them is earlier; rows without an id
come last, as one document; an empty table gives an empty result; further
columns are ignored. Ids are integers.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections import defaultdict
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabula.llm.bpe import utf8
from tabula.llm.common import blocks, documents, stash
from tabula.llm.fm_index import FMIndex
from tabula.session import shared_path

GRAM = 6
#: Occurrences from which an anchor's windows are dealt singly, and words per
#: shard: memory bounds of one index (about 150 bytes a word).
HOT, SHARD_WORDS = 10_000, 250_000
NO_ID = (1 << 63) - 1
_EMPTY = zstandard.ZstdCompressor().compress(b"")
_BASE = 0x9E3779B97F4A7C15


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class Texts:
    """The words of a block of texts as one run of bytes, a space after each word.

    ``begin``: first byte of every word (and the end), ``cuts``: first word of
    every text (and the end)."""

    def __init__(self, raw: bytes, offsets: np.ndarray):
        b = np.frombuffer(raw, np.uint8)
        white = (b == 0x20) | ((b >= 0x09) & (b <= 0x0D))
        last = np.zeros(len(b), bool)  # a word ends behind this byte
        last[offsets[1:][offsets[1:] > offsets[:-1]] - 1] = True
        last[:-1] |= white[1:]
        last &= ~white
        ends = np.flatnonzero(last)
        kept = np.flatnonzero(~white)
        place = np.cumsum(last)[kept] - last[kept] + np.arange(len(kept))  # spaces put in so far move a byte
        self.bytes = np.full(len(kept) + len(ends), 0x20, np.uint8)
        self.bytes[place] = b[kept]
        self.raw = self.bytes.tobytes()
        self.begin = np.append(0, place[last[kept]] + 2)
        self.cuts = np.searchsorted(ends, offsets)

    @classmethod
    def of(cls, column: pa.Array) -> "Texts":
        return cls(*utf8(column))

    def part(self, first: int, last: int) -> bytes:
        """Words ``first`` to ``last`` (not included), joined by spaces."""
        return self.raw[self.begin[first]:max(self.begin[first], self.begin[last] - 1)]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def segments(texts: Texts, window: int, gram: int):
    """Segments of several texts: text number, first word, last word + 1, anchor.

    A gram's hash is a polynomial of its bytes, from running sums modulo 2^64;
    the anchor is the hash of its gram, made even."""
    n = len(texts.begin) - 1
    empty = np.zeros(0, np.int64)
    if n < window:
        return empty, empty, empty, empty
    size = len(texts.bytes) + 1
    sums = np.zeros(size, np.uint64)
    np.cumsum(texts.bytes * _powers(_BASE, size)[:-1], out=sums[1:])
    begin = texts.begin
    # the inverse power takes the place of a gram out of its hash
    grams = _mixed((sums[begin[gram:]] - sums[begin[:-gram]]) * _powers(pow(_BASE, -1, 1 << 64), size)[begin[:-gram]])
    # smallest gram of every window, the leftmost of equal ones, by doubling
    span, wide = window - gram + 1, 1
    place = np.arange(len(grams), dtype=np.int64)
    best = grams
    while wide < span:
        step = min(wide, span - wide)
        right = best[step:] < best[:-step]
        place = np.where(right, place[step:], place[:-step])
        best = np.where(right, best[step:], best[:-step])
        wide += step
    cuts = texts.cuts
    end = np.repeat(cuts[1:], np.diff(cuts))
    at = np.arange(n - window + 1)
    at = at[at + window <= end[:len(at)]]
    if not len(at):
        return empty, empty, empty, empty
    place = place[at]
    new = np.ones(len(at), bool)  # windows of two texts never share an anchor place
    new[1:] = place[1:] != place[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    text = np.searchsorted(cuts, at[first], "right") - 1
    anchor = (grams[place[first]] & ~np.uint64(1)).view(np.int64)
    return text, at[first] - cuts[text], at[last] + window - cuts[text], anchor


def _listed(number: np.ndarray, count: int, values: np.ndarray) -> pa.Array:
    """Values of rising owners as one list per owner."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(number, np.arange(count + 1)).astype(np.int32)),
                                    pa.array(values))


def anchors(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """``key`` and ``anchor`` of every segment of every document."""
    def run(batches):
        for block in blocks(batches, "text"):
            text, _, _, anchor = segments(Texts.of(block.column(1)), window, gram)
            yield pa.RecordBatch.from_arrays([block.column(0), _listed(text, block.num_rows, anchor)],
                                             names=["key", "anchors"])

    found = rows.select("key", "text").mapInArrow(run, "key long, anchors array<long>")
    return found.select("key", F.explode("anchors").alias("anchor"))


def packed(rows: DataFrame, kind: str) -> DataFrame:
    """Digest and number of all words, and the words as a zstandard frame."""
    def run(batches):
        packer = zstandard.ZstdCompressor(level=3)
        for block in blocks(batches, "text"):
            texts = Texts.of(block.column(3))
            joined = [texts.part(a, z) for a, z in zip(texts.cuts[:-1], texts.cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [block.column(0), block.column(1), block.column(2), pa.array(np.diff(texts.cuts)),
                 pa.array([hashlib.sha256(j).digest() for j in joined], pa.binary()),
                 pa.array([packer.compress(j) for j in joined], pa.binary())],
                names=["key", "nid", "id", "n_words", "digest", "frame"])

    return rows.select("key", "nid", "id", "text").mapInArrow(
        run, f"key long, nid long, id {kind}, n_words long, digest binary, frame binary")


def bucketed(frame: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """A written table in buckets of ``columns``: joins on them read it without a shuffle."""
    spark = frame.sparkSession
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (frame.write.bucketBy(buckets, *columns).option("path", shared_path(spark, name)).option("compression", "zstd")
     .format("parquet").saveAsTable(table))
    return spark.table(table)


def _unpacked(column: pa.Array) -> Texts:
    unpack = zstandard.ZstdDecompressor()
    texts = [unpack.decompress(f) for f in column.to_pylist()]
    return Texts(b"".join(texts), np.cumsum([0] + [len(t) for t in texts]))


def occurrences(table: DataFrame, window: int, gram: int) -> DataFrame:
    """Every segment whose anchor recurs: anchor (odd if hot), content hash, place, words."""
    def run(batches):
        for block in blocks(batches, "frame", 1 << 20):
            texts = _unpacked(block.column(2))
            text, begin, end, anchor = segments(texts, window, gram)
            asked = block.column(3)
            wanted = np.sort(asked.flatten().to_numpy())
            kept = np.isin(anchor, wanted & ~1)
            text, begin, end, anchor = text[kept], begin[kept], end[kept], anchor[kept]
            hot = np.isin(anchor, wanted[(wanted & 1) == 1] - 1)
            # a hot anchor's segment becomes its windows
            times = np.where(hot, end - begin - window + 1, 1)
            source = np.repeat(np.arange(len(text)), times)
            step = np.arange(len(source)) - np.repeat(np.cumsum(times) - times, times)
            text, begin, hot = text[source], begin[source] + step, hot[source]
            words = np.where(hot, window, (end - begin[np.cumsum(times) - times])[source])
            at = texts.cuts[text] + begin
            names = [xxhash.xxh3_64_intdigest(texts.raw[a:z - 1]) for a, z in zip(texts.begin[at].tolist(), texts.begin[at + words].tolist())]
            text = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [block.column(0).take(text), block.column(1).take(text), pa.array(begin), pa.array(words),
                 pa.array(anchor[source] | hot), pa.array(np.array(names, np.uint64).view(np.int64))],
                names=["key", "nid", "start", "words", "anchor", "content"])

    return table.filter("wanted IS NOT NULL").select("key", "nid", "frame", "wanted").mapInArrow(
        run, "key long, nid long, start long, words long, anchor long, content long")


def with_words(table: DataFrame, earliest: DataFrame, shards: int) -> DataFrame:
    """The distinct segments with their words, and the shard each belongs to."""
    def run(batches):
        for block in blocks(batches, "frame", 1 << 20):
            texts = _unpacked(block.column(0))
            lists = block.column(1)
            source = np.repeat(np.arange(block.num_rows), np.diff(lists.offsets.to_numpy()))
            own = lists.flatten()
            dealt, start, words = (own.field(c).to_numpy() for c in ("dealt", "start", "words"))
            dealt = _mixed(dealt.view(np.uint64)) % np.uint64(shards)
            at = texts.cuts[source] + start
            parts = [texts.raw[a:z - 1].decode() for a, z in
                     zip(texts.begin[at].tolist(), texts.begin[at + words].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(dealt.astype(np.int32)), own.field("anchor"), own.field("content"),
                 block.column(2).take(pa.array(source)), own.field("start"), pa.array(parts, pa.string())],
                names=["shard", "anchor", "content", "nid", "start", "text"])

    listed = earliest.groupBy("key", "nid").agg(F.collect_list(F.struct("anchor", "content", "dealt", "start", "words")).alias("own"))
    joined = table.filter("wanted IS NOT NULL").select("key", "nid", "frame").join(listed, ["key", "nid"])
    return joined.select("frame", "own", "nid").mapInArrow(
        run, "shard int, anchor long, content long, nid long, start long, text string")


def covered(texts: list[str], nid: np.ndarray, start: np.ndarray, window: int) -> np.ndarray:
    """For every distinct segment, the windows (as bits) that start earlier elsewhere."""
    pieces = [t.encode().split(b" ") for t in texts]
    cuts = np.cumsum([0] + [len(p) for p in pieces])
    number = defaultdict()
    number.default_factory = lambda: len(number) + 1
    words = np.fromiter(map(number.__getitem__, chain.from_iterable(pieces)), np.int64, int(cuts[-1]))
    index = FMIndex(words, cuts, len(number) + 1, window)
    length, where = index.matching_statistics(words, cuts)
    # earliest place among the suffixes of every interval of `window` words
    border = index.borders[window]
    group = np.repeat(np.arange(len(border) - 1), np.diff(border))
    several = np.flatnonzero(np.diff(border)[group] > 1)
    at = index.order[several]
    piece = np.searchsorted(cuts[1:] + np.arange(len(pieces)), at, "left")
    offset = at - cuts[piece] - piece
    owner, place = nid[piece], start[piece] + offset
    first = np.lexsort((place, owner, group[several]))
    first = first[np.append(True, np.diff(group[several][first]) > 0)] if len(first) else first
    early_nid, early_place = np.full(len(border) - 1, NO_ID), np.full(len(border) - 1, NO_ID)
    early_nid[group[several][first]], early_place[group[several][first]] = owner[first], place[first]
    found = np.flatnonzero(length == window)
    stream = np.searchsorted(cuts, found, "right") - 1
    offset = found - cuts[stream]
    g = group[where[found]]
    own = start[stream] + offset
    earlier = (early_nid[g] < nid[stream]) | ((early_nid[g] == nid[stream]) & (early_place[g] < own))
    bits = np.zeros(len(pieces), np.int64)
    np.bitwise_or.at(bits, stream[earlier], np.int64(1) << offset[earlier])
    return bits


def indexed(dealt: DataFrame, window: int) -> DataFrame:
    """Windows of each distinct segment that its shard's index finds earlier."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        bits = covered(list(pdf["text"]), pdf["nid"].to_numpy(), pdf["start"].to_numpy(), window)
        out = pdf[["anchor", "content"]].assign(bits=bits)
        return out[bits != 0]

    return dealt.groupBy("shard").applyInPandas(run, "anchor long, content long, bits long")


def find_repeats(docs: DataFrame, window: int = 20, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text",
                 hot: int = HOT, shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per document: id, ``n_words``, ``n_removed``, ``spans`` (removed
    stretches of words: start and length) and ``kept_sha256``."""
    if not gram <= window <= gram + 62:
        raise ValueError("a segment's windows are counted in 63 bits")
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("nid"),
                       F.xxhash64(F.col(id_col), F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
    pairs = anchors(rows, window, gram)
    # written, so that the join below has a plain shuffle on both sides, which AQE splits at a hot anchor
    often = stash(pairs.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1")
                  .select("anchor", (F.col("n") > hot).cast("long").alias("hot")), "recurring")
    wanted = (pairs.join(often, "anchor").select("key", F.col("anchor").bitwiseOR(F.col("hot")).alias("anchor"))
              .groupBy("key").agg(F.collect_set("anchor").alias("wanted")))
    # words stay only where an anchor recurs; the other documents are decided
    texts = packed(rows, kind).join(wanted, "key", "left").withColumn("frame", F.when(F.col("wanted").isNotNull(), F.col("frame")))
    table = bucketed(texts, "words", ["key", "nid"])

    found = stash(occurrences(table, window, gram), "segments")
    first = F.min(F.struct("nid", "start", "key", "words")).alias("first")
    dealt = F.when(F.col("anchor") % 2 == 0, F.col("anchor")).otherwise(F.col("content")).alias("dealt")
    distinct = found.groupBy("anchor", "content").agg(first).select("anchor", "content", dealt, "first.*")
    # at most `hot` rows of one anchor in a group
    earliest = stash(distinct.withColumn("rivals", F.count("*").over(Window.partitionBy("dealt")) - 1), "distinct")
    asked = earliest.filter("rivals > 0")
    total = asked.agg(F.sum("words").alias("n")).first()["n"] or 0
    dealt = with_words(table, asked, max(1, math.ceil(total / shard_words)))
    bits = indexed(dealt, window)

    # written like the recurring anchors: a segment on many rows is split in the join below
    places = stash(earliest.select("anchor", "content", F.col("nid").alias("first_nid"), F.col("start").alias("first_start"))
                   .join(bits, ["anchor", "content"], "left"), "places")
    own = (F.col("nid") == F.col("first_nid")) & (F.col("start") == F.col("first_start"))
    every = F.expr(f"shiftleft(1L, CAST(words - {window - 1} AS INT)) - 1")
    hits = (found.join(places, ["anchor", "content"])
            .select("key", "nid", "start", F.when(own, F.col("bits")).otherwise(every).alias("bits"))
            .filter("bits <> 0").groupBy("key", "nid").agg(F.collect_set(F.struct("start", "bits")).alias("hits")))
    return cut(table.join(hits, ["key", "nid"], "left"), window, kind).withColumnRenamed("id", id_col)


def cut(joined: DataFrame, window: int, kind: str) -> DataFrame:
    """Drop the covered words of every document."""
    def run(batches):
        for block in blocks(batches, "frame", 1 << 20):
            texts = _unpacked(block.column(3).fill_null(_EMPTY))
            lists = block.column(4).fill_null([])
            hits = lists.flatten()
            doc = np.repeat(np.arange(block.num_rows), np.diff(lists.offsets.to_numpy()))
            start, bits = (hits.field(c).to_numpy() for c in ("start", "bits"))
            step = np.zeros(int(texts.cuts[-1]) + 1, np.int64)
            for t in range(int(bits.max(initial=0)).bit_length()):
                at = (texts.cuts[doc] + start)[bits >> t & 1 == 1] + t
                np.add.at(step, at, 1)
                np.add.at(step, at + window, -1)
            gone = np.cumsum(step[:-1]) > 0
            digests = [d.hex() for d in block.column(2).to_pylist()]
            removed, spans = [0] * block.num_rows, [[]] * block.num_rows
            for d in np.unique(doc).tolist():
                a, z = int(texts.cuts[d]), int(texts.cuts[d + 1])
                own = gone[a:z]
                border = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8)))
                spans[d] = [{"start": i, "length": j - i} for i, j in zip(border[::2].tolist(), border[1::2].tolist())]
                removed[d] = int(own.sum())
                inner = np.append(0, border)
                kept = [texts.part(a + i, a + j) for i, j in zip(inner[::2].tolist(), np.append(inner[1:], z - a)[::2].tolist())]
                digests[d] = hashlib.sha256(b" ".join(k for k in kept if k)).hexdigest()
            span = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [block.column(0), block.column(1), pa.array(removed, pa.int64()), pa.array(digests, pa.string()),
                 pa.array(spans, span)], names=["id", "n_words", "n_removed", "kept_sha256", "spans"])

    return joined.select("id", "n_words", "digest", "frame", "hits").mapInArrow(
        run, f"id {kind}, n_words long, n_removed long, kept_sha256 string, spans array<struct<start: long, length: long>>")


def op13(spark, sf_dir: str) -> DataFrame:
    return find_repeats(documents(spark, sf_dir)).drop("spans")
