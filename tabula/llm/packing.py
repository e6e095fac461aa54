"""Packing along a space-filling curve.

Every document is tokenised and ended by ``end_id``. Its hashed bag of tokens
(256 signed buckets, unit length) is projected to four dimensions by a fixed
random matrix; the quantised point gives a Hilbert key. Documents are sorted
by key over range slices, token counts are summed along that order, and the
curve is cut every ``seq_len`` tokens: neighbours share sequences, every
sequence but the last is full, and only that one is padded.

The token ids are written once (compressed, in input order) and travel once,
joined with their places; the sort moves only keys and counts. Slice sums
(one row per slice) are all that reaches the driver. Documents with equal
keys, such as copies, are spread over slices by their row number.

Tokens: distinct pretokens (``bpe.pretokens``) go to the tokenizers library;
a text that holds a special token's string is encoded whole by the library.

Defined results: NULL text counts as empty and is just ``end_id``; rows that
repeat an id are packed each, as documents of their own; texts of any length
are cut at sequence borders; an empty table gives no pieces; further columns
are ignored.
"""

from __future__ import annotations

import functools
import math
import os
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabula.llm.bpe import KEEP, Words, distinct_words, pretokens, utf8
from tabula.llm.common import blocks, documents, stash

HASHED, DIMS, BITS, SEED = 256, 4, 10, 42
BLOCK_BYTES = 8 << 20
#: Pretokens that the library gets as one text.
RUN = 16
#: Documents per slice of the sort, a memory bound of one sort task (~40 MB).
SLICE_ROWS = 1_000_000


class Library:
    """A tokenizers file, asked once per distinct pretoken."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(path)
        added = self.own.get_added_tokens_decoder().values()
        self.special = [t.content.encode() for t in added]
        line = self.own.encode("a\nb", add_special_tokens=False).ids
        self.line = line[1] if len(line) == 3 else None
        self.kept: dict[bytes, int] = {}
        self.store = Words(np.zeros(0, np.int32), np.zeros(1, np.int64))

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.own.encode_batch_fast(texts, add_special_tokens=False)]

    def words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pretokens one after another, and how many each has.

        Many pretokens go to the library as one text, a line feed after each:
        it is a pretoken and an id of its own there, and no other pretoken
        holds one. Pretokens of white space are asked one by one.
        """
        texts = [w.decode() for w in words]
        alone = np.fromiter(map(str.isspace, texts), bool, len(texts))
        if self.line is None:
            alone[:] = True
        joined = [t for t, a in zip(texts, alone.tolist()) if not a]
        runs = ["\n".join(joined[i:i + RUN]) + "\n" for i in range(0, len(joined), RUN)]
        flat = np.concatenate([np.array(x, np.int32) for x in self.ids(runs)] or [np.zeros(0, np.int32)])
        ends = flat == self.line
        size = np.zeros(len(texts), np.int64)
        size[~alone] = np.diff(np.append(-1, np.flatnonzero(ends))) - 1
        own = self.ids([texts[i] for i in np.flatnonzero(alone)])
        size[alone] = [len(x) for x in own]
        out = np.empty(int(size.sum()), np.int32)
        which = np.repeat(alone, size)
        out[~which] = flat[~ends]
        out[which] = [i for x in own for i in x]
        return out, size

    def lookup(self, words: list[bytes]) -> tuple[Words, np.ndarray]:
        if len(self.kept) > KEEP:
            self.kept, self.store = {}, Words(np.zeros(0, np.int32), np.zeros(1, np.int64))
        kept = self.kept
        new = [w for w in words if w not in kept]
        if new:
            flat, size = self.words(new)
            n = len(kept)
            kept.update(zip(new, range(n, n + len(new))))
            self.store = Words(np.append(self.store.ids, flat),
                               np.append(self.store.offsets, self.store.offsets[-1] + np.cumsum(size)))
        return self.store, np.fromiter(map(kept.__getitem__, words), np.int64, len(words))

    def encode_block(self, column) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the n+1 offsets."""
        raw, at = utf8(column)
        starts = pretokens(raw, at)
        words, index = distinct_words(raw, starts)
        store, number = self.lookup(words)
        ids, lengths = store.expand(number[index])
        cuts = np.append(0, np.cumsum(lengths))[np.searchsorted(starts, at)] if len(words) else np.zeros_like(at)
        if any(s in raw for s in self.special):
            parts = np.split(ids, cuts[1:-1])
            for d in range(len(at) - 1):
                own = raw[at[d]:at[d + 1]]
                if any(s in own for s in self.special):
                    parts[d] = np.array(self.ids([own.decode()])[0], np.int32)
            ids = np.concatenate(parts)
            cuts = np.append(0, np.cumsum([len(p) for p in parts]))
        return ids, cuts


@functools.lru_cache(maxsize=2)
def load_library(path: str) -> Library:
    """Kept once per Python worker."""
    return Library(path)


def hilbert_key(points: np.ndarray, bits: int) -> np.ndarray:
    """Place of integer points (n, dims) along the Hilbert curve.

    Inverse undo of the reflections and exchanges bit plane by bit plane, then
    Gray coding (the transposed form of the published algorithm)."""
    x = points.astype(np.int64).copy()
    n, dims = x.shape
    for level in range(bits - 1, 0, -1):
        q, low = 1 << level, (1 << level) - 1
        for i in range(dims):
            flip = (x[:, i] & q) != 0
            swap = np.where(flip, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(flip, low, swap)
            x[:, i] ^= swap
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    t = np.zeros(n, np.int64)
    for level in range(bits - 1, 0, -1):
        t ^= np.where(x[:, dims - 1] & (1 << level), (1 << level) - 1, 0)
    x ^= t[:, None]
    key = np.zeros(n, np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[:, i] >> level) & 1)
    return key


@functools.lru_cache(maxsize=1)
def _projection() -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((HASHED, DIMS))


def curve_keys(ids: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Hilbert key of every document's hashed, projected bag of tokens."""
    n = len(cuts) - 1
    mixed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
    bucket, sign = (mixed & np.uint64(HASHED - 1)).astype(np.int64), 1.0 - 2.0 * ((mixed >> np.uint64(20)) & np.uint64(1))
    owner = np.repeat(np.arange(n), np.diff(cuts))
    vectors = np.bincount(owner * HASHED + bucket, weights=sign, minlength=n * HASHED).reshape(n, HASHED)
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    flat = (vectors / np.where(norm > 0, norm, 1)) @ _projection()
    # about normal with unit variance; the logistic curve spreads it evenly
    cells = np.floor((1 << BITS) / (1 + np.exp(-1.702 * flat))).astype(np.int64)
    return hilbert_key(np.clip(cells, 0, (1 << BITS) - 1), BITS)


def tokenise(docs: DataFrame, tokenizer: str, end_id: int = 0, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """A written table: row number, id, ``n`` tokens, curve ``key`` and the
    ids (little-endian unsigned 32 bit, a zstandard frame)."""
    def run(batches):
        library, packer = load_library(tokenizer), zstandard.ZstdCompressor(level=1)
        row = TaskContext.get().partitionId() << 33
        for block in blocks(batches, "text", BLOCK_BYTES):
            ids, cuts = library.encode_block(block.column(1))
            keys = curve_keys(ids, cuts)
            flat = ids.astype("<u4")
            frames = [packer.compress(np.append(flat[a:b], np.uint32(end_id)).astype("<u4").tobytes())
                      for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + block.num_rows)), block.column(0), pa.array(np.diff(cuts) + 1),
                 pa.array(keys), pa.array(frames, pa.binary())], names=["row", "id", "n", "key", "frame"])
            row += block.num_rows

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return stash(rows.mapInArrow(run, f"row long, id {kind}, n long, key long, frame binary"), "token-ids")


def place(tokens: DataFrame) -> DataFrame:
    """``row`` and ``begin``: tokens before it along the curve."""
    spark = tokens.sparkSession
    narrow = tokens.select("row", "id", "n", "key")
    slices = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(narrow.count() / SLICE_ROWS))
    order = ["key", "id", "row"]
    # written, so that later passes see the same slices
    ranged = stash(narrow.repartitionByRange(slices, *order).withColumn("slice", F.spark_partition_id()), "curve-order")
    sums = sorted((r["slice"], r["n"]) for r in ranged.groupBy("slice").agg(F.sum("n").alias("n")).collect())
    before, total = [], 0
    for s, n in sums:
        before.append((s, total))
        total += n
    # one row per slice
    offsets = spark.createDataFrame(before, "slice int, before long")
    run = Window.partitionBy("slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (ranged.withColumn("upto", F.sum("n").over(run)).join(F.broadcast(offsets), "slice")
            .select("row", (F.col("before") + F.col("upto") - F.col("n")).alias("begin")))


def pack(docs: DataFrame, tokenizer: str, seq_len: int = 1024, end_id: int = 0, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per piece: id, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset`` and, if asked for, ``ids``."""
    tokens = tokenise(docs, tokenizer, end_id, id_col, text_col)
    placed = tokens.select("row", "id", "frame").join(place(tokens), "row").select("id", "frame", "begin")
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids

    def cut(batches):
        unpack = zstandard.ZstdDecompressor()
        for block in blocks(batches, "frame", 1 << 20):
            out, source = [], []
            for d, (frame, begin) in enumerate(zip(block.column(1).to_pylist(), block.column(2).to_pylist())):
                ids = np.frombuffer(unpack.decompress(frame), "<u4")
                start = 0
                while start < len(ids):
                    at = begin + start
                    end = min(len(ids), start + seq_len - at % seq_len)
                    piece = ids[start:end]
                    source.append(d)
                    out.append((start, end - start, zlib.crc32(piece.tobytes()), len(ids), at // seq_len, at % seq_len,
                                piece.astype(np.int32) if with_ids else None))
                    start = end
            columns = list(zip(*out))
            arrays = [block.column(0).take(pa.array(source, pa.int64()))] + \
                [pa.array(c, pa.int64()) for c in columns[:6]] + [pa.array(list(columns[6]), pa.list_(pa.int32()))] * with_ids
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = (f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
              + ", ids array<int>" * with_ids)
    return placed.mapInArrow(cut, schema).withColumnRenamed("id", id_col)


def op3(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)
