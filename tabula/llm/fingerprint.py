"""SimHash fingerprints of word shingles (whole texts, inside Arrow batches)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_UP = bytes(range(65, 91))
_LOWER = bytes.maketrans(_UP, _UP.lower())
#: Hashes summed at once, a memory bound for very long texts.
CHUNK = 1 << 15


def shingle_hashes(text: str, words: int, seed: int = 42) -> np.ndarray:
    """XXH64 of every shingle (repeats included); the whole sequence if the
    text has fewer words; none without words."""
    parts = text.encode().translate(_LOWER).split()  # bytes split at 0x20 and 0x09-0x0D
    if not parts:
        return np.zeros(0, np.uint64)
    joined = b" ".join(parts)
    if len(parts) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    ends = np.cumsum([len(p) + 1 for p in parts])
    starts = (ends - [len(p) + 1 for p in parts])[:len(parts) - words + 1].tolist()
    h = xxhash.xxh64_intdigest
    return np.array([h(joined[a:b], seed) for a, b in zip(starts, (ends[words - 1:] - 1).tolist())], np.uint64)


def simhash(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes."""
    if not len(hashes):
        return 0
    sums = np.zeros(64, np.int64)
    for i in range(0, len(hashes), CHUNK):
        part = hashes[i:i + CHUNK].astype(">u8").view(np.uint8).reshape(-1, 8)
        sums += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * sums > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``fp`` (the 64 bits as a signed long) of every row."""
    def run(batches):
        for batch in batches:
            out = [simhash(shingle_hashes(t or "", words)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(out, np.uint64).view(np.int64))], names=["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"id {kind}, fp long"))
