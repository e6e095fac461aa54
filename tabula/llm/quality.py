"""Quality rules: word, symbol and repetition counts, and compression bands.

A text that passes the base rules is judged by zstandard ratios (bytes before
over bytes after), once over the whole text and once over chunks of
``CHUNK`` bytes. Text that packs too well is repetitive, text that hardly
packs is noise. What is usual depends on the length, since a longer text
offers more to refer back to, so the limits go by length band; a chunk is
judged by the band of its own size. Below 256 bytes there is no low limit, as
prose of 100 bytes packs no better than base64. The low limits stop base64 and
random letters and digits (below 448 bytes not all of them); words of random hex
digits and, below 4096 bytes, of random lower-case letters pack like dense prose
(1.5-2.0) and are not told apart.

Defined results: NULL and empty texts have no words, fail the base rules and
are not kept; texts of any length are read whole; rows with repeated ids are
each judged by their own text; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.llm.common import documents

#: Bytes from which a band holds, lowest ratio, lowest ratio of
#: text in Han, kana or Hangul (few bytes repeat there), highest ratio. The low
#: limits lie at about the first hundredth of ordinary text cut to that length
#: (program messages in over 30 languages; Chinese is the densest), and from 448
#: bytes on above base64 and random letters and digits of that length.
BANDS = ((0, 0.0, 0.0, 2.5), (256, 1.1, 1.0, 3.0), (384, 1.18, 1.08, 3.0), (448, 1.25, 1.1, 3.0),
         (512, 1.27, 1.15, 3.0), (640, 1.33, 1.2, 3.0), (1024, 1.45, 1.33, 3.5), (2048, 1.6, 1.5, 3.5),
         (4096, 1.72, 1.65, 4.0), (16384, 1.8, 1.8, 4.5))
#: First bytes of the three-byte characters from U+3000 to U+DFFF.
DENSE = bytes(range(0xE3, 0xEE))
LEVEL = 3
CHUNK = 4096
#: Chunks below this many bytes say nothing and are not judged.
LEAST_CHUNK = 256
#: Share of the judged bytes that may lie in chunks out of their band.
BAD_SHARE = 0.25
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"


def repeat_words(parts: list[bytes], window: int = 8) -> int:
    """Words inside ``window``-word windows that occur twice or more. Windows
    are numbered exactly, by pairing the numbers of windows half as long."""
    n = len(parts)
    if n <= window:
        return 0
    table: dict[bytes, int] = {}
    ids = np.fromiter((table.setdefault(w, len(table)) for w in parts), np.int64, n)
    if len(table) == n:
        return 0
    size = 1
    while size < window:
        step = min(size, window - size)
        pair = ids[:-step] * (int(ids.max()) + 1) + ids[step:]
        _, ids = np.unique(pair, return_inverse=True)
        size += step
    often = np.bincount(ids)[ids] > 1
    cover = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(often)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + window, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def dup_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return len(lines) - len(set(lines))


def in_band(data: bytes, packer: zstandard.ZstdCompressor) -> bool:
    size = len(data)
    low, dense_low, high = next(limits for start, *limits in reversed(BANDS) if size >= start)
    # a third of the bytes or more in such characters
    if not data.isascii() and 9 * (size - len(data.translate(None, DENSE))) >= size:
        low = dense_low
    return low <= size / len(packer.compress(data)) <= high


def bands_pass(data: bytes, packer: zstandard.ZstdCompressor) -> bool:
    if not data or not in_band(data, packer):
        return False
    judged = bad = 0
    for i in range(0, len(data), CHUNK):
        part = data[i:i + CHUNK]
        if len(part) >= LEAST_CHUNK:
            judged += len(part)
            if not in_band(part, packer):
                bad += len(part)
    return bad <= BAD_SHARE * judged


SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean")


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, the counts, ``base_failed`` and ``kept``."""
    def run(batches):
        packer = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                text = text or ""
                data = text.encode()
                parts = data.split()  # at 0x20 and 0x09-0x0D
                n = len(parts)
                repeats = repeat_words(parts)
                failed = n < 20 or 100 * repeats > 30 * n
                out.append((n, len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
                            dup_lines(text), repeats, failed, not failed and bands_pass(data, packer)))
            columns = list(zip(*out)) or [[]] * 7
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=["id", *(x.split()[0] for x in SCHEMA.split(", "))])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"id {kind}, {SCHEMA}").withColumnRenamed("id", id_col))


def op5(spark, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir))
