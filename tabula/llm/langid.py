"""Language identification of whole and mixed-language texts.

Words are runs of letters. The script of a word (code point ranges) narrows
the candidates to the languages whose training text uses that script; each
candidate scores the word by its byte trigrams. A Viterbi pass over the words
of a text, with a penalty for every change of language, labels its spans; the
language with the most letters is the text's language and its share of all
letters the score.

Training counts every labelled training text: trigram and script counts per
language, summed in Spark. What reaches the driver is one number per language
and bucket (languages x (2^16 + scripts)), whatever the corpus size; the
model is broadcast. Blocks of texts are labelled together, one word position
at a time, so the work per task is bounded by the block and by the longest
text in it.

Defined results: NULL text, empty text and text without letters are ``und``
with score 0; letters of a script that no language uses are scored by all
languages alike (the most trained one wins); without any training text every
text is ``und``; rows with repeated ids are each predicted by their own text;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabula.llm.bpe import L as LETTER
from tabula.llm.bpe import byte_classes, code_points, utf8
from tabula.llm.common import blocks, crc_mod, documents

BUCKETS = 1 << 16
#: Scripts and the code point ranges of their letters.
SCRIPTS = (
    ("latin", ((0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A))),
    ("greek", ((0x370, 0x3FF), (0x1F00, 0x1FFF))),
    ("cyrillic", ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F))),
    ("armenian", ((0x530, 0x58F),)),
    ("hebrew", ((0x590, 0x5FF),)),
    ("arabic", ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF))),
    ("devanagari", ((0x900, 0x97F),)),
    ("bengali", ((0x980, 0x9FF),)),
    ("tamil", ((0xB80, 0xBFF),)),
    ("thai", ((0xE00, 0xE7F),)),
    ("georgian", ((0x10A0, 0x10FF), (0x1C90, 0x1CBF))),
    ("hangul", ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF))),
    ("kana", ((0x3040, 0x30FF), (0x31F0, 0x31FF))),
    ("han", ((0x2E80, 0x2FDF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))),
)
OTHER = len(SCRIPTS)
#: A language uses a script that holds at least this share of its letters.
SCRIPT_SHARE = 0.005
#: Cost of a change of language, in nats.
SWITCH = 8.0
BLOCK_BYTES = 2 << 20


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # (buckets, languages), log probabilities
    uses: np.ndarray  # (scripts, languages)


def script_of(points: np.ndarray) -> np.ndarray:
    out = np.full(len(points), OTHER, np.int64)
    for n, (_, ranges) in enumerate(SCRIPTS):
        for a, b in ranges:
            out[(points >= a) & (points <= b)] = n
    return out


def _words(raw: bytes, doc_offsets: np.ndarray):
    """Trigram bucket of every letter byte, and per word: first byte, end,
    script, and where its letter bytes start."""
    b = np.frombuffer(raw, np.uint8)
    letter = np.zeros(len(b) + 2, bool)
    letter[1:-1] = byte_classes(b) == LETTER
    cut = np.zeros(len(b) + 2, bool)  # a new text starts here
    cut[doc_offsets + 1] = True
    first = np.flatnonzero(letter[1:-1] & (~letter[:-2] | cut[1:-1]))
    last = np.flatnonzero(letter[1:-1] & (~letter[2:] | cut[2:]))
    at = np.flatnonzero(letter[1:-1])
    mid = np.zeros(len(b) + 2, np.uint32)
    mid[1:-1] = b
    left, right = mid[at], mid[at + 2]
    starts = np.searchsorted(at, first)
    if len(at):
        left[starts] = 0  # word borders
        right[np.append(starts[1:], len(at)) - 1] = 0
    key = (left << np.uint32(16)) | (mid[at + 1] << np.uint32(8)) | right
    bucket = ((key * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64)
    return bucket, first, last + 1, script_of(code_points(b, first)), starts


def _lowered(column):
    return pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), ""))


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Model:
    """Count trigrams and scripts of all rows with a language."""
    rows = docs.filter(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"),
                                                          F.col(text_col).alias("text"))

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for block in blocks(batches, "text", BLOCK_BYTES):
            raw, offsets = utf8(_lowered(block.column(1)))
            bucket, first, end, script, starts = _words(raw, offsets)
            owner = np.searchsorted(offsets, first, side="right") - 1
            names = block.column(0).dictionary_encode()
            lang = names.indices.to_numpy(zero_copy_only=False)[owner] if len(owner) else np.zeros(0, np.int64)
            size = np.diff(np.append(starts, len(bucket)))
            of_byte = np.repeat(lang, size)
            for n, name in enumerate(names.dictionary.to_pylist()):
                own = np.bincount(bucket[of_byte == n], minlength=BUCKETS)
                own = np.append(own, np.bincount(script[lang == n], weights=size[lang == n], minlength=OTHER + 1))
                sums[name] = sums.get(name, 0) + own
        for name, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()),
                 pa.array(total[at].astype(np.int64))], names=["lang", "bucket", "n"])

    got = (rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket")
           .agg(F.sum("n").alias("n")).toPandas())
    languages = sorted(got["lang"].unique())
    counts = np.zeros((BUCKETS + OTHER + 1, len(languages)))
    counts[got["bucket"], [languages.index(x) for x in got["lang"]]] = got["n"]
    grams, scripts = counts[:BUCKETS], counts[BUCKETS:]
    scores = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * BUCKETS)) if languages else grams
    uses = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1)
    # the most trained language first, so that it wins ties
    order = np.argsort(-grams.sum(axis=0), kind="stable")
    return Model([languages[i] for i in order], scores[:, order].astype(np.float32), uses[:, order])


def viterbi(scores: np.ndarray, starts: np.ndarray, lengths: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best label of every word; text ``d`` owns ``lengths[d]`` words from
    ``starts[d]``. All texts advance together, one word at a time."""
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    label = np.zeros(len(scores), np.int16)
    if not len(scores):
        return label
    steps = int(lengths[0])
    active = len(lengths) - np.searchsorted(lengths[::-1], np.arange(steps), side="right")
    changed = np.zeros(scores.shape, bool)
    origin = np.zeros(len(scores), np.int16)
    value = scores[starts[:active[0]]].astype(np.float64)
    for t in range(1, steps):
        n = active[t]
        at = starts[:n] + t
        v = value[:n]
        best = v.argmax(axis=1)
        top = v[np.arange(n), best] - switch
        move = top[:, None] > v
        changed[at], origin[at] = move, best
        value[:n] = np.where(move, top[:, None], v) + scores[at]
    now = value.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        n = active[t]
        at = starts[:n] + t
        label[at] = now[:n]
        now[:n] = np.where(changed[at, now[:n]], origin[at], now[:n])
    return label


def word_scores(model: Model, bucket, script, starts) -> np.ndarray:
    """Score of every word under every language, relative to the best one;
    languages that do not use the word's script are out of the race."""
    gram = model.scores[bucket]
    out = np.add.reduceat(gram, starts, axis=0).astype(np.float64) if len(starts) else np.zeros((0, len(model.languages)))
    uses = model.uses[script]
    none = ~uses.any(axis=1)
    out[~uses & ~none[:, None]] = -1e6
    out[none] = 0
    return out - out.max(axis=1, keepdims=True) if len(out) else out


def _label_block(model: Model, texts):
    """Predicted language, score and spans of every text of a string array."""
    names = np.array(model.languages, object)
    n = len(texts)
    raw, offsets = utf8(_lowered(texts))
    bucket, first, end, script, starts = _words(raw, offsets)
    if not len(names) or not len(first):
        return pa.array(["und"] * n, pa.string()), pa.array([0.0] * n, pa.float64()), pa.array([[]] * n, SPANS)
    owner = np.searchsorted(offsets, first, side="right") - 1
    count = np.bincount(owner, minlength=n)
    begin = np.cumsum(count) - count
    label = viterbi(word_scores(model, bucket, script, starts), begin, count)
    # code points: bytes that are not continuation bytes
    points = np.append(0, np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80))
    size = points[end] - points[first]
    mass = np.bincount(owner * len(names) + label, weights=size, minlength=n * len(names)).reshape(n, -1)
    total = mass.sum(axis=1)
    change = np.append(True, (label[1:] != label[:-1]) | (owner[1:] != owner[:-1]))
    head = np.flatnonzero(change)
    tail = np.append(head[1:], len(label)) - 1
    base = points[offsets[owner[head]]]
    spans = pa.StructArray.from_arrays(
        [pa.array(points[first[head]] - base), pa.array(points[end[tail]] - base),
         pa.array(names[label[head]], pa.string())], names=["start", "end", "lang"])
    at = np.append(0, np.cumsum(np.bincount(owner[head], minlength=n)))
    return (pa.array(np.where(total > 0, names[mass.argmax(axis=1)], "und"), pa.string()),
            pa.array(mass.max(axis=1) / np.maximum(total, 1)),
            pa.ListArray.from_arrays(pa.array(at, pa.int32()), spans).cast(SPANS))


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))


FOUND = ("lang_pred", "score", "lang_spans")


def label(docs: DataFrame, model: Model, text_col: str = "text", found: tuple[str, str, str] = FOUND) -> DataFrame:
    """All columns of ``docs`` and, under the names ``found``, the language,
    its score and the spans (start, end in code points, language). Own columns
    of these names give way."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.drop(*found)
    names = [*rows.columns, *found]

    rows_text = rows.columns.index(text_col)

    def run(batches):
        for block in blocks(batches, text_col, BLOCK_BYTES):
            texts = block.column(rows_text)
            yield pa.RecordBatch.from_arrays([*block.columns, *_label_block(sent.value, texts)], names=names)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    own = "`{}` string, `{}` double, `{}` array<struct<start:long,end:long,lang:string>>".format(*found)
    return rows.mapInArrow(run, f"{kinds}, {own}")


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``lang_pred``, ``score`` and ``lang_spans``."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return label(rows, model).drop("text").withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id") -> Column:
    return crc_mod(id_col, 4) == 2


def train_split(docs: DataFrame) -> Model:
    return train(docs.filter(~held_out()))


def op8(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return (identify(docs, train_split(docs))
            .select("doc_id", held_out().alias("held_out"), "lang_pred", "score"))
