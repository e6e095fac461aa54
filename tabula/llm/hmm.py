"""Hidden Markov language model over words.

Symbols of the model are the most frequent words, the end of the text, and
suffix classes for all other words; a word of a class has its add-one share of
that class (one share is left for words never seen). Baum-Welch trains the
latent states on every training text: each task runs the scaled forward and
backward recursions on its texts and gives expected counts, which Spark sums
by cell. Scoring is the scaled forward recursion, so ``score`` is the exact
log10 probability of the whole token sequence under the model.

Beside it stands the add-one unigram score. Word counts cover all training
texts. The ``KNOWN`` most frequent words travel to the tasks (a fixed number);
every rarer word of every text meets its count by a join, after each text has
summed its own repeats. What reaches the driver is fixed by ``KNOWN``,
``SYMBOLS``, ``CLASSES`` and ``STATES``, not by the corpus.

Tokens: A-Z lower-cased, words between 0x20 and 0x09-0x0D, then one end.

Defined results: NULL and empty texts are the end alone; rows with repeated
ids are trained on and scored each; without training texts all counts are
zero and the model is the start model; an empty table gives an empty result;
further columns are ignored. A task holds 24 bytes per state for each word of
a block while training; one longer text is a block of its own.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabula.llm.bpe import utf8
from tabula.llm.common import blocks, crc_mod, documents, stash
from tabula.llm.fingerprint import _LOWER

#: Latent states, words with a symbol of their own, suffix classes, words
#: whose counts travel to the tasks (at most), rounds of Baum-Welch.
STATES, SYMBOLS, CLASSES, KNOWN, ROUNDS, SEED = 8, 4096, 256, 60_000, 4, 42
#: Parts of a count bucket that is too large to travel whole.
SLICES = 4096
END = 0
BLOCK_BYTES = 8 << 20
#: Compressed symbols run together, about 600,000 tokens.
SYMBOL_BYTES = 3 << 18
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def suffix_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % CLASSES


#: What one byte does to a CRC-32 register, from the library's own values.
_CRC_STEP = np.array([zlib.crc32(bytes([i])) ^ 0xFFFFFFFF for i in range(256)], np.uint32)
_CRC_STEP ^= np.uint32(0xFFFFFF)  # a register of ones moved by a byte
_CRC_STEP = _CRC_STEP[np.arange(256) ^ 0xFF]


def suffix_classes(words: pa.LargeBinaryArray) -> np.ndarray:
    """``suffix_class`` of many words."""
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8) if len(words) else np.zeros(0, np.uint8)
    register = np.full(len(words), 0xFFFFFFFF, np.uint32)
    for back in (3, 2, 1):
        own = np.flatnonzero(np.diff(offsets) >= back)
        r = register[own]
        register[own] = _CRC_STEP[(r ^ data[offsets[own + 1] - back]) & 0xFF] ^ (r >> 8)
    return ((register ^ np.uint32(0xFFFFFFFF)) % np.uint32(CLASSES)).astype(np.int32)


def block_words(column) -> tuple[pa.LargeBinaryArray, np.ndarray, np.ndarray]:
    """Distinct words of a block, the word number of every token, and how
    many tokens each text has."""
    raw, at = utf8(column)
    b = np.frombuffer(raw.translate(_LOWER), np.uint8)
    solid = np.zeros(len(b) + 2, bool)
    solid[1:-1] = ~_SPACE[b]
    cut = np.zeros(len(b) + 2, bool)  # a text starts here
    cut[at + 1] = True
    first = np.flatnonzero(solid[1:-1] & (~solid[:-2] | cut[1:-1]))
    owner = np.searchsorted(at, first, side="right") - 1
    count = np.bincount(owner, minlength=len(at) - 1) if len(first) else np.zeros(len(at) - 1, np.int64)
    data = b[solid[1:-1]]
    before = np.append(0, np.cumsum(solid[1:-1]))
    offsets = np.append(before[first], len(data)).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    enc = words.dictionary_encode()
    return enc.dictionary, enc.indices.to_numpy(zero_copy_only=False).astype(np.int64), count


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """A written table: every word with its suffix class and its count; the
    end of a text is the empty word of class -1."""
    def run(batches):
        for block in blocks(batches, "text", BLOCK_BYTES):
            words, index, _ = block_words(block.column(0))
            counts = np.bincount(index, minlength=len(words))
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([words, pa.array([b""], pa.large_binary())]).cast(pa.binary()),
                 pa.array(np.append(suffix_classes(words), -1).astype(np.int32)),
                 pa.array(np.append(counts, block.num_rows))], names=["word", "cls", "c"])

    parts = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "word binary, cls int, c long")
    return stash(parts.groupBy("word", "cls").agg(F.sum("c").alias("c")), "word-counts")


@dataclass
class Vocabulary:
    tokens: int  # N
    distinct: int  # V
    ends: int  # count of the end token
    known: dict[bytes, tuple[int, int]]  # word: (symbol or -1, count)
    class_log: np.ndarray  # log10(tokens + distinct + 1) of each class
    symbols: int

    def symbol_count(self) -> int:
        return 1 + self.symbols + CLASSES


def vocabulary(counts: DataFrame, symbols: int = SYMBOLS, known: int = KNOWN) -> Vocabulary:
    total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    ends = counts.filter("cls = -1").agg(F.sum("c").alias("n")).first()["n"] or 0
    # Words by sixteenths of a power of two of their count, from the highest
    # bucket down; of the bucket in which ``known`` is reached, the words of as
    # many hash slices as there is room for. (Sorting would send ``known`` rows
    # from every task to the driver.)
    words = (counts.filter("cls >= 0").withColumn("bucket", F.floor(F.log2("c") * 16))
             .withColumn("slice", F.pmod(F.xxhash64("word"), F.lit(SLICES))))
    least, slices, held = -1, SLICES, 0
    for r in sorted(words.groupBy("bucket").agg(F.count("*").alias("v")).collect(), key=lambda r: -r["bucket"]):
        if held + r["v"] > known:
            least, slices = r["bucket"], 0
            for q in sorted(words.filter(F.col("bucket") == least).groupBy("slice").agg(F.count("*").alias("v")).collect()):
                held += q["v"]
                if held > known:
                    break
                slices = q["slice"] + 1
            break
        held += r["v"]
    chosen = (F.col("bucket") > least) | ((F.col("bucket") == least) & (F.col("slice") < slices))
    top = sorted(words.filter(chosen).select("word", "cls", "c").collect(), key=lambda r: (-r["c"], bytes(r["word"])))
    mass, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in words.groupBy("cls").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():
        mass[r["cls"]], kinds[r["cls"]] = r["n"], r["v"]
    own = top[:symbols]
    for r in own:  # these are no members of their class
        mass[r["cls"]] -= r["c"]
        kinds[r["cls"]] -= 1
    table = {bytes(r["word"]): (1 + i if i < symbols else -1, r["c"]) for i, r in enumerate(top)}
    return Vocabulary(total["n"] or 0, total["v"], ends, table, np.log10(mass + kinds + 1), len(own))


ENCODED = ("row long, id {kind}, held_out boolean, n_tokens long, known long, log_c double, log_class double, "
           "symbols binary, rare array<struct<word:binary,tf:long>>")


def encode(docs: DataFrame, held_out: Column, vocab: Vocabulary, id_col: str, text_col: str) -> DataFrame:
    """A written table with each text's symbols, the sums that the frequent
    words give, and its rarer words with their numbers."""
    sent = docs.sparkSession.sparkContext.broadcast(vocab)

    def run(batches):
        v, packer = sent.value, zstandard.ZstdCompressor(level=1)
        known = pa.array(list(v.known), pa.large_binary())
        # the last place stands for words that are not known
        known_symbol = np.array([s for s, _ in v.known.values()] + [-1], np.int64)
        known_count = np.array([c for _, c in v.known.values()] + [0], np.int64)
        row = TaskContext.get().partitionId() << 33
        for block in blocks(batches, "text", BLOCK_BYTES):
            n = block.num_rows
            words, index, count = block_words(block.column(2))
            owner = np.repeat(np.arange(n), count)
            found = pc.fill_null(pc.index_in(words, value_set=known), len(known)).to_numpy()
            cls, own, c = suffix_classes(words), known_symbol[found], known_count[found]
            symbol = np.where(own >= 0, own, 1 + v.symbols + cls) if len(words) else own
            log_c = np.log10(c + 1.0)
            log_class = np.where(own >= 0, 0.0, log_c - v.class_log[cls]) if len(words) else log_c
            total = lambda x: np.bincount(owner, weights=x[index], minlength=n) if len(index) else np.zeros(n)
            # symbols of every text, each followed by the end
            flat = np.full(len(index) + n, END, np.uint16)
            flat[np.arange(len(index)) + owner] = symbol[index]
            cuts = np.append(0, np.cumsum(count + 1))
            # rarer words, once per text
            rare = (c == 0)[index] if len(words) else np.zeros(0, bool)
            pair, tf = np.unique(owner[rare] * max(len(words), 1) + index[rare], return_counts=True)
            who, which = np.divmod(pair, max(len(words), 1))
            lists = pa.StructArray.from_arrays(
                [words.take(pa.array(which)).cast(pa.binary()), pa.array(tf, pa.int64())], names=["word", "tf"])
            at = np.append(0, np.cumsum(np.bincount(who, minlength=n)))
            ended = int(v.ends > 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + n)), block.column(0), block.column(1), pa.array(count + 1),
                 pa.array(total((c > 0).astype(float)).astype(np.int64) + ended),
                 pa.array(total(log_c) + math.log10(v.ends + 1)), pa.array(total(log_class)),
                 pa.array([packer.compress(flat[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(at, pa.int32()), lists)],
                names=["row", "id", "held_out", "n_tokens", "known", "log_c", "log_class", "symbols", "rare"])
            row += n

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), held_out.alias("held_out"), F.col(text_col).alias("text"))
    # texts of like length lie together: a block of the recursions has as many
    # steps as its longest text, and each step then runs on nearly all of them
    return stash(rows.mapInArrow(run, ENCODED.format(kind=kind)).sortWithinPartitions("n_tokens"), "symbols")


@dataclass
class Model:
    start: np.ndarray  # (states,)
    move: np.ndarray  # (states, states)
    emit: np.ndarray  # (symbols, states)


def start_model(frequency: np.ndarray, states: int = STATES, seed: int = SEED) -> Model:
    """Symbol frequencies, tilted at random for each state."""
    rng = np.random.default_rng(seed)
    emit = (frequency + 0.01)[:, None] * np.exp(rng.standard_normal((len(frequency), states)))
    move = 1 + 0.5 * rng.random((states, states))
    return Model(np.full(states, 1 / states), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def _by_step(flat: np.ndarray, lengths: np.ndarray):
    """The sequences step by step: texts by falling length, the symbols of
    all first steps, then of all second steps and so on, and where each step
    starts. One step of all running texts is then one contiguous slice."""
    order = np.argsort(-lengths, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    running = lengths[order]
    steps = int(running[0]) if len(running) else 0
    active = len(running) - np.searchsorted(running[::-1], np.arange(steps), side="right")
    first = np.append(0, np.cumsum(active))
    step = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out = np.empty_like(flat)
    out[first[step] + np.repeat(rank, lengths)] = flat
    return order, first, out


def _scaled(model: Model, symbols: np.ndarray, first: np.ndarray, keep: bool):
    """Scaled forward recursion: scale of every token, the emissions, and
    with ``keep`` the forward variables."""
    emit = model.emit[symbols]
    alpha = np.empty_like(emit) if keep else None
    scale, now = np.empty(len(symbols)), None
    bounds = first.tolist()
    for t, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
        now = (model.start if t == 0 else now[:b - a] @ model.move) * emit[a:b]
        c = now.sum(axis=1)
        now /= c[:, None]
        scale[a:b] = c
        if keep:
            alpha[a:b] = now
    return scale, emit, alpha


def forward(model: Model, flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """log10 probability of every sequence."""
    order, first, symbols = _by_step(flat, lengths)
    scale, _, _ = _scaled(model, symbols, first, False)
    rank = np.arange(len(symbols)) - np.repeat(first[:-1], np.diff(first))
    out = np.empty(len(lengths))
    out[order] = np.bincount(rank, weights=np.log10(scale), minlength=len(lengths))
    return out


def expected_counts(model: Model, flat: np.ndarray, lengths: np.ndarray):
    """Log10 likelihood and the expected starts, moves and emissions."""
    _, first, symbols = _by_step(flat, lengths)
    scale, emit, alpha = _scaled(model, symbols, first, True)
    states = len(model.start)
    # emit becomes, token by token, emission x backward variable / scale
    emit /= scale[:, None]
    beta = np.ones_like(emit)
    bounds, back = first.tolist(), model.move.T
    for t in range(len(bounds) - 2, 0, -1):
        a, b = bounds[t], bounds[t + 1]
        emit[a:b] *= beta[a:b]
        before = bounds[t - 1]
        beta[before:before + b - a] = emit[a:b] @ back
    later = np.arange(first[1] if len(first) > 1 else 0, len(symbols))
    prior = later - np.repeat(np.diff(first)[:-1], np.diff(first)[1:])
    moves = (alpha[prior].T @ emit[later]) * model.move
    alpha *= beta  # from here on the state probabilities of every token
    counts = np.stack([np.bincount(symbols, weights=alpha[:, s], minlength=len(model.emit)) for s in range(states)], axis=1)
    return np.log10(scale).sum(), alpha[:first[1]].sum(axis=0), moves, counts


def _sequences(block, name: str = "symbols"):
    unpack = zstandard.ZstdDecompressor()
    parts = [np.frombuffer(unpack.decompress(x), np.uint16) for x in
             block.column(block.schema.get_field_index(name)).to_pylist()]
    return np.concatenate(parts).astype(np.int64), np.array([len(p) for p in parts])


def train(encoded: DataFrame, frequency: np.ndarray, rounds: int = ROUNDS, states: int = STATES) -> tuple[Model, list[float]]:
    """Baum-Welch on all rows of ``encoded``; also the log10 likelihood that
    each round started from."""
    model, history, context = start_model(frequency, states), [], encoded.sparkSession.sparkContext
    symbols = len(frequency)
    for _ in range(rounds):
        sent = context.broadcast(model)

        def run(batches, sent=sent):
            total = None
            for block in blocks(batches, "symbols", SYMBOL_BYTES):
                log, first, moves, emit = expected_counts(sent.value, *_sequences(block))
                own = np.concatenate([[log], first, moves.ravel(), emit.ravel()])
                total = own if total is None else total + own
            if total is not None:
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["cell", "x"])

        cells = np.zeros(1 + states + states * states + symbols * states)
        got = (encoded.select("symbols").mapInArrow(run, "cell int, x double")
               .groupBy("cell").agg(F.sum("x").alias("x")).toPandas())
        if not len(got):
            break
        cells[got["cell"]] = got["x"]
        history.append(cells[0])
        first, cells = cells[1:1 + states], cells[1 + states:]
        moves, emit = cells[:states * states].reshape(states, states), cells[states * states:].reshape(symbols, states)
        # a little of everything, so that no symbol becomes impossible
        model = Model((first + 0.1) / (first + 0.1).sum(), (moves + 0.1) / (moves + 0.1).sum(axis=1, keepdims=True),
                      (emit + 0.01) / (emit + 0.01).sum(axis=0))
        sent.unpersist()
    return model, history


def symbol_frequency(vocab: Vocabulary) -> np.ndarray:
    """Training count of every symbol, as far as the vocabulary tells."""
    out = np.zeros(vocab.symbol_count())
    out[END] = vocab.ends
    for symbol, c in vocab.known.values():
        if symbol > 0:
            out[symbol] = c
    out[1 + vocab.symbols:] = 10 ** vocab.class_log - 1
    return out


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
          rounds: int = ROUNDS, states: int = STATES, symbols: int = SYMBOLS, known: int = KNOWN) -> DataFrame:
    """Learn from the rows that are not ``held_out``, score all rows: id,
    ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``
    and ``score``."""
    counts = word_counts(docs.filter(~held_out), text_col)
    vocab = vocabulary(counts, symbols, known)
    encoded = encode(docs, held_out, vocab, id_col, text_col)
    model, _ = train(encoded.filter("NOT held_out"), symbol_frequency(vocab), rounds, states)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for block in blocks(batches, "symbols", SYMBOL_BYTES):
            log = forward(sent.value, *_sequences(block))
            yield pa.RecordBatch.from_arrays(
                [*(block.column(k) for k in range(6)), pa.array(log + block.column(6).to_numpy())],
                names=["row", "id", "held_out", "n_tokens", "known", "log_c", "score"])

    kind = encoded.schema["id"].dataType.simpleString()
    scored = encoded.select("row", "id", "held_out", "n_tokens", "known", "log_c", "log_class", "symbols").mapInArrow(
        run, f"row long, id {kind}, held_out boolean, n_tokens long, known long, log_c double, score double")
    rare = encoded.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.tf")
    # rarer words have counts of their own in every text's sum; both sides grow, so neither is broadcast
    met = rare.join(counts.filter("cls >= 0").select("word", "c").hint("merge"), "word")
    sums = met.groupBy("row").agg(F.sum(F.col("tf") * F.log10(F.col("c") + 1)).alias("rare_log"),
                                  F.sum("tf").alias("rare_known"))
    whole = math.log10(vocab.tokens + vocab.distinct + 1)
    log = F.coalesce("rare_log", F.lit(0.0))
    return scored.join(sums.hint("merge"), "row", "left").select(
        F.col("id").alias(id_col), "held_out", "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("log_c") + log - F.col("n_tokens") * whole).alias("base_score"), (F.col("score") + log).alias("score"))


def op7(spark, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir), crc_mod("doc_id", 7) == 2)
