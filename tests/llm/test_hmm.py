"""Hidden Markov model against enumeration and brute-force counts."""

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabula.llm import hmm as H
from tests.conftest import SF_MID, SF_SMALL


def toy(symbols=5, states=3, seed=2):
    return H.start_model(np.random.default_rng(seed).random(symbols), states, seed)


def test_forward_is_exact():
    model, seqs = toy(), [[0], [1, 0], [3, 2, 1, 0], [4, 4, 0, 1, 2]]
    got = H.forward(model, np.concatenate(seqs), np.array([len(s) for s in seqs]))
    for s, g in zip(seqs, got):
        p = sum(model.start[z[0]] * model.emit[s[0], z[0]] * math.prod(
            model.move[z[i - 1], z[i]] * model.emit[s[i], z[i]] for i in range(1, len(s)))
            for z in itertools.product(range(3), repeat=len(s)))
        assert g == pytest.approx(math.log10(p))
    # probabilities of all sequences of one length sum to one
    every = list(itertools.product(range(5), repeat=3))
    total = H.forward(model, np.array(every).ravel(), np.full(len(every), 3))
    assert (10 ** total).sum() == pytest.approx(1)


def test_expected_counts_by_enumeration():
    model, seqs = toy(), [[0, 1, 2], [3], [2, 2, 0, 4]]
    log, first, moves, emit = H.expected_counts(model, np.concatenate(seqs), np.array([len(s) for s in seqs]))
    w_first, w_moves, w_emit = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for s in seqs:
        paths = {z: model.start[z[0]] * model.emit[s[0], z[0]] * math.prod(
            model.move[z[i - 1], z[i]] * model.emit[s[i], z[i]] for i in range(1, len(s)))
            for z in itertools.product(range(3), repeat=len(s))}
        whole = sum(paths.values())
        for z, p in paths.items():
            w_first[z[0]] += p / whole
            for i, k in enumerate(z):
                w_emit[s[i], k] += p / whole
                if i:
                    w_moves[z[i - 1], k] += p / whole
    assert np.allclose(first, w_first) and np.allclose(moves, w_moves) and np.allclose(emit, w_emit)


def test_long_text_does_not_underflow():
    flat = np.random.default_rng(0).integers(0, 5, 50000)
    got = H.forward(toy(), flat, np.array([50000]))
    assert -1e6 < got[0] < -1e3


def plain(rows):
    low = lambda t: [w.lower() if w.isascii() else "".join(c.lower() if c.isascii() else c for c in w)
                     for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")] + [""]
    out = lambda i: zlib.crc32(str(i if i is not None else "").encode()) % 7 == 2
    c = Counter(w for i, t in rows if not out(i) for w in low(t))
    n, v = sum(c.values()), len(c)
    return sorted(((i, out(i), len(low(t)), sum(c[w] > 0 for w in low(t)), n,
                    sum(math.log10((c[w] + 1) / (n + v + 1)) for w in low(t))) for i, t in rows), key=repr)


def compare(got, rows):
    got = sorted((tuple(r) for r in got), key=lambda r: repr(r[:5]))
    want = sorted(plain(rows), key=lambda r: repr(r[:5]))
    key = lambda r: (repr(r[:5]), r[5])
    for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9)
        assert g[6] < 0 and math.isfinite(g[6])


@pytest.mark.parametrize("known", [4, 1000])
def test_counts_and_base_score(spark, known):
    rows = [(i, f"The cat é{i % 9} sat\ton THE mat{i % 5} x{i}") for i in range(60)] + [
        (100, None), (101, ""), (102, " \n"), (103, "word " * 30000), (5, "again"), (5, "again"), (None, "no id here")]
    frame = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, score string")
    compare(H.score(frame, H.crc_mod("doc_id", 7) == 2, symbols=min(known, 3), known=known, rounds=2).collect(), rows)


def test_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    compare(H.op7(spark, SF_SMALL).collect(), rows)


def test_training_raises_the_likelihood(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    out = H.crc_mod("doc_id", 7) == 2
    vocab = H.vocabulary(H.word_counts(docs.filter(~out)))
    encoded = H.encode(docs, out, vocab, "doc_id", "text")
    _, history = H.train(encoded.filter("NOT held_out"), H.symbol_frequency(vocab))
    assert all(b > a for a, b in zip(history, history[1:])) and len(history) == H.ROUNDS
    sums = H.op7(spark, SF_MID).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert sums[0] > sums[1]  # better than single words on texts it has not seen


def test_nothing_to_learn_and_empty(spark):
    frame = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in H.score(frame, F.lit(True)).collect()}
    assert got[1]["n_known"] == 0 and got[1]["train_tokens"] == 0 and got[1]["base_score"] == 0
    assert math.isfinite(got[1]["score"]) and got[2]["n_tokens"] == 1
    assert H.score(frame.limit(0), F.lit(False)).count() == 0


def test_more_equal_counts_than_room(spark):
    """Words of one count: those that find no room are scored alike by the
    base model, and room is used as far as it goes."""
    words = [f"w{i}" for i in range(500)]
    frame = spark.createDataFrame([(i, " ".join(words[i::5])) for i in range(5)], "doc_id long, text string")
    for known, least in ((400, 390), (600, 500), (0, 0)):
        vocab = H.vocabulary(H.word_counts(frame), symbols=450, known=known)
        assert least <= len(vocab.known) <= known and vocab.symbols == min(450, len(vocab.known))
    few, all_ = (H.score(frame, F.lit(False), rounds=1, states=2, known=k).orderBy("doc_id").collect() for k in (400, 600))
    for a, b in zip(few, all_):
        assert a["base_score"] == pytest.approx(b["base_score"], rel=1e-12) and a["n_known"] == b["n_known"]
