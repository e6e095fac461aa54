"""Packing: every id in one piece, gapless sequences, the curve itself."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from tabula.llm import packing as K
from tests.conftest import SF_SMALL

FILE = P.path("byte_bpe_50k.json")


@pytest.mark.parametrize("dims,bits", [(2, 1), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbours(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    key = K.hilbert_key(grid, bits)
    assert sorted(key) == list(range(len(grid)))
    walk = grid[np.argsort(key)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def check(pieces, want, seq_len=1024):
    """``want``: ids of every document by id (with the end id)."""
    docs, seqs = defaultdict(list), defaultdict(list)
    for p in pieces:
        docs[p["doc_id"]].append(p)
        seqs[p["sequence_id"]].append(p)
    for i, own in docs.items():
        own.sort(key=lambda p: p["start"])
        at = 0
        for p in own:
            ids = np.array(want[i][p["start"]:p["start"] + p["length"]], "<u4")
            assert p["start"] == at and len(ids) == p["length"] > 0 and p["doc_tokens"] == len(want[i])
            assert p["ids_crc32"] == zlib.crc32(ids.tobytes())
            at += p["length"]
        assert at == len(want[i])
    for s, own in seqs.items():
        own.sort(key=lambda p: p["offset"])
        at = 0
        for p in own:
            assert p["offset"] == at
            at += p["length"]
        assert at == seq_len or s == max(seqs) and at < seq_len
    assert sorted(seqs) == list(range(len(seqs)))
    return docs


def test_whole_table(spark):
    library = Tokenizer.from_file(FILE)
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    want = {r["doc_id"]: library.encode(r["text"] or "", add_special_tokens=False).ids + [0] for r in rows}
    docs = check(K.op3(spark, SF_SMALL).collect(), want)
    assert docs.keys() == want.keys()


def test_edges(spark):
    library = Tokenizer.from_file(FILE)
    texts = [None, "", " ", "a <|endoftext|> b", "<|endoftext|>", "don't  stop\n\n", "word " * 40000, "é日本 \u0085"] + ["copy"] * 300
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(None, "no id", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, length long")
    want = {i: library.encode(t or "", add_special_tokens=False).ids + [0] for i, t, _ in rows}
    got = K.pack(frame, FILE, seq_len=64).collect()
    docs = check(got, want, 64)
    assert docs.keys() == want.keys()
    assert all(p["ids"] == want[p["doc_id"]][p["start"]:p["start"] + p["length"]] for p in got)
    assert K.pack(frame.limit(0), FILE).count() == 0
    twice = K.pack(spark.createDataFrame([(1, "same"), (1, "same"), (2, "x")], "doc_id long, text string"), FILE).collect()
    assert len(twice) == 3 and sorted(p["offset"] for p in twice) == sorted({p["offset"] for p in twice})


def test_neighbours_share_sequences():
    """Texts of one vocabulary lie closer along the curve than mixed ones."""
    rng = np.random.default_rng(5)
    topic = rng.integers(0, 4, 400)
    ids = [rng.integers(1000 * k, 1000 * k + 60, 200) for k in topic]
    cuts = np.append(0, np.cumsum([len(x) for x in ids]))
    order = np.argsort(K.curve_keys(np.concatenate(ids), cuts), kind="stable")
    assert (topic[order][1:] == topic[order][:-1]).mean() > 0.6
