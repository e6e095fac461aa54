"""Substring dedup against the definition, and the index against plain search."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabula.llm import substrings as S
from tabula.llm.fm_index import FMIndex
from tests.conftest import SF_SMALL

lists = st.lists(st.lists(st.integers(1, 3), max_size=14), min_size=1, max_size=5)


def flat(pieces):
    return np.array([w for p in pieces for w in p], np.int64), np.cumsum([0] + [len(p) for p in pieces])


@settings(max_examples=200, deadline=None)
@given(lists, st.lists(st.lists(st.integers(0, 3), max_size=14), min_size=1, max_size=5), st.integers(1, 8))
def test_matching_statistics(pieces, streams, depth):
    index = FMIndex(*flat(pieces), 4, depth)
    length, where = index.matching_statistics(*flat(streams))
    text = [w for p in pieces for w in p + [0]]
    k = 0
    for q in streams:
        for i in range(len(q)):
            m = 0
            while m < depth and i + m < len(q) and any(
                    q[i:i + m + 1] == p[j:j + m + 1] for p in pieces for j in range(len(p) - m)):
                m += 1
            assert length[k] == m
            at = index.order[where[k]]
            assert m == 0 or text[at:at + m] == q[i:i + m]
            k += 1


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain(rows, window=20):
    """{row number: (id, n_words, n_removed, digest)} from a table of all windows."""
    top = float("inf")
    first = {}
    split = [(top if i is None else i, words(t)) for i, t in rows]
    for i, w in split:
        for s in range(len(w) - window + 1):
            k = tuple(w[s:s + window])
            first[k] = min(first.get(k, (i, s)), (i, s))
    out = []
    for (raw, _), (i, w) in zip(rows, split):
        gone = set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s:s + window])] < (i, s):
                gone.update(range(s, s + window))
        kept = " ".join(x for t, x in enumerate(w) if t not in gone)
        out.append((raw, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def key(row):
    return tuple((v is None, v) for v in row)


def rows_of(frame):
    return sorted((tuple(r[c] for c in ("doc_id", "n_words", "n_removed", "kept_sha256")) for r in frame.collect()), key=key)


def test_segments_hold_every_window_once():
    rng = random.Random(2)
    texts = [[rng.choice("abcdé") * rng.randrange(1, 9) for _ in range(n)] for n in (0, 5, 19, 20, 21, 300, 20, 47, 0)]
    held = S.Texts.of(pa.array([" \t" * (i % 3) + ("\n" * (1 + i % 2)).join(t) + " " * (i % 2) for i, t in enumerate(texts)]))
    assert [held.part(a, z).decode() for a, z in zip(held.cuts, held.cuts[1:])] == [" ".join(t) for t in texts]
    text, begin, end, anchor = S.segments(held, 20, 8)
    assert {(held.part(held.cuts[d] + a, held.cuts[d] + b)): h for d, a, b, h in zip(text, begin, end, anchor)}
    seen = sorted((d, s) for d, a, b in zip(text, begin, end) for s in range(a, b - 19))
    assert seen == [(d, s) for d, t in enumerate(texts) for s in range(len(t) - 19)]
    assert (end - begin).max() <= 32 and (anchor & 1 == 0).all()


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = S.op13(spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    want = sorted(plain(rows), key=key)
    assert rows_of(got) == want and sum(r[2] for r in want) > 1000


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") * rng.randrange(1, 4)
    passages = [" ".join(word() for _ in range(rng.randrange(15, 70))) for _ in range(5)]
    rows = []
    for i in range(80):
        parts = [" ".join(word() for _ in range(rng.randrange(40)))]
        for _ in range(rng.randrange(4)):
            p = words(rng.choice(passages))
            a = rng.randrange(len(p))
            parts += [" ".join(p[a:a + rng.randrange(10, 60)]), "\n".join(word() for _ in range(rng.randrange(8)))]
        rows.append((i, "  ".join(parts)))
    rows += [(200 + i, rows[3][1]) for i in range(30)] + [(300, "same words " * 60), (301, passages[0] + " " + passages[0])]
    rows += [(7, rows[9][1]), (7, passages[1]), (9, rows[9][1]), (9, rows[9][1]), (None, rows[4][1]), (None, passages[2])]
    return rows + [(400, None), (401, ""), (402, " \n\t"), (403, "one"), (404, "é " * 25), (None, None)]


@pytest.mark.parametrize("seed,hot,shard_words", [(1, 10_000, 250_000), (2, 3, 300), (3, 0, 100)])
def test_odd_rows(spark, seed, hot, shard_words):
    rows = corpus(seed)
    frame = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows],
                                  "doc_id long, text string, key int, anchor string, n_words int")
    got = S.find_repeats(frame, hot=hot, shard_words=shard_words)
    assert rows_of(got) == sorted(plain(rows), key=key)


def test_other_windows(spark):
    rows = corpus(5)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(S.find_repeats(frame, window=11, gram=4)) == sorted(plain(rows, 11), key=key)
    assert S.find_repeats(frame.limit(0)).count() == 0
    one = S.find_repeats(frame.filter("doc_id = 301")).collect()[0]
    assert [s["length"] for s in one["spans"]] == [one["n_removed"]] and one["n_removed"] * 2 == one["n_words"]
