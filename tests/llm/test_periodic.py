"""Periodic runs against the definition, word by word."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabula.llm import periodic as P
from tests.conftest import SF_SMALL


def plain_runs(w, min_length=6, exponent=4):
    """Maximal stretches of matches on every diagonal, smallest period only."""
    out = []
    n = len(w)
    for q in range(1, n):
        i = 0
        while i < n - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i < n - q and w[i] == w[i + q]:
                i += 1
            own = w[s:i + q]
            if len(own) >= max(min_length, exponent * q) and not any(
                    all(own[t] == own[t + p] for t in range(len(own) - p)) for p in range(1, q)):
                out.append((s, len(own), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def run_list(w, *args):
    number = {x: i for i, x in enumerate(dict.fromkeys(w))}
    got = P.find_runs(np.array([number[x] for x in w], np.int64), np.array([0, len(w)]), *args)
    return [tuple(map(int, r)) for r in got.T]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=7), st.integers(1, 9)), max_size=6))
def test_runs(parts):
    w = [x for word, times in parts for x in word * times]
    assert run_list(w) == plain_runs(w)


@pytest.mark.parametrize("args", [(6, 4), (2, 3), (10, 3), (25, 5), (1, 6)])
def test_parameters(args):
    rng = random.Random(4)
    for _ in range(150):
        w = []
        while len(w) < 90:
            w += [rng.randrange(3) for _ in range(rng.randrange(1, 12))] * rng.choice([1, 1, 2, 3, 5, 7])
        assert run_list(w, *args) == plain_runs(w, *args)


def test_documents_do_not_touch():
    w = np.array([1] * 5 + [1] * 7 + [1] * 3, np.int64)
    assert P.find_runs(w, np.array([0, 5, 5, 12, 15])).T.tolist() == [[5, 7, 1]]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_row(doc_id, text, rule=True):
    w = words(text)
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if rule and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    gone = {t for s, m, q in runs for t in range(s + q, s + m)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None,) * 3
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
            sha(" ".join(x for t, x in enumerate(w) if t not in gone)))


def key(row):
    return tuple((v is None, v) for v in row)


def test_whole_table(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = sorted(plain_row(i, t) for i, t in rows if len(words(t)) < 2500)
    got = [tuple(r) for r in P.op12(spark, SF_SMALL).collect()]
    assert len(got) == len(rows)
    short = {r[0] for r in want}
    assert sorted((r for r in got if r[0] in short), key=key) == sorted(want, key=key)
    # long texts: the planted rule puts a run on them that is known in closed form
    for i, t in rows:
        n, h = len(words(t)), zlib.crc32(str(i).encode())
        if i not in short and h % 10 == 0:
            g = h // 10
            p = 1 + (n - g % n) // (3 + g % 8)
            own = next(r for r in got if r[0] == i)
            assert own[1] >= 1 if n - g % n >= max(6, 4 * p) else True


def test_edges(spark):
    line = "one two  three\tfour\n"
    texts = [None, "", " \t\n", "word", "a " * 5, "a " * 6, "a " * 7, " a " * 9, line * 3, line * 4, line * 2000,
             "x " + "y " * 8 + "z " * 8, "日本 語 " * 6, "a b a b a b a b c " * 4]
    rows = [(i, t, "extra", 1) for i, t in enumerate(texts)] + [(None, line * 5, "", 2), (5, "a " * 6, "", 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, runs string, collapsed int")
    want = [plain_row(r[0], r[1], rule=False) for r in rows if r[1] != line * 2000]
    got = [tuple(r) for r in P.digests(frame).collect()]
    assert sorted((r for r in got if r[0] != 10), key=key) == sorted(want, key=key)
    assert next(r for r in got if r[0] == 10)[1:6] == (1, 0, 8000, 4, 2000000)
    assert P.digests(frame.limit(0)).count() == 0
    runs = {r["doc_id"]: (r["runs"], r["collapsed"]) for r in P.periodic_runs(frame).collect()}
    assert runs[9][1] == "one two three four" and runs[9][0][0]["period"] == 4


def test_rule_of_the_contract(spark):
    from pyspark.sql import functions as F

    rows = [(i, f"{'w ' * (i % 5)}a b\tc d {i} e f g h") for i in range(300)] + [(None, "x y")]
    rows += [(i, t) for i in range(300) if zlib.crc32(str(i).encode()) % 10 == 0 for t in (None, "", " \n")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = frame.select("doc_id", "text", P.planted(F.col("doc_id"), F.col("text")).alias("new")).collect()
    for i, t, new in got:
        w = words(t)
        h = zlib.crc32(str(i).encode())
        if i is not None and h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(len(w))]
            assert new == " ".join(w)
        else:
            assert new == t
