"""SimHash against brute force: fingerprints, links and classes."""

import random
import re

import numpy as np
import pytest
import xxhash

from tabula.llm import simhash as S
from tabula.llm.fingerprint import shingle_hashes, simhash


def plain_fingerprint(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(rows, d=2):
    fps = {t: plain_fingerprint(t) for _, t in rows}
    distinct = sorted(set(fps.values()))
    root = {f: f for f in distinct}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if bin(a ^ b).count("1") <= d:
                root[find(a)] = find(b)
    least = {}
    for i, t in rows:
        if i is not None:
            least[find(fps[t])] = min(least.get(find(fps[t]), i), i)
    return sorted(((i, f"{fps[t]:016x}", least.get(find(fps[t]))) for i, t in rows), key=repr)


def sample(seed=1):
    rng = random.Random(seed)
    base = [" ".join(rng.choice(["Red", "green", "blue", "é", "x1"]) + str(rng.randint(0, 40)) for _ in range(rng.randint(1, 60)))
            for _ in range(60)]
    rows = []
    for i in range(400):
        words = rng.choice(base).split()
        if rng.random() < 0.7:
            words[rng.randrange(len(words))] = "edit"
        rows.append((i, "\n ".join(words)))
    return rows + [(400, None), (401, ""), (402, " \t"), (403, "one"), (404, "two words"), (405, "ONE"), (3, rows[3][1]),
                   (3, "other text with this id"), (None, rows[9][1]), (None, "nobody has this"), (406, "word " * 60000)]


def test_fingerprints():
    for _, t in sample():
        assert simhash(shingle_hashes(t or "", 3)) == plain_fingerprint(t)


def test_classes_against_brute_force(spark):
    docs = spark.createDataFrame([(i, t, "c") for i, t in sample()], "doc_id long, text string, fp string")
    assert sorted(map(tuple, S.near_dedup(docs).collect()), key=repr) == plain_classes(sample())
    assert S.near_dedup(docs.limit(0)).count() == 0


@pytest.mark.parametrize("d", [1, 2, 3])
def test_links_are_complete(spark, d):
    rng = np.random.default_rng(d)
    base = rng.integers(0, 2**63, 40).astype(np.uint64) * np.uint64(2) + rng.integers(0, 2, 40).astype(np.uint64)
    fps = set(map(int, base)) | {0, 2**64 - 1, 1}
    for f in list(fps):
        for _ in range(25):
            g = f
            for bit in rng.choice(64, rng.integers(1, 5), replace=False):
                g ^= 1 << int(bit)
            fps.add(g)
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    frame = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = {(r["a"], r["b"]) for r in S.links(frame, d).collect()}
    want = {(min(a, b), max(a, b)) for a in signed for b in signed
            if a != b and bin((a ^ b) & (2**64 - 1)).count("1") <= d}
    assert got == want


def test_components_long_path_and_star(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 400)] + [(5000, 5001), (5001, 5000)]
    got = dict(map(tuple, S.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(1, 301)}, **{1000 + i: 1000 for i in range(1, 400)}, 5001: 5000}


def test_whole_table(spark):
    from tests.conftest import SF_SMALL
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert sorted(map(tuple, S.op1(spark, SF_SMALL).collect()), key=repr) == plain_classes(rows)
