"""Exact dedup against brute force, and the perfect hash by itself."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabula.llm import exact_dedup as X


def digests(n, seed=0):
    return np.random.default_rng(seed).integers(0, 256, (n, 32)).astype(np.uint8)


@pytest.mark.parametrize("n", [1, 2, 7, 1000, 30000])
def test_hash_is_minimal_and_perfect(n):
    keys = digests(n)
    sizes, bits, slot = X.build_mph(keys)
    assert sorted(slot) == list(range(n))
    slots = keys[np.argsort(slot)]
    assert (X.find_slots(keys, sizes, bits, slots) == slot).all()
    assert (X.find_slots(digests(500, 9), sizes, bits, slots) == -1).all()


def test_keys_equal_in_the_hashed_bytes():
    keys = digests(50)
    keys[:, 8:24] = 7  # the hash cannot tell these apart
    sizes, bits, slot = X.build_mph(keys)
    assert sorted(slot) == list(range(50))
    assert (X.find_slots(keys, sizes, bits, keys[np.argsort(slot)]) == slot).all()


def brute(rows):
    groups = defaultdict(list)
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    for i, t in rows:
        groups[norm(t)].append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[norm(t)] if x is not None]
        keep = min(ids) if ids else None
        out.append((i, keep, len(groups[norm(t)]), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=repr)


ROWS = ([(i, "hot  text") for i in range(0, 60, 2)] + [(i, f"t{i // 3}\n x ") for i in range(60)]
        + [(61, None), (62, ""), (63, " "), (64, "\t\n"), (65, " "), (66, "y" * 300000), (67, "y" * 300000),
           (5, "hot text"), (5, "hot text"), (None, "hot\ttext"), (None, "alone"), (None, "alone")])


@pytest.mark.parametrize("cut", [-1, 30, 1000])
def test_against_brute_force(spark, cut):
    docs = spark.createDataFrame([(i, t, "x") for i, t in ROWS], "doc_id long, text string, digest string")
    got = X.exact_dedup(docs, F.col("doc_id") <= cut, shard_keys=7)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(ROWS)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert X.exact_dedup(docs, X.older_half(docs)).count() == 0
