"""Quality counts against brute force; what the bands keep and reject."""

import base64
import random
import re
import string
from collections import Counter

import zstandard

from tabula.llm import quality as Q
from tests.conftest import SF_MID, SF_SMALL


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n = len(words)
    windows = [tuple(words[i:i + 8]) for i in range(n - 7)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 8)}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in seen
            seen.add(line)
    failed = n < 20 or 100 * len(covered) > 30 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(covered), failed


def prose(n, seed):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(1, 9))) for _ in range(2000)]
    return " ".join(rng.choices(vocabulary, [1 / (i + 1) for i in range(2000)], k=n))


ROWS = [(1, None), (2, ""), (3, " \n\t"), (4, "one word | <b>"), (5, "a b c d e f g h " * 3), (6, "same line\nsame line\n \n \nother"),
        (7, prose(300, 1)), (7, prose(300, 1)), (8, prose(60, 2) + " " + prose(60, 2)), (None, prose(5000, 3)),
        (9, "\n".join(["x y"] * 50)), (10, "é" * 10 + "\x1c\x85 " + prose(30, 4)), (11, prose(40000, 5))]


def test_counts_against_brute_force(spark):
    frame = spark.createDataFrame([(*r, "z") for r in ROWS], "doc_id long, text string, kept string")
    got = sorted(tuple(r)[:7] for r in Q.judge(frame).drop("kept").collect() if r[0] is not None)
    assert got == sorted((i, *plain(t)) for i, t in ROWS if i is not None)
    assert Q.judge(frame.limit(0)).count() == 0


def test_bands():
    packer = zstandard.ZstdCompressor(level=Q.LEVEL)
    rng = random.Random(7)
    for n in (30, 100, 400, 2000, 20000):
        assert Q.bands_pass(prose(n, n).encode(), packer)
        noise = bytes(rng.choices(range(33, 127), k=6 * n))
        assert n < 100 or not Q.bands_pass(rng.randbytes(6 * n), packer), (n, len(noise))
        numbered = " ".join(f"item {i % 7} of the same list again" for i in range(n)).encode()
        assert not Q.bands_pass(numbered, packer)
    # repetition in one part of a long text is seen by its chunks
    half = prose(3000, 1).encode() + b"buy now " * 1200
    assert not Q.bands_pass(half, packer)
    assert not Q.bands_pass(b"", packer)


def test_bands_reject_encoded_and_random_text():
    packer, rng = zstandard.ZstdCompressor(level=Q.LEVEL), random.Random(3)
    for n in (500, 2000, 6000, 20000, 200000):
        for _ in range(10):
            mime = base64.encodebytes(rng.randbytes(n * 3 // 4))[:n]
            words = " ".join("".join(rng.choices(string.ascii_letters + string.digits, k=rng.randint(2, 10)))
                             for _ in range(n // 6 + 1)).encode()[:n]
            assert not Q.bands_pass(mime, packer) and not Q.bands_pass(words, packer), n
    # half of a long text is encoded
    assert not Q.bands_pass(prose(1000, 1).encode() + base64.encodebytes(rng.randbytes(6000)), packer)


def test_bands_keep_prose_of_every_language(spark):
    packer = zstandard.ZstdCompressor(level=Q.LEVEL)
    good = spark.read.parquet(f"{SF_MID}/documents.parquet").join(
        spark.read.parquet(f"{SF_MID}/labels.parquet").filter("quality = 1"), "doc_id").select("lang", "text").collect()
    judged = Counter()
    for r in good:
        if not plain(r["text"])[-1]:
            judged[r["lang"]] += 1
            assert Q.bands_pass(r["text"].encode(), packer), r
    assert len(judged) >= 4
    for letters in ("оеаинтсрвлкмдпу", "αοιετσνηυρπκμλ", "".join(map(chr, range(0x4E00, 0x4E00 + 1500)))):
        rng = random.Random(5)
        vocabulary = ["".join(rng.choices(letters, k=rng.randint(1, 3 if ord(letters[0]) > 0x3000 else 9))) for _ in range(3000)]
        for n in (100, 400, 2000, 20000):
            text = " ".join(rng.choices(vocabulary, [1 / (i + 1) for i in range(3000)], k=n))
            assert Q.bands_pass(text.encode(), packer), (letters[:3], n)


def test_whole_table_and_labels(spark):
    rows = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in Q.op5(spark, SF_SMALL).collect():
        assert tuple(r)[1:7] == plain(rows[r["doc_id"]])
    got = Q.op5(spark, SF_MID).join(spark.read.parquet(f"{SF_MID}/labels.parquet"), "doc_id").filter("NOT base_failed")
    good = got.filter("quality = 1")
    assert good.filter("kept").count() == good.count() > 0
