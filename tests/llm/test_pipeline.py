"""Pipeline stages against plain Python, each on its own input."""

import inspect
import random
import re

import pytest

import corpus_pipeline as C
from tabula.llm import langid
from tests.conftest import SF_SMALL
from tests.llm.test_packing import FILE, check
from tests.llm.test_secrets import brute
from tests.llm.test_simhash import plain_classes
from tokenizers import Tokenizer

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_contract():
    assert 4 <= len(C.STAGES) <= 5 and C.ORACLE_SQL is None
    for name, stage in C.STAGES:
        assert list(inspect.signature(stage).parameters) == ["spark", "docs", "sf_dir"]


def plain_dedup(rows):
    first = {}
    for r in rows:
        key = re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")
        if r[0] is not None:
            first[key] = min(first.get(key, r[0]), r[0])
    return [r for r in rows if first.get(re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")) == r[0]]


def plain_near(rows):
    own = {(i, c) for i, _, c in plain_classes([(r[0], r[1]) for r in rows])}
    return [r for r in rows if (r[0], r[0]) in own]


def squeezed(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def one_each(rows, group):
    """One row of every group, by the smallest id (none last)."""
    best = {}
    for r, g in zip(rows, group):
        order = (r[0] is None, r[0] or 0)
        if g not in best or order < best[g][0]:
            best[g] = (order, r)
    return [r for _, r in best.values()]


def plain_secrets(rows):
    out = []
    for r in rows:
        text, pos, new = r[1], 0, ""
        if text is None:
            out.append(r)
            continue
        for a, _, b in brute(text):
            if a >= pos or pos == 0:
                new += text[pos:a] + "[REDACTED]"
            pos = max(pos, b)
        new += text[pos:]
        out.append((r[0], new, r[2], r[3], len(new)))
    return out


def test_whole_run(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select(*COLUMNS).collect()]
    pred = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs, langid.train_split(docs)).collect()}
    steps = [[r for r in rows if pred[r[0]] != "und"]]
    for plain in (plain_dedup, plain_near, plain_secrets):
        steps.append(plain(steps[-1]))
    frame = docs
    for (name, stage), want in zip(C.STAGES[:-1], steps):
        frame = stage(spark, frame, SF_SMALL)
        assert frame.columns == docs.columns
        assert sorted(map(tuple, frame.select(*COLUMNS).collect()), key=repr) == sorted(want, key=repr), name
    library = Tokenizer.from_file(FILE)
    want = {r[0]: library.encode(r[1] or "", add_special_tokens=False).ids + [0] for r in steps[-1]}
    assert check(C.run(spark, SF_SMALL).collect(), want).keys() == want.keys()


def odd_rows():
    rng = random.Random(8)
    text = lambda: " ".join(rng.choice(["und", "the", "la", "x"]) + str(rng.randint(0, 50)) for _ in range(40))
    base = text()
    return [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "123 !", None, "s", 5), (4, base, "en", "s", None),
            (5, base.replace(" ", "  "), "en", "t", 9), (6, base, None, None, 1), (7, text() + " secret=abcdefgh", "de", "s", 3),
            (7, text(), "de", "s", 3), (8, "word " * 50000, "en", "s", 1), (9, text(), None, "s", 2)]


@pytest.mark.parametrize("name", [n for n, _ in C.STAGES])
def test_odd_rows_and_extra_columns(spark, name):
    stage = dict(C.STAGES)[name]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    extra = ", key string, row string, spans string, lang_pred string"
    frame = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in odd_rows()], schema + extra)
    got = stage(spark, frame, SF_SMALL)
    if name != "packing":
        assert sorted(got.columns) == sorted(frame.columns)
    assert got.count() > 0
    names = ", _kept string, _spans string, _hit_id string, _hit_rules string, _own_spans string, _lang string, k string, " \
            "listed string, c0 string, keep_id string"
    base = odd_rows()[3][1]
    rows = odd_rows() + [(3, base, "en", "s", 1), (7, base, "en", "s", 1), (None, base, "en", "s", 1), (9, base, "en", "s", 1),
                         (9, base, "en", "s", 1), (None, "no id at all", "en", "s", 1), (None, None, None, None, None)]
    clash = spark.createDataFrame([(*r, *"abcdefghij") for r in rows], schema + names)
    got = stage(spark, clash, SF_SMALL)
    kept = [tuple(r) for r in got.collect()]
    if name == "exact_dedup":
        want = one_each(rows, [squeezed(r[1]) for r in rows])
    elif name == "near_dedup":
        # ids of their own for rows that share one, in the order of the stage
        order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
        group = {i: c for i, _, c in plain_classes([(n, rows[i][1]) for n, i in enumerate(order)])}
        want = one_each([rows[i] for i in order], [group[n] for n in range(len(order))])
    elif name == "secrets":
        want = plain_secrets(rows)
    if name in ("exact_dedup", "near_dedup", "secrets"):
        assert got.columns == clash.columns and all(r[5:] == tuple("abcdefghij") for r in kept)
        assert sorted((r[0] is None, r[0], squeezed(r[1])) for r in kept) == sorted(
            (r[0] is None, r[0], squeezed(r[1])) for r in want) if name != "secrets" else \
            sorted(map(repr, (r[:2] for r in kept))) == sorted(map(repr, (r[:2] for r in want)))
    elif name == "language_id":
        assert got.columns == clash.columns and all(r[5:] == tuple("abcdefghij") for r in kept)
    assert stage(spark, frame.limit(0), SF_SMALL).count() == 0
