"""Language ID: Viterbi against brute force, held-out accuracy, edge cases."""

import itertools

import numpy as np
from pyspark.sql import functions as F

from tabula.llm import langid as X
from tests.conftest import SF_MID


def test_viterbi_against_every_path():
    rng = np.random.default_rng(3)
    lengths = np.array([0, 1, 4, 6, 2, 0, 5])
    scores = -rng.random((lengths.sum(), 3)) * 6
    starts = np.cumsum(lengths) - lengths
    label = X.viterbi(scores, starts, lengths, switch=2.0)
    for a, n in zip(starts, lengths):
        cost = lambda p: sum(scores[a + i, k] for i, k in enumerate(p)) - 2.0 * sum(x != y for x, y in zip(p, p[1:]))
        if n:
            best = max(map(cost, itertools.product(range(3), repeat=n)))
            assert abs(cost(label[a:a + n]) - best) < 1e-9


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    got = X.op8(spark, SF_MID).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    assert got.filter("lang_pred = lang").count() >= 0.98 * got.count() > 0
    assert X.op8(spark, SF_MID).count() == docs.count()


def test_mixed_text_and_edges(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    model = X.train(docs)
    en, de = "the and of that with this. " * 6, "und der nicht die das einheit! " * 6
    rows = [(1, en + de), (1, en), (2, None), (3, ""), (4, "12 !? \n"), (5, "Привет"), (None, de), (6, de * 4000)]
    frame = spark.createDataFrame([(*r, "zz") for r in rows], "doc_id long, text string, lang string")
    got = dict(enumerate(X.identify(frame, model).collect()))
    assert len(got) == len(rows)
    mixed = next(r for r in got.values() if len(r["lang_spans"]) == 2)
    assert [s["lang"] for s in mixed["lang_spans"]] == ["en", "de"]
    assert (en + de)[mixed["lang_spans"][1]["start"]:].startswith("und der") and 0.4 < mixed["score"] < 0.7
    for r in got.values():
        assert 0 <= r["score"] <= 1
        if r["doc_id"] in (2, 3, 4):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    assert next(r for r in got.values() if r["doc_id"] is None)["lang_pred"] == "de"
    assert next(r for r in got.values() if r["doc_id"] == 6)["lang_pred"] == "de"
    assert next(r for r in got.values() if r["doc_id"] == 5)["lang_pred"] != "und"


def test_scripts_narrow_candidates(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("привет мир да", "ru"), ("hello world yes", "en"), ("שלום עולם", "he")] * 5)]
    model = X.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    ask = spark.createDataFrame([(1, "свет"), (2, "אבא"), (3, "word")], "doc_id long, text string")
    assert {r["doc_id"]: r["lang_pred"] for r in X.identify(ask, model).collect()} == {1: "ru", 2: "he", 3: "en"}


def test_nothing_to_learn(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = X.train(empty)
    ask = spark.createDataFrame([(1, "words"), (2, None)], "doc_id long, text string")
    assert {r["lang_pred"] for r in X.identify(ask, model).collect()} == {"und"}
    assert X.identify(empty, model).count() == 0
    assert X.train(ask.withColumn("lang", F.lit(None).cast("string"))).languages == []
