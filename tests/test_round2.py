"""Diagnostics, metrics and draws against independent values."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabula.functions.random import draw_int
from tabula.operators import diagnose as D
from tabula.operators import encode, evaluate, models, neighbors
from tabula.plans.scale import quantiles


def test_log_tail_against_erfc(spark):
    xs = [0.0, 0.5, 1.0, 2.0, 3.0, 5.0, 7.0, 7.2, 10.0, 20.0, 35.0]
    got = {r[0]: r[1] for r in spark.createDataFrame([(x,) for x in xs], "x double")
           .select("x", D.log_upper_tail(F.col("x"))).collect()}
    for x in xs:
        assert got[x] == pytest.approx(math.log(0.5 * math.erfc(x / math.sqrt(2))), rel=1e-6, abs=1e-9)


def test_normality_of_normal_and_uniform_columns(spark):
    rng = np.random.default_rng(1)
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(rng.normal(5, 2, 3000), rng.random(3000)))]
    frame = spark.createDataFrame([*rows], "k long, a double, b double")
    normal = D.anderson_darling(frame, "a", "k").first()
    flat = D.anderson_darling(frame, "b", "k").first()
    assert normal["is_normal"] and 0.05 < normal["p_value"] <= 1
    assert not flat["is_normal"] and flat["p_value"] == 0.0 and flat["ad_adjusted"] > 13
    far = frame.select("k", F.when(F.col("k") == 0, 1e6).otherwise(F.col("a")).alias("a"))
    assert D.anderson_darling(far, "a", "k").first()["p_value"] == 0.0


def test_vif_of_collinear_features(spark):
    frame = spark.createDataFrame([(float(i), 2.0 * i, float(i * 7 % 5)) for i in range(1, 50)], "a double, b double, c double")
    got = {r["feature"]: r["vif"] for r in D.vif(frame, ["a", "b", "c"]).collect()}
    assert math.isinf(got["a"]) and math.isinf(got["b"]) and got["c"] < 100
    assert tuple(D.vif_verdict(D.vif(frame, ["a", "b", "c"])).first()) == (2, 2, "certain")


def test_micro_f1_with_three_classes(spark):
    frame = spark.createDataFrame([(0, 0.1), (1, 0.9), (2, 0.1), (2, 0.9), (1, 0.2)], "y int, s double")
    f = evaluate.f1_by_threshold(frame, "y", "s", grid=[0.5], average="micro").first()
    assert f["f1"] == pytest.approx(0.4)


def test_quantiles_with_a_hot_value(spark):
    rng = random.Random(2)
    values = [7.0] * 700 + [rng.random() * 20 for _ in range(1300)] + [0.0, -0.0]
    frame = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double")
    ps = [0, 0.01, 0.25, 0.5, 0.51, 0.9, 1]
    assert quantiles(frame, "v", ps) == pytest.approx(list(np.quantile(values, ps)))
    assert quantiles(frame.limit(0), "v", [0.5]) == [None]


def test_draws_differ_beyond_the_modulus(spark):
    p = 2**31 - 1
    keys = [5, 5 + p, 5 + 2 * p, 5 + 3 * p]
    got = [r[0] for r in spark.createDataFrame([(k,) for k in keys], "k long").select(draw_int("k")).collect()]
    assert len(set(got)) == len(keys)


def test_noise_is_replayable(spark):
    frame = spark.createDataFrame([(i, "ab"[i % 2], float(i)) for i in range(40)], "k long, g string, y double")
    run = lambda n: sorted(map(tuple, encode.target_encode(
        frame.repartition(n), frame, "g", "y", noise_level=0.1, key="k")[0].select("k", "g_mean").collect()))
    assert run(1) == run(5) and len({v for _, v in run(1)}) == 40
    with pytest.raises(ValueError):
        encode.target_encode(frame, frame, "g", "y", noise_level=0.1)


def test_smote_needs_two_rows(spark):
    frame = spark.createDataFrame([(1, 0, [1.0]), (2, 1, [2.0]), (3, 1, [3.0])], "k long, y int, v array<double>")
    with pytest.raises(ValueError):
        neighbors.oversample_smote(frame, "y", "k", "v")


def test_imputed_integers_stay_integers(spark):
    frame = spark.createDataFrame([(i, float(i), None if i % 5 == 0 else 3 * i) for i in range(60)], "k long, x double, y long")
    filled, _ = models.impute_model(frame, "y", "k", num_trees=5)
    assert dict(filled.dtypes)["y"] == "bigint" and filled.columns == frame.columns
    assert filled.filter("y IS NULL").count() == 0
    assert filled.filter("k % 5 <> 0 AND y <> 3 * k").count() == 0


def test_random_search_counts_settings(spark):
    with pytest.raises(ValueError):
        models.random_search(None, {"a": [1, 2]}, None, None, "k", iterations=3)


def test_rfe_scores_every_size_by_folds(spark, monkeypatch):
    from pyspark.ml.classification import LogisticRegression
    from tabula.operators.sample import split_kfold
    from tabula.plans import q_models
    from tests.conftest import SF_SMALL
    monkeypatch.setattr(q_models, "EMB_F", q_models.EMB_F[:6])
    got = q_models.q_rfe_logistic(spark, SF_SMALL).collect()
    assert [r["n_features"] for r in got] == [6, 5, 4, 3]
    assert all(set(b["features"].split(",")) < set(a["features"].split(",")) for a, b in zip(got, got[1:]))
    last, hits = got[-1]["features"].split(","), []
    rows = split_kfold(q_models._emb(spark, SF_SMALL, binary=True), "vec_id", 5, 46)
    for k in range(5):
        model = LogisticRegression(maxIter=50).fit(models.assemble(rows.filter(f"fold <> {k}"), last, "label"))
        part = model.transform(models.assemble(rows.filter(f"fold = {k}"), last, "label"))
        hits.append(part.filter("prediction = label").count() / part.count())
    assert got[-1]["accuracy"] == pytest.approx(sum(hits) / 5)


def test_lda_words_come_from_spark(spark, monkeypatch):
    from pyspark.ml.feature import CountVectorizerModel
    from tabula.operators import text

    def driver_list(self):
        raise AssertionError("the vocabulary went to the driver")
    monkeypatch.setattr(CountVectorizerModel, "vocabulary", property(driver_list))
    rng = random.Random(4)
    subjects = (["cat", "dog", "cow", "hen"], ["sun", "rain", "wind", "snow"])
    rows = [(i // 2, rng.choices(subjects[i % 2], k=30)) for i in range(60)] + [(99, [])]
    frame = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    topics, assigned, sizes = text.topics_lda(frame, "doc_id", "tokens", num_topics=2, num_words=4, max_iter=40)
    found = {}
    for r in topics.collect():
        found.setdefault(r["topic"], set()).add(r["word"])
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, subjects))
    assert assigned.count() == 61 == sizes.agg(F.sum("n_docs")).first()[0]  # rows, though ids repeat


def test_random_search_query_is_a_forest_over_all_dimensions(spark, monkeypatch):
    from pyspark.ml.classification import RandomForestClassifier
    from tabula.plans import q_models
    from tests.conftest import SF_SMALL
    seen = {}

    def search(estimator, space, data, evaluator, key, iterations=50, folds=5):
        seen.update(estimator=estimator, iterations=iterations, folds=folds, size=len(data.first()["features"]),
                    settings=math.prod(map(len, space.values())))
        return None, None
    monkeypatch.setattr(models, "random_search", search)
    q_models.q_random_search(spark, SF_SMALL)
    assert isinstance(seen.pop("estimator"), RandomForestClassifier)
    assert seen == {"iterations": 50, "folds": 5, "size": 64, "settings": 216}


def test_profile_of_many_columns_in_one_pass(spark):
    from tabula.operators.missing import profile_columns

    rng = random.Random(6)
    big = 2**60
    rows = [(i, 7.0 if i % 3 else rng.random() * 10, rng.choice([None, float("nan"), -1.5, 2.0]), big + i % 5, rng.choice("abc"), None)
            for i in range(1500)]
    frame = spark.createDataFrame(rows, "k long, hot double, gaps double, big long, name string, none double").repartition(5)
    got = {r["column_name"]: r for r in profile_columns(frame).collect()}
    for c, at in (("k", 0), ("hot", 1), ("gaps", 2)):
        own = [r[at] for r in rows if r[at] is not None and r[at] == r[at]]
        want = np.quantile(own, [0.25, 0.5, 0.75])
        assert [got[c]["p25"], got[c]["p50"], got[c]["p75"]] == pytest.approx(list(want)) and got[c]["n_distinct"] == len(set(own))
    assert got["big"]["n_distinct"] == 5 and got["name"]["n_distinct"] == 3
    assert got["none"]["n_distinct"] == 0 and got["none"]["p50"] is None and got["none"]["n_missing"] == 1500
    assert profile_columns(frame.limit(0)).count() == 6


def test_slices_of_a_checkpointed_frame(spark):
    from tabula.plans.scale import _num_partitions

    frame = spark.range(1000).repartition(23)
    assert _num_partitions(frame.checkpoint(), None) >= 23
    assert _num_partitions(frame.select("id"), None) == int(spark.conf.get("spark.sql.shuffle.partitions"))
