"""Topic weights as a table: the same numbers as the loops of the published
algorithm, at least Spark's likelihood bound, and odd input."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabula.operators import topics

from .conftest import SF_MID


def _bound_per_word(documents, weights, alpha, eta):
    """Variational bound of the log likelihood per token, by plain loops over documents."""
    names = {w: i for i, w in enumerate(weights)}
    lam = np.array([weights[w] for w in names])
    mean_log = topics.digamma(lam) - topics.digamma(lam.sum(0))
    beta, total, tokens = np.exp(mean_log), 0.0, 0
    lgamma = np.vectorize(math.lgamma)
    for words in documents:
        places, counts = np.unique([names[w] for w in words], return_counts=True)
        gamma, _ = topics.document_posteriors(np.array([0]), counts.astype(float), beta[places], alpha, 1e-6, 500)
        g = gamma[0]
        theta = topics.digamma(g) - topics.digamma(g.sum())
        total += (counts * np.log(np.exp(theta + mean_log[places]).sum(1))).sum()
        total += ((alpha - g) * theta).sum() + lgamma(g).sum() - len(g) * math.lgamma(alpha)
        total += math.lgamma(len(g) * alpha) - math.lgamma(g.sum())
        tokens += counts.sum()
    v = len(lam)
    total += ((eta - lam) * mean_log).sum() + lgamma(lam).sum() - lam.size * math.lgamma(eta)
    total += lam.shape[1] * math.lgamma(v * eta) - lgamma(lam.sum(0)).sum()
    return total / tokens


def _written(model):
    return {r["word"]: [model.eta + r[f"u{j}"] * model.scale for j in range(model.k)] for r in model.units().collect()}


def test_digamma():
    x = np.array([1.0, 0.5, 2.0, 10.0, 0.01])
    euler = 0.5772156649015329
    want = [-euler, -euler - 2 * math.log(2), 1 - euler, sum(1 / i for i in range(1, 10)) - euler]
    assert topics.digamma(x)[:4] == pytest.approx(want, abs=1e-11)
    assert topics.digamma(x)[4] == pytest.approx(topics.digamma([1.01])[0] - 100, abs=1e-9)


def test_posteriors_of_documents_side_by_side_equal_one_by_one():
    rng = np.random.default_rng(3)
    sizes = [1, 400, 7, 30, 2]
    starts = np.append(0, np.cumsum(sizes)[:-1])
    counts, beta = rng.integers(1, 5, sum(sizes)).astype(float), rng.random((sum(sizes), 3))
    gamma, shares = topics.document_posteriors(starts, counts, beta, 1 / 3, 1e-3, 100)
    for i, (a, n) in enumerate(zip(starts, sizes)):
        g = np.ones(3)
        for _ in range(100):
            theta = np.exp(topics.digamma(g) - topics.digamma(g.sum()))
            new = np.full(3, 1 / 3)
            for c in range(a, a + n):
                new += counts[c] * theta * beta[c] / (theta * beta[c]).sum()
            done, g = np.abs(new - g).mean() < 1e-3, new
            if done:
                break
        assert gamma[i] == pytest.approx(g) and shares[a:a + n].sum() == pytest.approx(counts[a:a + n].sum())


def test_steps_of_the_table_equal_dense_steps(spark):
    """Words missing from a batch decay, merged parts lose nothing."""
    rng = random.Random(2)
    model = topics.TopicWeights(spark, 2, 6, 0.5, 46)
    dense = {w: np.full(2, np.nan) for w in "abcdef"}
    for i in range(topics.MERGE + 3):
        rows = [(w, rng.random(), rng.random()) for w in rng.choices("abcdef", k=4)]
        model.step(lambda times: spark.createDataFrame([(w, a * times, b * times) for w, a, b in rows], "word string, u0 double, u1 double"),
                   (1 + i) ** -0.5, 3.0)
        rho = (1 + i) ** -0.5
        for w in dense:
            found = sum((np.array(r[1:]) for r in rows if r[0] == w), np.zeros(2))
            dense[w] = (np.zeros(2) if i == 0 else (1 - rho) * dense[w]) + rho * (0.5 + 3.0 * found)
        got = _written(model)
        for w, want in dense.items():
            assert got.get(w, [0.5, 0.5]) == pytest.approx(list(want))
        assert model.totals == pytest.approx(list(sum(dense.values())))
        assert len(model.parts) < topics.MERGE


def test_bound_reaches_that_of_the_driver_model(spark, monkeypatch):
    """Filtered documents of sf0.01, 5 topics, 15 steps: at most 1 % below Spark's LDA."""
    from pyspark.ml.clustering import LDA
    from pyspark.ml.feature import CountVectorizer
    from tabula.plans.q_text import _filtered

    models = []
    start = topics.TopicWeights.__init__
    monkeypatch.setattr(topics.TopicWeights, "__init__", lambda self, *a: (start(self, *a), models.append(self))[0])
    docs = _filtered(spark, SF_MID).select("doc_id", "filtered")
    topics.topics_lda(docs, "doc_id", "filtered")
    own = _written(models[0])
    counter = CountVectorizer(inputCol="filtered", outputCol="v", vocabSize=1 << 22).fit(docs)
    fit = LDA(k=5, maxIter=15, optimizer="online", seed=46, featuresCol="v", optimizeDocConcentration=False).fit(counter.transform(docs))
    spark_lam = fit.topicsMatrix().toArray()
    texts = [r["filtered"] for r in docs.collect() if r["filtered"]]
    assert set(own) == {w for words in texts for w in words}
    theirs = dict(zip(counter.vocabulary, spark_lam))
    mine, other = (_bound_per_word(texts, w, 0.2, 0.2) for w in (own, theirs))
    assert mine >= other - 0.01 * abs(other)


def test_odd_documents(spark):
    rows = [(1, ["a", "b", None]), (1, ["a", "b"]), (None, ["a"]), (4, None), (5, []), (6, ["x"] * 5000)]
    frame = spark.createDataFrame(rows, "doc_id long, tokens array<string>").withColumn("word", F.lit("own"))
    found, assigned, sizes = topics.topics_lda(frame, "doc_id", "tokens", num_topics=2, num_words=2)
    assert found.columns == ["topic", "rank", "word", "weight"]
    assert sorted((r["topic"], r["rank"]) for r in found.collect()) == [(0, 0), (0, 1), (1, 0), (1, 1)]
    got = [(r["doc_id"], r["topic"]) for r in assigned.collect()]
    assert len(got) == 6 == sizes.agg(F.sum("n_docs")).first()[0] and (4, 0) in got and (5, 0) in got
    assert len({t for d, t in got if d == 1}) == 1
    empty, none, _ = topics.topics_lda(frame.limit(0), "doc_id", "tokens")
    assert empty.count() == 0 == none.count()
    bare = topics.topics_lda(frame.filter("doc_id in (4, 5)"), "doc_id", "tokens")
    assert bare[0].count() == 0 and [tuple(r) for r in bare[2].collect()] == [(0, 2)]


def test_every_block_is_built_once_and_a_batch_has_work_for_the_cores(spark, monkeypatch, tmp_path):
    build, log = topics.block_rows, str(tmp_path)

    def logged(documents):
        import uuid
        block = documents.column("_block")[0].as_py()
        open(f"{log}/{block}-{uuid.uuid4().hex}", "w").close()
        return build(documents)
    frame = spark.range(400).select(F.col("id").alias("doc_id"), F.transform(F.sequence(F.lit(1), F.lit(9)), lambda i: F.concat(
        F.lit("w"), (F.col("id") * i % 50).cast("string"))).alias("tokens"))
    want = topics.topics_lda(frame, "doc_id", "tokens", num_topics=2, batches=3, max_iter=3)[0].toPandas()
    monkeypatch.setattr(topics, "block_rows", logged)
    monkeypatch.setattr(topics, "LEAST_CELLS", 200)
    got = topics.topics_lda(frame, "doc_id", "tokens", num_topics=2, batches=3, max_iter=3)[0].toPandas()
    built = [int(f.name.split("-")[0]) for f in tmp_path.iterdir()]
    assert len(built) == len(set(built)) == 3 * min(spark.sparkContext.defaultParallelism, 400 * 9 * 2 // 3 // 200)
    order = ["topic", "rank"]
    got, want = got.sort_values(order), want.sort_values(order)
    assert list(got["word"]) == list(want["word"]) and np.allclose(got["weight"], want["weight"])
