"""``topics_lda``: online variational Bayes for latent Dirichlet allocation, with
the topic-word weights as a Spark table keyed by word.

Documents lie in blocks of about ``BLOCK_CELLS / num_topics`` tokens, blocks in
batches, all dealt by a hash of the row; one step takes one batch. A step looks
up the weights of a block's distinct words by an equi-join, brings them to the
block's documents in a cogroup (the document posteriors are numpy work inside
the task) and sums the expected counts by word. The driver holds the batches'
document counts and, per topic, one sum of weights. Nothing of the size of the
vocabulary or the corpus passes through it.

The weights are ``eta + scale * units``. A step multiplies ``scale`` by
``1 - rho`` and writes ``rho * counts / scale`` for the words of its batch only,
so a word that is not in the batch costs nothing. Every ``MERGE`` steps the
written parts are summed into one table, which also sets the scale back to 1;
the summed parts, which no later plan reads, are deleted.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.random import draw_uniform
from ..plans.scale import one_row
from ..session import shared_path

#: Tokens times topics of a block: what one cogroup holds, beside its longest document.
BLOCK_CELLS = 1 << 22
#: A batch has as many blocks as the session has cores, if they hold so many then.
LEAST_CELLS = 1 << 19
#: Written parts of the weights that a step reads at most.
MERGE = 4


def digamma(x):
    """The logarithmic derivative of the gamma function, for positive arrays."""
    x, out = np.array(x, dtype=float), 0.0
    for _ in range(6):  # up to where the asymptotic series holds to 1e-12
        out = out - 1.0 / x
        x = x + 1.0
    s = 1.0 / (x * x)
    return out + np.log(x) - 0.5 / x - s * (1 / 12 - s * (1 / 120 - s * (1 / 252 - s * (1 / 240 - s / 132))))


def document_posteriors(starts, counts, beta, alpha: float, tol: float, rounds: int):
    """``(gamma, shares)`` of documents given as runs of (word, count) cells.

    ``starts`` are the documents' first cells, ``beta`` the exponentiated mean
    log weights of every cell's word. Rounds go on per document until the mean
    change of its gamma is below ``tol``, at most ``rounds`` times; documents
    that are done leave the arrays once they are half of them. ``shares`` are the
    expected counts of every cell by topic.
    """
    n, k = len(starts), beta.shape[1]
    doc = np.repeat(np.arange(n), np.diff(np.append(starts, len(counts))))
    gamma = np.ones((n, k))
    live, at, d, c, b = np.arange(n), starts, doc, counts, beta
    moving = np.ones(n, dtype=bool)
    for _ in range(rounds):
        g = gamma[live]
        theta = np.exp(digamma(g) - digamma(g.sum(1))[:, None])
        norm = np.einsum("ij,ij->i", theta[d], b) + 1e-100
        new = alpha + theta * np.add.reduceat(b * (c / norm)[:, None], at, axis=0)
        gamma[live[moving]] = new[moving]
        moving &= np.abs(new - g).mean(1) >= tol
        if not moving.any():
            break
        if moving.sum() * 2 <= len(live):
            keep, sizes = moving[d], np.diff(np.append(at, len(c)))[moving]
            live, at, c, b = live[moving], np.append(0, np.cumsum(sizes)[:-1]), c[keep], b[keep]
            d, moving = np.repeat(np.arange(len(live)), sizes), np.ones(len(live), dtype=bool)
    theta = np.exp(digamma(gamma) - digamma(gamma.sum(1))[:, None])[doc]
    norm = np.einsum("ij,ij->i", theta, beta) + 1e-100
    return gamma, theta * beta * (counts / norm)[:, None]


BLOCK_ROWS = "_block long, _batch int, _row long, places array<int>, counts array<int>, place int, word string"


def block_rows(documents: pa.Table) -> pa.Table:
    """The rows that a block is written as: its distinct words, numbered from 0, and
    its documents as places in that list with counts."""
    tokens = documents.column("_tokens").combine_chunks()
    coded = tokens.flatten().dictionary_encode()
    lengths = pc.list_value_length(tokens).to_numpy(zero_copy_only=False)
    codes, size, n = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(coded.dictionary), len(lengths)
    cells, counts = np.unique(np.repeat(np.arange(n), lengths) * size + codes, return_counts=True)
    ends = pa.array(np.append(np.searchsorted(cells, np.arange(n) * size), len(cells)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32))) for x in (cells % size, counts)]
    block, batch = (documents.column(c)[0].as_py() for c in ("_block", "_batch"))

    def table(rows, *columns):
        return pa.table([pa.array([block] * rows, pa.int64()), pa.array([batch] * rows, pa.int32()), *columns],
                        names=["_block", "_batch", "_row", "places", "counts", "place", "word"])
    of_documents = table(n, documents.column("_row"), *lists, pa.nulls(n, pa.int32()), pa.nulls(n, pa.string()))
    of_words = table(size, pa.nulls(size, pa.int64()), *[pa.nulls(size, pa.list_(pa.int32()))] * 2,
                     pa.array(np.arange(size, dtype=np.int32)), coded.dictionary.cast(pa.string()))
    return pa.concat_tables([of_documents, of_words])


def _posteriors(documents: pa.Table, looked: pa.Table, scale, eta, mean_log_total, alpha, tol, rounds):
    k, order = len(mean_log_total), np.argsort(looked.column("place").to_numpy())
    weights = np.column_stack([looked.column(f"u{j}").to_numpy() for j in range(k)])[order] * scale + eta
    beta = np.exp(digamma(weights) - np.asarray(mean_log_total))
    places, counts = (documents.column(c).combine_chunks() for c in ("places", "counts"))
    sizes = pc.list_value_length(places).to_numpy(zero_copy_only=False)
    place = places.flatten().to_numpy(zero_copy_only=False)
    gamma, shares = document_posteriors(np.append(0, np.cumsum(sizes)[:-1]), counts.flatten().to_numpy(zero_copy_only=False).astype(float),
                                        beta[place], alpha, tol, rounds)
    return documents.column("_row"), place, looked.column("word").take(pa.array(order)), gamma, shares


class TopicWeights:
    """The written weights: ``eta + scale * units`` for every word."""

    def __init__(self, spark, num_topics: int, vocabulary: int, eta: float, seed: int):
        self.spark, self.k, self.v, self.eta, self.seed = spark, num_topics, vocabulary, eta, seed
        self.parts, self.scale, self.sums = [], 1.0, None

    @property
    def totals(self) -> list:
        """Sum of the weights of each topic over the vocabulary."""
        if self.sums is None:
            return [float(self.v)] * self.k
        return [self.v * self.eta + s for s in self.sums]

    def read(self, *paths) -> DataFrame:
        return self.spark.read.schema("word string, " + ", ".join(f"u{j} double" for j in range(self.k))).parquet(*paths)

    def units(self) -> DataFrame:
        if len(self.parts) == 1:
            return self.read(*self.parts)  # holds every word once
        return self.read(*self.parts).groupBy("word").agg(*[F.sum(f"u{j}").alias(f"u{j}") for j in range(self.k)])

    def of(self, words: DataFrame) -> DataFrame:
        """``words`` with their units ``u0, u1, ...``. Before the first step the weights
        are draws around 1 with deviation 0.1, keyed by word and topic."""
        if not self.parts:
            key = F.xxhash64("word")

            def start(j):
                radius = F.sqrt(F.log(1.0 - draw_uniform(key, self.seed + 2 * j)) * -2.0)
                return F.greatest(F.lit(0.01), radius * F.cos(draw_uniform(key, self.seed + 2 * j + 1) * (2 * math.pi)) * 0.1 + 1.0)
            return words.select("*", *[(start(j) - self.eta).alias(f"u{j}") for j in range(self.k)])
        return words.join(self.units(), "word", "left").select(
            *words.columns, *[F.coalesce(f"u{j}", F.lit(0.0)).alias(f"u{j}") for j in range(self.k)])

    def step(self, counts, rho: float, factor: float) -> None:
        """Move to ``(1 - rho) * weights + rho * (eta + factor * counts)``. The first
        step replaces the starting draws whole, whatever ``rho``.

        ``counts(times)`` gives rows (word, u0, u1, ...) with the counts times the number
        ``times``, several for a word from different blocks. The number is applied by
        the caller's kernel: as a literal it would make new code of every step."""
        if self.sums is None:
            rho, self.sums = 1.0, [0.0] * self.k
            scale = 1.0
        else:
            scale = self.scale * (1.0 - rho)
            self.sums = [s * (1.0 - rho) for s in self.sums]
        path = shared_path(self.spark, "lda-weights")
        rows = counts(rho * factor / scale)
        rows.groupBy("word").agg(*[F.sum(f"u{j}").alias(f"u{j}") for j in range(self.k)]).write.parquet(path)
        added = one_row(self.read(path), *[F.sum(f"u{j}").alias(f"u{j}") for j in range(self.k)])
        self.scale = scale
        self.sums = [s + (added[f"u{j}"] or 0.0) * scale for j, s in enumerate(self.sums)]
        self.parts.append(path)
        if len(self.parts) >= MERGE:
            self.merge()

    def merge(self) -> DataFrame:
        """One table (word, u0, u1, ...) with scale 1 in place of the parts."""
        path = shared_path(self.spark, "lda-weights")
        self.units().select("word", *[(F.col(f"u{j}") * self.scale).alias(f"u{j}") for j in range(self.k)]).write.parquet(path)
        merged, self.parts, self.scale = self.parts, [path], 1.0
        for old in merged:
            place = self.spark._jvm.org.apache.hadoop.fs.Path(old)
            place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)
        return self.read(path)


def topics_lda(df: DataFrame, doc_col: str, tokens_col: str, num_topics: int = 5, num_words: int = 4,
               max_iter: int = 15, seed: int = 46, batches: int = 15, tol: float = 1e-3, rounds: int = 100,
               offset: float = 1.0, decay: float = 0.5):
    """``topics_lda``: returns ``(topics, assignments, sizes)``: the top words with
    their weights per topic (rank from 0, ties by word), the dominant topic per
    document (first on ties), and documents per topic.

    ``max_iter`` steps go through ``batches`` disjoint batches in turn, with the
    step size ``(offset + step) ** -decay`` and both priors ``1 / num_topics``; the
    default is one pass over all documents. Empty batches are passed over.

    NULL tokens are left out. A document without tokens (or with a NULL list) has
    the prior and so topic 0. Rows with equal ids are documents of their own.
    Without any token there are no topic rows.
    """
    spark, k = df.sparkSession, num_topics
    alpha = eta = 1.0 / k
    names = [f"u{j}" for j in range(k)]
    # the row numbers are frozen by the write, so that later deals of the rows agree
    path = shared_path(spark, "lda-rows")
    kept = F.filter(tokens_col, lambda w: w.isNotNull())
    (df.select(F.col(doc_col), F.monotonically_increasing_id().alias("_row"),
               F.coalesce(kept, F.array().cast("array<string>")).alias("_tokens"))
     .withColumn("_size", F.size("_tokens").cast("long")).write.parquet(path))
    rows = spark.read.parquet(path)
    size = one_row(rows, F.sum("_size").alias("n"))["n"] or 0
    cores, of_batch = spark.sparkContext.defaultParallelism, -(-size * k // batches)
    blocks = batches * max(1, -(-of_batch // BLOCK_CELLS), min(cores, of_batch // LEAST_CELLS))
    path = shared_path(spark, "lda-blocks")
    dealt = rows.filter("_size > 0").select(
        "_row", "_tokens", F.pmod(F.xxhash64("_row", F.lit(seed)), F.lit(blocks)).alias("_block"))
    # written by the tasks that build them: a range partitioning would build them once more for its sample
    (dealt.withColumn("_batch", (F.col("_block") % batches).cast("int")).groupBy("_block").applyInArrow(block_rows, BLOCK_ROWS)
     .write.partitionBy("_batch").parquet(path))
    vocabulary = 0
    if size:
        dealt_blocks = spark.read.schema(BLOCK_ROWS).parquet(path)
        vocabulary = dealt_blocks.filter("word IS NOT NULL").select("word").distinct().count()  # once a block, not once a token
        held = {r["_batch"]: r["n"] for r in dealt_blocks.groupBy("_batch").agg(F.count("_row").alias("n")).collect()}
        order = sorted(held)
    model = TopicWeights(spark, k, vocabulary, eta, seed)

    def cogroup(part, kernel, schema):
        documents = part.filter("_row IS NOT NULL").select("_block", "_row", "places", "counts")
        looked = model.of(part.filter("word IS NOT NULL").select(F.col("_block").alias("_of"), "place", "word"))
        scale, mean_log_total = model.scale, digamma(model.totals).tolist()

        def of_block(left: pa.Table, right: pa.Table) -> pa.Table:
            return kernel(*_posteriors(left, right, scale, eta, mean_log_total, alpha, tol, rounds))
        return documents.groupBy("_block").cogroup(looked.groupBy("_of")).applyInArrow(of_block, schema)

    def word_counts(times):
        def kernel(_, place, found, gamma, shares):
            sums = [np.bincount(place, weights=shares[:, j], minlength=len(found)) * times for j in range(k)]
            return pa.table([found, *map(pa.array, sums)], names=["word", *names])
        return kernel

    def dominant(numbers, place, found, gamma, shares):
        return pa.table([numbers, pa.array(gamma.argmax(1).astype(np.int32))], names=["_row", "_topic"])

    for i in range(max_iter if vocabulary else 0):
        batch = order[i % len(order)]
        part = dealt_blocks.filter(F.col("_batch") == batch)
        model.step(lambda times: cogroup(part, word_counts(times), "word string, " + ", ".join(f"{c} double" for c in names)),
                   (offset + i) ** -decay, sum(held.values()) / held[batch])

    if not model.parts:
        topics = spark.createDataFrame([], "topic int, rank int, word string, weight double")
        assign = rows.select(doc_col, F.lit(0).alias("topic"))
    else:
        units, totals = model.merge(), model.totals
        # one limit per topic: a window would sort all words of all topics
        best = [units.select(F.lit(j).alias("topic"), "word", ((F.col(f"u{j}") + eta) / totals[j]).alias("weight"))
                .orderBy(F.desc("weight"), "word").limit(num_words) for j in range(k)]
        place = F.row_number().over(Window.partitionBy("topic").orderBy(F.desc("weight"), "word"))
        topics = reduce(DataFrame.union, best).select("topic", (place - 1).alias("rank"), "word", "weight")
        path = shared_path(spark, "lda-topics")
        cogroup(dealt_blocks, dominant, "_row long, _topic int").write.parquet(path)
        assign = (rows.select(doc_col, "_row").join(spark.read.parquet(path), "_row", "left")
                  .select(doc_col, F.coalesce("_topic", F.lit(0)).alias("topic")))
    sizes = assign.groupBy("topic").agg(F.count(F.lit(1)).alias("n_docs"))
    return topics, assign, sizes
