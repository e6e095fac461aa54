"""Text operators in long form: ``(doc, term)`` rows instead of a wide
document-term matrix, so the vocabulary can grow without widening a schema.

Every document is processed whole. Corpus-wide statistics (document
frequency, vocabulary ids) are partial aggregates; per-document norms are
aggregates keyed by document.
"""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.lexicon import DETACHMENT_RULES, ENGLISH_STOP_WORDS
from ..functions.scalar import WORD, WORD2, lower_tokens, tokens
from ..plans.scale import global_rank, sized
from .topics import topics_lda  # noqa: F401


def tokens_regex(df: DataFrame, text_col: str, out_col: str = "tokens",
                 pattern: str = WORD) -> DataFrame:
    """``tokens_regex``: word tokens with case kept."""
    return df.withColumn(out_col, tokens(text_col, pattern))


def stopword_filter(df: DataFrame, tokens_col: str, out_col: str = "filtered",
                    stop_words=ENGLISH_STOP_WORDS) -> DataFrame:
    """``stopword_filter``: lower-cased tokens minus stop words, order kept.

    Lower-casing is a built-in higher-order function; the set lookup is the
    JVM ``StopWordsRemover`` (hash set), not a per-token scan of the list.
    """
    low = df.withColumn("_low_tokens", lower_tokens(tokens_col))
    rem = StopWordsRemover(inputCol="_low_tokens", outputCol=out_col,
                           stopWords=list(stop_words), caseSensitive=True)
    return rem.transform(low).drop("_low_tokens")


def term_counts(df: DataFrame, doc_col: str, text_col: str, pattern: str = WORD2,
                lowercase: bool = True) -> DataFrame:
    """``(doc, term, tf)``: raw term counts per document (partial aggregate)."""
    toks = tokens(text_col, pattern)
    if lowercase:
        toks = tokens(F.lower(F.col(text_col)), pattern)
    exploded = df.select(F.col(doc_col), F.explode(toks).alias("term"))
    return exploded.groupBy(doc_col, "term").agg(F.count(F.lit(1)).alias("tf"))


def tfidf(df: DataFrame, doc_col: str, text_col: str, pattern: str = WORD2) -> DataFrame:
    """``tfidf``: ``tf * (ln(n / df) + 1)``, L2-normalised per document.

    Same definition as a TF-IDF vectoriser with ``smooth_idf=False``:
    lower-cased tokens of two or more word characters, raw counts. Spark's
    ``IDF`` uses ``ln((n + 1) / (df + 1))``, so the weights are built here
    from aggregates instead. Texts are tokenised once: the term counts are
    persisted (recomputable from lineage) and feed both the document
    frequencies and the weights; the per-document norm is a window over one
    document's terms, so no second join is needed. Texts are moved once, by
    document; counts, weights and norms follow in place, unless the vocabulary
    is too large to broadcast.
    """
    whole = df.select(doc_col, text_col).repartition(doc_col)
    tc = term_counts(whole, doc_col, text_col, pattern).persist(StorageLevel.MEMORY_AND_DISK)
    n_docs = df.select(doc_col).distinct().count()
    dfreq = tc.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = sized(dfreq.select("term", (F.log(F.lit(float(n_docs)) / F.col("df")) + 1.0).alias("idf")))
    w = tc.join(idf, "term").withColumn("w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(doc_col)))
    return w.select(doc_col, "term", (F.col("w") / norm).alias("tfidf"))


def tfidf_prune(weights: DataFrame, min_total: float = 2.5,
                drop_digit_terms: bool = True) -> DataFrame:
    """``tfidf_prune``: keep terms whose column sum exceeds ``min_total`` and
    whose text has no digit; returns the kept ``(term, total)``."""
    tot = weights.groupBy("term").agg(F.sum("tfidf").alias("total"))
    tot = tot.filter(F.col("total") > min_total)
    if drop_digit_terms:
        tot = tot.filter(~F.col("term").rlike(r"\d"))
    return tot


def bag_of_words(df: DataFrame, doc_col: str, tokens_col: str) -> DataFrame:
    """``bag_of_words``: ``(doc, term_id, term, count)``.

    Ids follow the dictionary rule of assigning new words in document order,
    alphabetically within a document: ``rank by (first doc, term)``. The
    ranking is a distributed global rank over the vocabulary.
    """
    ex = df.select(F.col(doc_col), F.explode(tokens_col).alias("term"))
    counts = ex.groupBy(doc_col, "term").agg(F.count(F.lit(1)).alias("count")) \
        .persist(StorageLevel.MEMORY_AND_DISK)
    first = counts.groupBy("term").agg(F.min(doc_col).alias("_first"))
    vocab = global_rank(first, ["_first", "term"], rank_col="_rk")
    ids = sized(vocab.select("term", (F.col("_rk") - 1).alias("term_id")))
    return counts.join(ids, "term").select(doc_col, "term_id", "term", "count")


# --------------------------------------------------------------- lemmatizing


def morphy_lexicon(vocab: DataFrame, term_col: str = "term") -> DataFrame:
    """A ``(form, pos, lemma)`` lexicon derived from a vocabulary with
    WordNet's detachment rules: a candidate base form counts only if it is
    itself in the vocabulary; the shortest valid candidate wins (rule order
    breaks ties); a form with no valid candidate is its own lemma.
    """
    rules = [F.struct(F.lit(p).alias("pos"), F.lit(i).alias("ord"), F.lit(suf).alias("suf"),
                      F.lit(rep).alias("rep"))
             for p, rs in DETACHMENT_RULES.items() for i, (suf, rep) in enumerate(rs)]
    v = vocab.select(F.col(term_col).alias("form")).distinct()
    cand = (v.select("form", F.inline(F.array(*rules)))
            .filter(F.col("form").endswith(F.col("suf")) & (F.length("form") > F.length("suf")))
            .select("form", "pos", "ord",
                    F.concat(F.expr("substring(form, 1, length(form) - length(suf))"),
                             F.col("rep")).alias("lemma")))
    valid = cand.join(v.select(F.col("form").alias("lemma")), "lemma", "left_semi")
    best = valid.groupBy("form", "pos").agg(
        F.min_by(F.col("lemma"), F.struct(F.length("lemma"), F.col("ord"))).alias("lemma"))
    return best


def lemmatize(df: DataFrame, doc_col: str, tokens_col: str, lexicon: DataFrame,
              out_col: str = "lemmas", order=("n", "a", "v")) -> DataFrame:
    """``lemmatize``: noun, then adjective, then verb lemma of each token
    (tokens already lower-cased and stop-word filtered), order kept.

    The three steps are composed over the lexicon's own forms first (its size,
    not the corpus's), so every token meets one equi-join and is gathered back
    per document in position order.
    """
    forms = lexicon.select(F.col("form").alias("_t")).distinct().withColumn("_l", F.col("_t"))
    for p in order:
        step = (lexicon.filter(F.col("pos") == p)
                .select(F.col("form").alias("_l"), F.col("lemma").alias("_lp")))
        forms = (forms.join(step, "_l", "left")
                 .withColumn("_l", F.coalesce(F.col("_lp"), F.col("_l"))).drop("_lp"))
    changed = forms.filter("_l <> _t").withColumnRenamed("_l", "_lp")
    ex = df.select(F.col(doc_col), F.posexplode(tokens_col).alias("_pos", "_t"))
    cur = ex.join(changed, "_t", "left").withColumn("_l", F.coalesce(F.col("_lp"), F.col("_t")))
    back = cur.groupBy(doc_col).agg(
        F.array_sort(F.collect_list(F.struct("_pos", "_l"))).alias("_s"))
    out = back.select(doc_col, F.transform("_s", lambda s: s["_l"]).alias(out_col))
    # documents whose token list is empty keep an empty list
    return df.select(doc_col).join(out, doc_col, "left").withColumn(
        out_col, F.coalesce(F.col(out_col), F.array().cast("array<string>")))
