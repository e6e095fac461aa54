"""Registered queries: text (documents and conversations, whole texts)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.lexicon import DETACHMENT_RULES, ENGLISH_STOP_WORDS
from ..operators import text as X
from .fixtures import t
from .registry import query

_W = r"[\p{L}\p{N}_]+"
_W2 = r"[\p{L}\p{N}_]{2,}"
_STOP = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH_STOP_WORDS) + "]"
_FILTERED = (f"list_filter(list_transform(regexp_extract_all(text, '{_W}'), lambda x: lower(x)), "
             f"lambda x: NOT list_contains({_STOP}, x))")


def _filtered(spark, sf, table="documents", key="doc_id"):
    d = t(spark, sf, table, [key, "text"])
    return X.stopword_filter(X.tokens_regex(d, "text"), "tokens", "filtered")


@query("tokens_regex", f"""
SELECT doc_id, len(regexp_extract_all(text, '{_W}')) AS n_tokens,
       array_to_string(regexp_extract_all(text, '{_W}'), ' ') AS tokens FROM documents""")
def q_tokens_regex(spark, sf):
    d = X.tokens_regex(t(spark, sf, "documents", ["doc_id", "text"]), "text")
    return d.select("doc_id", F.size("tokens").alias("n_tokens"),
                    F.array_join("tokens", " ").alias("tokens"))


@query("stopword_filter", f"""
SELECT doc_id, len({_FILTERED}) AS n_filtered, array_to_string({_FILTERED}, ' ') AS filtered
FROM documents""")
def q_stopword_filter(spark, sf):
    d = _filtered(spark, sf)
    return d.select("doc_id", F.size("filtered").alias("n_filtered"),
                    F.array_join("filtered", " ").alias("filtered"))


@query("stopword_filter_conversations", f"""
SELECT conv_id, turn, role, len({_FILTERED}) AS n_filtered FROM conversations""")
def q_stopword_filter_conversations(spark, sf):
    c = t(spark, sf, "conversations")
    c = X.stopword_filter(X.tokens_regex(c, "text"), "tokens", "filtered")
    return c.select("conv_id", "turn", "role", F.size("filtered").alias("n_filtered"))


_TFIDF_SQL = f"""
WITH tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{_W2}')) AS term FROM documents),
tc AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY doc_id, term),
n AS (SELECT count(DISTINCT doc_id) AS n FROM documents),
dfq AS (SELECT term, count(*) AS df FROM tc GROUP BY term),
w AS (SELECT tc.doc_id, tc.term, tc.tf * (ln(n.n / dfq.df) + 1) AS w FROM tc JOIN dfq USING (term), n),
nr AS (SELECT doc_id, sqrt(sum(w * w)) AS nrm FROM w GROUP BY doc_id),
tfidf AS (SELECT doc_id, term, w / nrm AS tfidf FROM w JOIN nr USING (doc_id))"""


@query("tfidf", _TFIDF_SQL + "\nSELECT doc_id, term, round(tfidf, 9) AS tfidf FROM tfidf")
def q_tfidf(spark, sf):
    w = X.tfidf(t(spark, sf, "documents", ["doc_id", "text"]), "doc_id", "text")
    return w.withColumn("tfidf", F.round("tfidf", 9))


@query("tfidf_prune", _TFIDF_SQL + r"""
SELECT term, round(sum(tfidf), 9) AS total FROM tfidf GROUP BY term
HAVING sum(tfidf) > 2.5 AND NOT regexp_matches(term, '\d')""")
def q_tfidf_prune(spark, sf):
    w = X.tfidf(t(spark, sf, "documents", ["doc_id", "text"]), "doc_id", "text")
    return X.tfidf_prune(w, 2.5).withColumn("total", F.round("total", 9))


@query("bag_of_words", f"""
WITH ex AS (SELECT doc_id, unnest({_FILTERED}) AS term FROM documents),
c AS (SELECT doc_id, term, count(*) AS count FROM ex GROUP BY doc_id, term),
ids AS (SELECT term, row_number() OVER (ORDER BY min(doc_id), term) - 1 AS term_id
        FROM c GROUP BY term)
SELECT doc_id, term_id, term, count FROM c JOIN ids USING (term)""")
def q_bag_of_words(spark, sf):
    return X.bag_of_words(_filtered(spark, sf), "doc_id", "filtered")


def _rules_sql():
    rows = []
    for p, rs in DETACHMENT_RULES.items():
        for i, (suf, rep) in enumerate(rs):
            rows.append(f"('{p}', {i}, '{suf}', '{rep}')")
    return "VALUES " + ", ".join(rows)


_LEMMA_SQL = f"""
WITH d AS (SELECT doc_id, {_FILTERED} AS toks FROM documents),
ex AS (SELECT doc_id, unnest(toks) AS t, unnest(range(len(toks))) AS pos FROM d),
vocab AS (SELECT DISTINCT t AS form FROM ex),
rules(pos, ord, suf, rep) AS ({_rules_sql()}),
cand AS (SELECT form, r.pos, r.ord, left(form, length(form) - length(suf)) || rep AS lemma
         FROM vocab, rules r WHERE suffix(form, suf) AND length(form) > length(suf)),
valid AS (SELECT * FROM cand WHERE lemma IN (SELECT form FROM vocab)),
best AS (SELECT form, pos, arg_min(lemma, length(lemma) * 100 + ord) AS lemma FROM valid
         GROUP BY form, pos),
l1 AS (SELECT ex.doc_id, ex.pos, coalesce(b.lemma, ex.t) AS l FROM ex
       LEFT JOIN (SELECT * FROM best WHERE pos = 'n') b ON b.form = ex.t),
l2 AS (SELECT l1.doc_id, l1.pos, coalesce(b.lemma, l1.l) AS l FROM l1
       LEFT JOIN (SELECT * FROM best WHERE pos = 'a') b ON b.form = l1.l),
l3 AS (SELECT l2.doc_id, l2.pos, coalesce(b.lemma, l2.l) AS l FROM l2
       LEFT JOIN (SELECT * FROM best WHERE pos = 'v') b ON b.form = l2.l),
g AS (SELECT doc_id, array_to_string(list(l ORDER BY pos), ' ') AS lemmas, count(*) AS n_lemmas
      FROM l3 GROUP BY doc_id)
SELECT documents.doc_id, coalesce(g.n_lemmas, 0) AS n_lemmas, coalesce(g.lemmas, '') AS lemmas
FROM documents LEFT JOIN g USING (doc_id)"""


@query("lemmatize", _LEMMA_SQL)
def q_lemmatize(spark, sf):
    # tokens feed both the vocabulary and the lookups: tokenise once
    d = _filtered(spark, sf).select("doc_id", "filtered").persist()
    vocab = d.select(F.explode("filtered").alias("term"))
    lex = X.morphy_lexicon(vocab)
    out = X.lemmatize(d, "doc_id", "filtered", lex)
    return out.select("doc_id", F.size("lemmas").cast("long").alias("n_lemmas"),
                      F.array_join("lemmas", " ").alias("lemmas"))


@query("topics_lda")
def q_topics_lda(spark, sf):
    """Online LDA (5 topics, 15 steps, one pass over all documents) over
    stop-word-filtered documents: top 4 words per topic with their weights and
    the number of documents whose dominant topic it is. Seeded; no SQL oracle."""
    d = _filtered(spark, sf)
    topics, _, sizes = X.topics_lda(d, "doc_id", "filtered", num_topics=5, num_words=4,
                                  max_iter=15, seed=46)
    return topics.join(sizes, "topic", "left").select(
        "topic", "rank", "word", "weight", F.coalesce("n_docs", F.lit(0)).alias("n_docs"))


@query("select_by_column_sum", _TFIDF_SQL + """
SELECT term, round(sum(tfidf), 9) AS total FROM tfidf GROUP BY term HAVING sum(tfidf) > 2.5""")
def q_select_by_column_sum(spark, sf):
    """Terms (columns of the document-term matrix, kept long) whose TF-IDF
    column sum exceeds 2.5."""
    w = X.tfidf(t(spark, sf, "documents", ["doc_id", "text"]), "doc_id", "text")
    return X.tfidf_prune(w, 2.5, drop_digit_terms=False).withColumn("total", F.round("total", 9))


@query("select_by_regex", _TFIDF_SQL + r"""
SELECT DISTINCT term FROM tfidf WHERE NOT regexp_matches(term, '\d')""")
def q_select_by_regex(spark, sf):
    """Terms whose name has no digit (the column-name filter, on long form)."""
    w = X.tfidf(t(spark, sf, "documents", ["doc_id", "text"]), "doc_id", "text")
    return w.select("term").distinct().filter(~F.col("term").rlike(r"\d"))
