"""Secret scans through a trigram inverted index.

1. Each rule's regular expression gives a Boolean trigram query
   (``trigrams.py``).
2. The index: one posting (trigram, id) for every trigram that some query
   names and every text that holds it, written as a table. Trigrams that no
   query names are not indexed.
3. Postings are intersected: a text is a candidate of a rule if its trigrams
   satisfy the rule's query. Rules without mandatory trigrams have every text
   as candidate.
4. Candidates are verified with the whole regular expression.

Everything is DataFrame functions. Spans are code points, end exclusive;
matches are leftmost and do not overlap within a rule, and matches that are
too short are taken first and dropped afterwards, as the rule says.

Defined results: NULL and empty texts have no spans; rows with a repeated or
NULL id each get the spans of their own text; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabula.llm.common import documents, stash
from tabula.llm.trigrams import trigram_query


@dataclass(frozen=True)
class Rule:
    """``pattern`` in Java syntax; a match counts if ``group`` has ``least``
    characters. ``base`` rules come first in the output order."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False


RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    # `[0-9a-f]+` with 24 or more characters: runs are maximal either way
    Rule("hex", r"[0-9a-f]{24,}", 0, 24, True),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("code_host", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abeprs]-[A-Za-z0-9-]{10,}"),
    Rule("signed", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
)

SPAN = "array<struct<start:bigint,kind:int,end:bigint>>"
BLOCK = 256


def _prefix(values: Column) -> Column:
    """Sums of the elements before each element (short arrays)."""
    step = F.aggregate(
        values, F.struct(F.lit(0).cast("bigint").alias("s"), F.array().cast("array<bigint>").alias("out")),
        lambda acc, x: F.struct((acc["s"] + x).alias("s"), F.concat(acc["out"], F.array(acc["s"])).alias("out")))
    return step["out"]


def _long_prefix(values: Column) -> Column:
    """The same for arrays of any length, block by block."""
    cuts = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(values) / BLOCK).cast("int") - 1, F.lit(0)))
    parts = F.transform(cuts, lambda b: F.slice(values, b * BLOCK + 1, F.lit(BLOCK)))
    sums = F.transform(parts, lambda p: F.aggregate(p, F.lit(0).cast("bigint"), lambda a, x: a + x))
    return F.flatten(F.transform(
        F.arrays_zip(parts.alias("part"), _prefix(sums).alias("off")),
        lambda z: F.transform(_prefix(z["part"]), lambda y: y + z["off"])))


def rule_spans(text: Column, rule: Rule, number: int) -> Column:
    """All spans of one rule in one text: the pieces between the matches and
    the matches themselves add up to the positions."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    checked = found if rule.group == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.group))
    pieces = F.slice(F.split(text, rule.pattern, -1), F.lit(1), F.size(found))
    rows = F.transform(F.arrays_zip(pieces.alias("before"), found.alias("match"), checked.alias("checked")),
                       lambda z: F.struct(F.length(z["before"]).cast("bigint").alias("gap"),
                                          F.length(z["match"]).cast("bigint").alias("size"),
                                          (F.length(z["checked"]) >= rule.least).alias("ok")))
    offsets = _long_prefix(F.transform(rows, lambda r: r["gap"] + r["size"]))
    placed = F.transform(F.arrays_zip(rows.alias("r"), offsets.alias("off")),
                         lambda z: F.struct((z["off"] + z["r"]["gap"]).alias("start"), F.lit(number).alias("kind"),
                                            (z["off"] + z["r"]["gap"] + z["r"]["size"]).alias("end"),
                                            z["r"]["ok"].alias("ok")))
    kept = F.filter(placed, lambda s: s["ok"])
    spans = F.transform(kept, lambda s: F.struct(s["start"], s["kind"], s["end"])).cast(SPAN)
    # most texts have no match; they skip the position arithmetic
    return F.when(text.rlike(rule.pattern), spans).otherwise(F.array().cast(SPAN))


def build_index(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Postings (``trigram``, ``id``) of the trigrams that the rules name."""
    named = sorted({t for r in rules for clause in trigram_query(r.pattern) for alt in clause for t in alt})
    low = docs.select(F.col(id_col).alias("id"), F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in named])) \
        if named else F.array().cast("array<string>")
    return low.select("id", F.explode(held).alias("trigram"))


def candidates(index: DataFrame, rules=RULES) -> DataFrame:
    """Intersect postings: (``id``, ``rules``), the numbers of the rules whose
    trigram query the text satisfies. Rules that scan fully are not listed."""
    queries = [(n, q) for n, r in enumerate(rules) if (q := trigram_query(r.pattern))]
    named = sorted({t for _, q in queries for clause in q for alt in clause for t in alt})
    flag = {t: f"t{i}" for i, t in enumerate(named)}
    sets = index.groupBy("id").agg(*[F.bool_or(F.col("trigram") == t).alias(c) for t, c in flag.items()] or
                                   [F.count("*").alias("n")])
    every = lambda parts, join: reduce(join, parts)
    holds = [F.when(every([every([every([F.col(flag[t]) for t in sorted(alt)], lambda a, b: a & b)
                                  for alt in sorted(clause, key=sorted)], lambda a, b: a | b)
                           for clause in q], lambda a, b: a & b), F.lit(n)) for n, q in queries]
    listed = F.array_compact(F.array(*holds)) if holds else F.array().cast("array<int>")
    return sets.select("id", listed.alias("rules")).filter(F.size("rules") > 0)


def scan(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` and ``spans``: an array of structs
    (start, kind number, end), by start, then kind, then end."""
    index = stash(build_index(docs, rules, id_col, text_col), "trigram-postings")
    hits = candidates(index, rules).withColumnRenamed("id", "_hit_id").withColumnRenamed("rules", "_hit_rules")
    text = F.coalesce(F.col(text_col), F.lit(""))
    # Candidates have no size bound, so they are never broadcast; hashing them
    # spares a sort of the texts.
    joined = docs.join(hits.hint("shuffle_hash"), F.col(id_col).eqNullSafe(F.col("_hit_id")), "left")
    scanned = {n for n, r in enumerate(rules) if not trigram_query(r.pattern)}
    none = F.array().cast(SPAN)
    parts = [rule_spans(text, r, n) if n in scanned else
             F.when(F.array_contains("_hit_rules", F.lit(n)), rule_spans(text, r, n)).otherwise(none)
             for n, r in enumerate(rules)]
    return (joined.withColumn("spans", F.array_sort(F.concat(*parts)))
            .drop("_hit_id", "_hit_rules"))


def redact(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text",
           mark: str = "[REDACTED]") -> DataFrame:
    """``docs`` with every span replaced by ``mark`` (spans that overlap
    become one); the columns stay, a NULL text stays NULL."""
    spans = "_spans"
    found = scan(docs.withColumnRenamed("spans", "_own_spans"), rules, id_col, text_col) \
        if "spans" in docs.columns else scan(docs, rules, id_col, text_col)
    found = found.withColumnRenamed("spans", spans)
    text = F.col(text_col)
    cut = F.aggregate(
        spans, F.struct(F.lit(0).cast("bigint").alias("pos"), F.array().cast("array<string>").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["pos"], s["end"]).alias("pos"),
            F.concat(acc["out"], F.when((s["start"] < acc["pos"]) & (acc["pos"] > 0), F.array().cast("array<string>"))
                     .otherwise(F.array(text.substr((acc["pos"] + 1).cast("int"), (s["start"] - acc["pos"]).cast("int")),
                                        F.lit(mark)))).alias("out")),
        lambda acc: F.concat(F.array_join(acc["out"], ""),
                             text.substr((acc["pos"] + 1).cast("int"), F.length(text))))
    out = found.withColumn(text_col, F.when(F.size(spans) > 0, cut).otherwise(text)).drop(spans)
    return out.withColumnRenamed("_own_spans", "spans").select(*docs.columns)


def span_text(spans: Column, rules=RULES, base: bool = False) -> Column:
    """``kind:start:end`` of all spans (or of the base rules'), comma-joined."""
    names = F.array(*[F.lit(r.kind) for r in rules])
    own = [n for n, r in enumerate(rules) if r.base or not base]
    chosen = F.filter(spans, lambda s: s["kind"].isin(own))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op4(spark, sf_dir: str) -> DataFrame:
    found = scan(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "spans")
    number = lambda n: F.size(F.filter("spans", lambda s: s["kind"] == n)).cast("long")
    return found.select(
        "doc_id", number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"),
        F.sha2(span_text(F.col("spans"), base=True), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"))


def oracle(rules=RULES) -> str:
    """The same result in SQL: pieces and matches of a plain scan of every rule."""
    quote = lambda s: s.replace("'", "''")
    scans = " UNION ALL ".join(
        f"SELECT doc_id, {n} AS k, '{r.kind}' AS kind, {r.least} AS least, string_split_regex(text, '{quote(r.pattern)}') AS p, "
        f"regexp_extract_all(text, '{quote(r.pattern)}', 0) AS f, regexp_extract_all(text, '{quote(r.pattern)}', {r.group}) AS g "
        f"FROM docs WHERE regexp_matches(text, '{quote(r.pattern)}')" for n, r in enumerate(rules))
    base = ", ".join(str(n) for n, r in enumerate(rules) if r.base)
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
scans AS ({scans}),
hits AS (SELECT *, unnest(range(1, len(f) + 1)) AS i FROM scans),
spans AS (SELECT doc_id, k, kind,
    list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(f[1:i-1], lambda x: length(x))), 0) AS s,
    length(f[i]) AS size FROM hits WHERE length(g[i]) >= least),
named AS (SELECT *, kind || ':' || CAST(s AS BIGINT) || ':' || CAST(s + size AS BIGINT) AS name FROM spans)
SELECT d.doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
    sha256(coalesce(string_agg(name, ',' ORDER BY s, k) FILTER (k IN ({base})), '')) AS base_sha256,
    coalesce(string_agg(name, ',' ORDER BY s, k), '') AS spans
FROM docs d LEFT JOIN named n ON d.doc_id = n.doc_id GROUP BY d.doc_id
"""
