"""Periodic runs of words by seed and extend on diagonals.

A run is a maximal stretch of words with smallest period q and a length of at
least ``max(min_length, exponent * q)``: on diagonal q (words q apart) it is a
maximal stretch of matches of at least k(q) = max(min_length - q,
(exponent - 1) q) words. Lags are taken in classes [2^j, 2^(j+1)); the seeds
of a class are the k-grams of its smallest guaranteed overlap k. As k covers a
whole period, a seed of a run recurs first exactly q words later: only each
occurrence and the next one of the same document are paired, never all pairs
of a frequent k-gram, and a pair found names the smallest period.

Pairs are taken by lag and position. The table of the furthest word covered
on each lag suppresses a pair whose diagonal was extended over it already:
neighbouring seeds of one lag overlap, so the extension of the first runs as
far as the chain of them, to the first word that does not match.

k-grams are numbered exactly (no hashes) by doubling: a gram is the pair of
its two halves, and places whose half-gram occurs once in the document leave.
A block holds about 4 MB of text, one longer text being a block of its own:
about 150 bytes of memory a word. No data leave a document, so nothing is shuffled.

Defined results: NULL and empty texts have no words and no runs; texts of any
length are treated whole; repeated rows are each a document; a NULL id is an id
like any other; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabula.llm.common import WS, blocks, documents


def _numbered(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the pairs (stable), and where a new pair starts in it."""
    key = a * (int(b.max(initial=0)) + 1) + b
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.ones(len(key), bool)
    np.not_equal(key[1:], key[:-1], out=new[1:])
    return order, new


def _recurring(place: np.ndarray, a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Numbers of the pairs at ``place`` (of n places); -1 where a pair stands alone."""
    out = np.full(n, -1, np.int64)
    order, new = _numbered(a, b)
    number = np.cumsum(new) - 1
    several = np.bincount(number, minlength=1)[number] > 1
    out[place[order[several]]] = number[several]
    return out


def smallest_overlap(low: int, high: int, min_length: int, exponent: int) -> int:
    """Least number of matches that a run of period in [low, high) has on its diagonal."""
    turn = min_length // exponent
    return min(max(min_length - q, (exponent - 1) * q)
               for q in {low, high - 1} | {min(max(t, low), high - 1) for t in (turn, turn + 1)})


def _numbers(words: list[bytes]) -> np.ndarray:
    """Equal words of a document get equal numbers."""
    number = defaultdict()
    number.default_factory = number.__len__
    return np.fromiter(map(number.__getitem__, words), np.int64, len(words))


def find_runs(words: np.ndarray, cuts: np.ndarray, min_length: int = 6, exponent: int = 4):
    """Runs of several documents: start (place among all words), length, period.

    ``words``: numbers of the words of all documents, ``cuts``: n + 1 borders."""
    if exponent < 3:
        raise ValueError("the seeds cover a period only from exponent 3 on")
    n, sizes = len(words), np.diff(cuts)
    longest = int(sizes.max(initial=0))
    end = np.repeat(cuts[1:], sizes)
    place = np.arange(n)
    grams = {1: _recurring(place, np.repeat(np.arange(len(sizes)), sizes), words, n)}
    found = []
    low = 1
    while max(min_length, exponent * low) <= longest:
        high = 2 * low
        k = smallest_overlap(low, high, min_length, exponent)
        level = max(v for v in grams if v <= k)
        while 2 * level <= k:
            gram = grams[level]
            at = np.flatnonzero(gram >= 0)
            at = at[at + 2 * level <= end[at]]
            at = at[gram[at + level] >= 0]
            level *= 2
            grams[level] = _recurring(at, gram[at], gram[at + level // 2], n)
        gram = grams[level]
        # halves that no later class asks for
        grams = {v: g for v, g in grams.items() if 2 * v > (exponent - 1) * high or v == level}
        at = np.flatnonzero(gram >= 0)
        if not len(at) and low > min_length:
            break  # longer grams do not recur either
        at = at[at + k <= end[at]]
        at = at[gram[at + k - level] >= 0]
        order, new = _numbered(gram[at], gram[at + k - level])
        at = at[order]
        lag = np.diff(at)
        seed = ~new[1:] & (lag >= low) & (lag < high)
        at, lag = at[:-1][seed], lag[seed]
        order = np.lexsort((at, lag))
        at, lag = at[order], lag[order]
        # covered by the extension of the seed before, on the same lag
        head = np.ones(len(at), bool)
        head[1:] = (lag[1:] != lag[:-1]) | (at[1:] != at[:-1] + 1)
        first = np.flatnonzero(head)
        seeds = np.diff(np.append(first, len(at)))
        start, period = at[first], lag[first]
        length = seeds - 1 + k + period
        whole = length >= np.maximum(min_length, exponent * period)
        found.append(np.stack([start[whole], length[whole], period[whole]]))
        low = high
    runs = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
    return runs[:, np.lexsort((runs[2], runs[0]))]


def repeated_words(runs: np.ndarray, n: int) -> np.ndarray:
    """Words that stand in a run after its first period."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, runs[0] + runs[2], 1)
    np.add.at(step, runs[0] + runs[1], -1)
    return np.cumsum(step[:-1]) > 0


def periodic_runs(docs: DataFrame, min_length: int = 6, exponent: int = 4, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per document: id, ``runs`` (start, length and period in words,
    by start and period) and ``collapsed`` (every run cut to its first period)."""
    def run(batches):
        for block in blocks(batches, "text"):
            texts = [(t or "").encode().split() for t in block.column(1).to_pylist()]
            cuts = np.cumsum([0] + [len(t) for t in texts])
            words = np.concatenate([_numbers(t) for t in texts])
            runs = find_runs(words, cuts, min_length, exponent)
            gone = repeated_words(runs, len(words))
            bound = np.searchsorted(runs[0], cuts)
            out = []
            for d, t in enumerate(texts):
                if bound[d] < bound[d + 1]:
                    t = [w for w, g in zip(t, gone[cuts[d]:cuts[d + 1]].tolist()) if not g]
                out.append(b" ".join(t).decode())
            own = pa.StructArray.from_arrays(
                [pa.array(runs[0] - cuts[np.searchsorted(cuts, runs[0], "right") - 1]), pa.array(runs[1]),
                 pa.array(runs[2])], names=["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [block.column(0), pa.ListArray.from_arrays(pa.array(bound.astype(np.int32)), own), pa.array(out, pa.string())],
                names=["id", "runs", "collapsed"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"id {kind}, runs array<struct<start: long, length: long, period: long>>, collapsed string")
            .withColumnRenamed("id", id_col))


def _once(value: Column, body) -> Column:
    """``body(value)`` with the value computed once a row: a lambda's own
    expressions are evaluated again for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def planted(doc_id: Column, text: Column) -> Column:
    """The text as the contract has it: in a tenth of the documents (by the
    crc32 of the id) the words from a on repeat with period p."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def rule(words: Column) -> Column:
        n = F.greatest(F.size(words), F.lit(1))  # the rule of a text without words is not used
        a = g % n
        return _once(F.struct(words.alias("words"), a.alias("a"), (1 + F.floor((n - a) / (3 + g % 8))).alias("p")), moved)

    def moved(c: Column) -> Column:
        # the index of a place past a: a + (i - a) % p, element_at counts from 1
        return F.when(F.size(c["words"]) > 0, F.array_join(F.transform(c["words"], lambda w, i: F.when(i >= c["a"], F.element_at(
            c["words"], (c["a"] + (i - c["a"]) % c["p"] + 1).cast("int"))).otherwise(w)), " ")).otherwise(text)

    split = F.when(h % 10 == 0, F.filter(F.split(text, WS), lambda w: w != ""))
    return F.when((h % 10 == 0) & text.isNotNull(), _once(split, rule)).otherwise(text)


def op12(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return digests(docs.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text")))


def digests(docs: DataFrame) -> DataFrame:
    """Number of runs, the longest one, and digests of all runs and of what is kept."""
    found = periodic_runs(docs)
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    length, period = best["length"], -best["period"]
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-best["start"]).alias("start"),
                        length.alias("length"), period.alias("period"),
                        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
                        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
