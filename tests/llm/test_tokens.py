"""Byte-level BPE against tiktoken, and the exact round trip."""

import hashlib

import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tabula.llm import bpe, tokens

VOCAB = P.path("byte_bpe_50k.tiktoken")
ODD = ["", "a", "don't we'll they'RE 'sfoo x'd's ''s \"'s 's 're 'l 'll", "  a  b\n\n c\t d  x　　y  ", "   ",
       "a\n", "aaaa" * 50 + " " + "=" * 300, "٣٤ ½ 日本 \U0001f600 \u0085x", "\x1c\x1d a",
       "x've'll'mfoo'tt", "<|endoftext|>", "z" * 5000]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_encoder(VOCAB).ranks,
                             special_tokens={})


def split(ids, at):
    return [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]


def test_block_equals_library(library):
    ids, at = bpe.load_encoder(VOCAB).encode_block(pa.array(ODD))
    assert split(ids, at) == [library.encode_ordinary(x) for x in ODD]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aab'stremvld  \n\t.,=-1235é日 　ÀA", max_size=60), max_size=20))
def test_any_text(library, texts):
    ids, at = bpe.load_encoder(VOCAB).encode_block(pa.array(texts, pa.string()))
    assert split(ids, at) == [library.encode_ordinary(x) for x in texts]


def test_one_word_alone(library):
    enc = bpe.load_encoder(VOCAB)
    for word in ["internationalisation", "aaaaaaaaa", "日本語", "xqzzkjw"]:
        assert enc.one(word.encode()) == library.encode_ordinary(word)


def test_rows_nulls_repeats_and_extra_columns(spark, library):
    rows = [(1, "hello world", "x"), (1, "hello world", "x"), (2, None, None), (None, "", "y"), (3, "w" * 20000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted(map(tuple, tokens.round_trip(docs, VOCAB).collect()), key=repr)
    want = []
    for i, text, _ in rows:
        ids = library.encode_ordinary(text or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    back = tokens.decode(tokens.encode(docs, VOCAB), VOCAB).collect()
    assert sorted(bytes(r["bytes"]) for r in back) == sorted((t or "").encode() for _, t, _ in rows)
    assert tokens.round_trip(docs.limit(0), VOCAB).count() == 0


def test_whole_table(spark, library):
    from tests.conftest import SF_SMALL

    got = {r["doc_id"]: r for r in tokens.op6(spark, SF_SMALL).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        ids = library.encode_ordinary(text)
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
