from __future__ import annotations

from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docpipe.llm import encoding as en

pytestmark = pytest.mark.skipif(not Path(en.VOCABULARY).exists(), reason="no vocabulary here")
BITS = st.sampled_from(["hola ", "\n", "\n\n", "  ", " x", "don't", "ñandú", "12", "'s", "!!!", "lolo" * 5, "   ", "é", "🎉", "aaaa", "<|endoftext|>"])


@settings(max_examples=500, deadline=None)
@given(st.one_of(st.lists(BITS, max_size=40).map("".join), st.text(alphabet="ab", max_size=200), st.text(max_size=80)), st.sampled_from([1, 2, 4, 9, 33]))
def test_joined_leaves_equal_the_whole(text, leaf):
    enc = en.vocabulary(en.VOCABULARY)
    for run in (None, 1, 3):
        parts = en.leaves(text, leaf, run)
        assert "".join(p for _, p in parts) == text
        assert en.join_leaves([(r, en.encode_leaf(r, p, enc)) for r, p in parts], enc) == enc.encode_ordinary(text)


def test_documents(spark):
    long = "abc" * 900 + " fin\n\n" + "palabra ñ " * 300
    rows = [(1, "hola"), (1, "hola"), (2, None), (3, ""), (4, long), (5, "<|endoftext|>"), (None, "x")]
    df = spark.createDataFrame([(k, t, "clash", 1) for k, t in rows], "doc_id long, text string, ids string, n int")
    got = {r.doc_id: r.ids for r in en.encode_documents(df, "doc_id", "text", leaf=64).collect()}
    enc = en.vocabulary(en.VOCABULARY)
    assert got == {1: enc.encode_ordinary("hola"), 2: [], 3: [], 4: enc.encode_ordinary(long), 5: enc.encode_ordinary("<|endoftext|>")}
    assert enc.decode(got[4]) == long
    assert en.encode_documents(df.limit(0), "doc_id", "text").count() == 0


def test_same_ids_as_the_other_library(spark, small):
    tokenizers = pytest.importorskip("tokenizers")
    other = tokenizers.Tokenizer.from_file(en.VOCABULARY.replace(".tiktoken", ".json"))
    other.encode_special_tokens = True
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in en.encode_documents(docs, "doc_id", "text", leaf=200).collect():
        assert r.ids == other.encode(texts[r.doc_id], add_special_tokens=False).ids
