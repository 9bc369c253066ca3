"""Packing: ids equal to whole-text encoding, cuts, groups, edge rows."""

import zlib
from functools import cache

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from demandkit.llm import packing
from demandkit.llm.queries import tokenizer_file


@cache
def whole_tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file())


@pytest.fixture(scope="module")
def plain():
    return whole_tokenizer()


def brute(plain, text):
    return np.asarray([*plain.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab é'\n\t.1  \x1c\x85漢<|>endoftxs"), max_size=30), max_size=4))
def test_cached_ids_equal_whole_text(texts):
    tok, whole = packing.tokenizer(tokenizer_file()), whole_tokenizer()
    texts = [*texts, "a b<|endoftext|> c"]
    expected = [np.asarray(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert tok.encode(texts) == expected


@given(st.lists(st.integers(1, 50), max_size=60))
def test_first_fit_decreasing_equals_a_scan(sizes):
    bins, expected = [], {}
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        b = next((b for b, used in enumerate(bins) if used + sizes[i] <= 50), len(bins))
        if b == len(bins):
            bins.append(0)
        expected[i] = (b, bins[b])
        bins[b] += sizes[i]
    assert packing.first_fit_decreasing(sizes, 50) == [expected[i] for i in range(len(sizes))]


def test_pieces_and_sequences(spark, plain):
    rows = [(1, "one two", "x"), (2, None, "x"), (3, "", None), (4, "word " * 3000, "y"), (None, "lost", "z"), (5, "twin", "a"), (5, "twin", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string")
    out = packing.pack(packing.pieces(docs, tokenizer_file()), group_pieces=3).toPandas()
    assert out.length.max() <= 2048 and len(out) == 8
    for doc_id, text in ((1, "one two"), (2, None), (3, ""), (4, "word " * 3000)):
        ids = brute(plain, text)
        own = out[out.doc_id == doc_id].sort_values("start")
        assert own.length.sum() == len(ids) == own.doc_tokens.iloc[0]
        for p in own.itertuples():
            assert zlib.crc32(ids[p.start : p.start + p.length].tobytes()) == p.ids_crc32
    for _, s in out.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert (s.offset == s.length.cumsum() - s.length).all() and s.length.sum() <= 2048


def test_ids_column(spark, plain):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert packing.pieces(docs, tokenizer_file(), with_ids=True).first().ids == brute(plain, "a b c").tolist()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(packing.pieces(docs, tokenizer_file())).count() == 0


def test_words_forgotten_and_met_again(plain, monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 6)
    monkeypatch.setattr(packing, "GATHER_WORDS", 5)
    tok = packing.CachedTokenizer(tokenizer_file())
    texts = [" ".join(f"word{(i * j) % 11}." for j in range(9)) + "\n\nnext line, and" for i in range(12)]
    for text in texts:
        assert tok.encode([text, "", "a"]) == [np.asarray(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in (text, "", "a")]


def test_query_on_the_whole_table(spark, sf, plain):
    """Every piece of every document against encoding its whole text at once."""
    from demandkit.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    out = QUERIES["op1_packing"](spark, sf).toPandas()
    got = {k: own.sort_values("start") for k, own in out.groupby("doc_id")}
    assert len(got) == len(docs)
    for d in docs:
        ids, own = brute(plain, d.text), got[d.doc_id]
        assert own.length.sum() == len(ids) and set(own.doc_tokens) == {len(ids)}
        assert (own.start == own.length.cumsum() - own.length).all()
        assert [zlib.crc32(ids[a : a + n].tobytes()) for a, n in zip(own.start, own.length)] == own.ids_crc32.tolist()
    for _, s in out.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert (s.offset == s.length.cumsum() - s.length).all() and s.length.sum() <= 2048
    assert out.groupby("sequence_id").length.sum().mean() > 0.97 * 2048


def test_a_text_longer_than_a_slice(spark, plain):
    text = "some words, and more of them.\n" * 150_000
    docs = spark.createDataFrame([(1, text[:-1]), (2, "short")], "doc_id long, text string")
    own = packing.pieces(docs.coalesce(1), tokenizer_file()).toPandas()
    ids = brute(plain, text[:-1])
    one = own[own.doc_id == 1].sort_values("start")
    assert one.length.sum() == len(ids)
    assert [zlib.crc32(ids[a : a + n].tobytes()) for a, n in zip(one.start, one.length)] == one.ids_crc32.tolist()


def test_small_bounds_change_no_result(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = lambda frame: sorted(map(tuple, frame.collect()))
    assert rows(packing.pieces(docs, tokenizer_file(), cache_words=50, slice_bytes=1 << 10)) == rows(packing.pieces(docs, tokenizer_file()))
