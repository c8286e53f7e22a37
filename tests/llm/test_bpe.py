import hashlib

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import bpe

FILE = P.path("byte_bpe_multi_50k.tiktoken")
RANKS = bpe.load_ranks(FILE)
CODEC = bpe.Codec(RANKS, P.PATTERN)
THEIRS = tiktoken.Encoding("theirs", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def packed(text):
    return b"".join(i.to_bytes(4, "little") for i in THEIRS.encode_ordinary(text))


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_any_text_as_tiktoken(text):
    ids = CODEC.encode(text)
    assert ids == packed(text)
    assert CODEC.decode(ids) == text.encode()


@pytest.mark.parametrize("text", [
    "", " ", "a" * 3000, "ab" * 2000 + " " * 400, "it's we'll THEY'RE 12345 x1\t\n\n  y", "<|endoftext|> a", "\x1c\x85  z",
    "՘x \U0003d3e7a \U00032427", "".join(map(chr, range(1, 0x3000)))])
def test_hard_texts(text):
    assert CODEC.encode(text) == packed(text)


def test_overlapping_pairs_merge_from_the_left():
    toy = {bytes([i]): i for i in range(256)} | {b"aa": 256, b"aaa": 257}
    codec = bpe.Codec(toy, P.PATTERN)
    theirs = tiktoken.Encoding("toy", pat_str=P.PATTERN, mergeable_ranks=toy, special_tokens={})
    for n in range(1, 12):
        assert codec.merge(b"a" * n) == theirs.encode_ordinary("a" * n)


def test_caches_are_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 5)
    monkeypatch.setattr(bpe, "CACHE_PAIRS", 5)
    codec = bpe.Codec(RANKS, P.PATTERN)
    text = " ".join(f"wörd{i}x" for i in range(60)) + " " + "y" * 500
    assert codec.encode(text * 2) == packed(text * 2)
    assert len(codec.words) <= 5 and len(codec.older) <= 5 and len(codec.pairs) <= 5


def test_dataframe_edges(make_docs):
    rows = [(1, "Hello world"), (1, "Hello world"), (2, None), (None, ""), (3, "é" * 5000)]
    docs = make_docs([(*r, None, None, None, "mine") for r in rows], ", ids string")
    out = bpe.decode(bpe.encode(docs, FILE, P.PATTERN), FILE).collect()
    assert sorted((r.text or "").encode() for r in out) == sorted((t or "").encode() for _, t in rows)
    for r in out:                           # the column named ids gave way to the result
        assert bytes(r.decoded) == (r.text or "").encode() and bytes(r.ids) == packed(r.text or "")
    assert bpe.encode(docs.limit(0), FILE, P.PATTERN).count() == 0


def test_query_on_whole_table(spark):
    from tessera.llm.queries import QUERIES
    from tests.conftest import SF001
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()}
    got = QUERIES["op10_byte_bpe"](spark, SF001).collect()
    assert {r.doc_id for r in got} == set(texts)
    for r in got:
        ids = packed(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
