import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessera.llm import packing

FILE = P.path("word_bpe_49k.json")
THEIRS = Tokenizer.from_file(FILE)
THEIRS.encode_special_tokens = True


def ids_of(text):
    return THEIRS.encode(text or "", add_special_tokens=False).ids + [0]


def check_bins(pieces, max_tokens):
    """Gapless sequences of at most max_tokens; pieces (sequence, offset, length)."""
    at = {}
    for s, o, n in sorted(pieces):
        assert o == at.get(s, 0)
        at[s] = o + n
    assert max(at.values(), default=0) <= max_tokens
    return len(at)


WORDS = packing.Words(FILE)


@settings(max_examples=200, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t.,!|%'ABcéÉß²1<>|"))))
def test_words_as_the_tokenizer(text):
    assert np.frombuffer(WORDS.encode(pa.array([text]))[0].as_py(), "<u4").tolist() == ids_of(text)[:-1]


def test_words_hard_texts():
    texts = ["", None, "  ", "Don't STOP... <|endoftext|> x<|startoftext|>", "é́ ́a \x1cq\x85r s", "A.b,c!! %%% it's. q.'", "z" * 300] * 2
    got = WORDS.encode(pa.array(texts, pa.string())).to_pylist()
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [ids_of(t)[:-1] for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=60), st.sampled_from(["norm", "dot"]))
def test_best_fit_keeps_every_constraint(lengths, by):
    lengths = np.array(sorted(lengths, reverse=True), np.int64)
    caps = np.array([100, 5, 9000.0])
    caps[2] = 10_000
    seq, offset = packing.best_fit(lengths, caps, np.array([1.0, 0.5, 0.5]), by)
    check_bins(list(zip(seq.tolist(), offset.tolist(), lengths.tolist())), 100)
    for s in set(seq.tolist()):
        own = lengths[seq == s]
        assert len(own) <= 5 and (own ** 2).sum() <= 10_000


def test_attention_and_piece_limits_open_more_sequences():
    lengths = np.full(10, 10, np.int64)
    one = lambda *caps: len(set(packing.best_fit(lengths, np.array(caps, float), np.ones(3))[0].tolist()))
    assert (one(100, 100, 1e9), one(100, 4, 1e9), one(100, 100, 300)) == (1, 3, 4)
    with pytest.raises(ValueError):
        packing.best_fit(np.array([101]), np.array([100, 9, 1e9]), np.ones(3))


def test_documents(make_docs):
    rows = [(1, "hello world " * 3000), (1, "hello world " * 3000), (2, None), (3, ""), (None, "a b c"), (5, "one two. " * 40)]
    docs = make_docs([(*r, None, None, None, 7) for r in rows], ", piece int")
    out = packing.pack_documents(docs, FILE, 128, group_pieces=50).collect()
    want = []
    for i, t in rows:
        ids = ids_of(t)
        for k in range(0, len(ids), 128):
            part = ids[k:k + 128]
            want.append((str(i), k // 128, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in out) == sorted(want)
    check_bins([(r.sequence_id, r.offset, r.length) for r in out], 128)
    assert packing.pack_documents(docs.limit(0), FILE, 128).count() == 0


def test_query_is_close_to_the_lower_bound(spark):
    from tessera.llm.queries import QUERIES
    from tests.conftest import SF01
    out = QUERIES["op2_vector_best_fit"](spark, SF01).collect()
    n = check_bins([(r.sequence_id, r.offset, r.length) for r in out], 2048)
    assert n <= 1.01 * sum(r.length for r in out) / 2048 + 1
