import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import sentencepiece_model_pb2

from tessera.llm import pieces

FILE = P.path("piece_bpe_32k.model")
CODEC = pieces.Codec(FILE)
THEIRS = sentencepiece.SentencePieceProcessor(model_file=FILE)


def ids(packed):
    return np.frombuffer(packed, "<i4").tolist()


def theirs(text):
    return THEIRS.encode(text, add_eos=True, num_threads=1)


def check(texts, codec=CODEC):
    for text, packed in zip(texts, codec.encode(texts, True)):
        assert ids(packed) == theirs(text), text[:80]
        assert codec.decode(ids(packed)) == THEIRS.decode(theirs(text)), text[:80]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(), max_size=4))
def test_any_texts_as_the_library(texts):
    check(texts)


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("etaoin shrdlu the▁\nбвгд.,'1"), max_size=300))
def test_texts_of_common_letters(text):
    check([text])


@pytest.mark.parametrize("text", [
    "", " ", "a", "▁", " ▁ ▁", "two\n\nlines", "  lead and trail   ", "\x00\x01 <s> </s> <0x0A> <unk>", "日本語テキスト", "🤦🏼‍♂️ é́",
    "haha" * 5000, "a" * 20_000, "=-" * 5000, "lol" * 5000, "x" * 999 + " " * 999 + "y"])
def test_hard_texts(text):
    check([text])


def test_runs_of_spaces_are_cut_where_nothing_changes():
    check([" " * n + tail for n in range(0, 90, 1) for tail in ("", "the", "1", "\n")])
    check(["a" + " " * n + "the" for n in range(0, 90, 7)] + [" " * 100_000])


def test_long_word_of_random_letters():
    rng = random.Random(1)
    check(["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20_000))])


def test_a_better_pair_ends_the_round():
    """With ab before aba, and aba better than ab, the first place must take all before the second is merged."""
    codec = pieces.Codec.__new__(pieces.Codec)
    codec.byte = np.zeros(256, np.int32)
    codec._fit({"a": 0, "b": 1, "ab": 2, "aba": 3}, np.array([-9.0, -9.0, -5.0, -3.0]))
    assert ids(codec._merge(["abab"])[0]) == [3, 1]
    assert ids(codec._merge(["abababa"])[0]) == [3, 1, 3]
    # equal scores: the leftmost place grows first
    codec._fit({"a": 0, "aa": 1, "aaa": 2}, np.array([-9.0, -5.0, -5.0]))
    assert [ids(x) for x in codec._merge(["a" * n for n in range(1, 8)])] == [[0], [1], [2], [2, 0], [2, 1], [2, 2], [2, 2, 0]]


def test_decoding_of_any_ids():
    rng = random.Random(2)
    for _ in range(2000):
        some = [rng.randrange(rng.choice((5, 262, 32_000))) for _ in range(rng.randrange(8))]
        assert CODEC.decode(some) == THEIRS.decode(some), some


def test_caches_are_bounded(monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_WORDS", 20)
    monkeypatch.setattr(pieces, "TOGETHER", 16)
    codec = pieces.Codec(FILE)
    texts = [" ".join(f"wörd{i}x{j}" for i in range(30)) + "z" * 200 for j in range(5)] + ["", "a b c", ""]
    check(texts * 2, codec)
    assert len(codec.words) <= 40 and len(codec.older) <= 40
    assert not any(len(w) > pieces.CACHE_CHARS for w in codec.words)


def test_other_models_are_refused(tmp_path):
    model = sentencepiece_model_pb2.ModelProto()
    with open(FILE, "rb") as f:
        model.ParseFromString(f.read())
    model.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "other.model").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError, match="normalisation"):
        pieces.Codec(str(tmp_path / "other.model"))


def test_dataframe_edges(make_docs):
    rows = [(1, "Hello world"), (1, "Hello world"), (2, None), (None, ""), (3, "é\n" * 5000)]
    docs = make_docs([(*r, None, None, None, "mine") for r in rows], ", ids string")
    out = pieces.decode(pieces.encode(docs, FILE), FILE).collect()
    assert sorted((r.text or "") for r in out) == sorted(t or "" for _, t in rows)
    for r in out:                           # the column named ids gave way to the result
        assert r.ids == theirs(r.text or "") and r.decoded == (r.text or "")
    assert [r.ids for r in pieces.encode(docs.where("doc_id = 2"), FILE, end=False).collect()] == [[]]
    assert pieces.encode(docs.limit(0), FILE).count() == 0


def test_query_on_whole_table(spark):
    from tessera.llm.queries import QUERIES
    from tests.conftest import SF001
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()}
    got = QUERIES["op13_piece_rounds"](spark, SF001).collect()
    assert {r.doc_id for r in got} == set(texts) and len(got) == len(texts)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in got:
        own = theirs(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(own), sha(" ".join(map(str, own))), sha(THEIRS.decode(own)))
