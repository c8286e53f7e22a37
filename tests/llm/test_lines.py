from collections import defaultdict

import numpy as np
import xxhash

from tessera.llm import lines


def plain_chunks(text):
    """The rule line by line in whole numbers: a chunk ends where the rolling hash of the last
    two line hashes is divisible by 3 (the first line of a text ends none)."""
    word, mul = (1 << 64) - 1, 0x9E3779B97F4A7C15
    out, held, last = [], [], None
    for line in text.split("\n") if text else []:
        h = xxhash.xxh3_64_intdigest(line.encode().strip())
        held.append(line)
        if last is not None:
            r = last
            r = ((r ^ (r >> 29)) * mul + h) & word
            r = ((r ^ (r >> 32)) * mul) & word
            if (r >> 33) % 3 == 0:
                out.append((len(held), "\n".join(held)))
                held = []
        last = h
    return out + ([(len(held), "\n".join(held))] if held else [])


def brute(rows, least=2):
    seen, out = set(), defaultdict(list)
    for k, (i, t) in sorted(enumerate(rows), key=lambda x: (x[1][0] is None, x[1][0] or 0, x[0])):
        for n, c in plain_chunks(t):
            gone = n >= least and c in seen
            if n >= least:
                seen.add(c)
            out[k].append((n, c, gone))
    return out


def test_chunks_join_to_the_text():
    for t in ["a", "a\n", "\n\n\n", "a\r\nb\n\nc" * 30, "x" * 100_000]:
        assert "\n".join(c for _, c in lines.chunks(t)) == t
    assert lines.chunks("") == lines.chunks(None) == []


def test_boundaries_move_with_the_lines():
    rng = np.random.default_rng(0)
    h = rng.integers(0, 2 ** 63, 200, np.uint64)
    ends = lines.boundaries(h)
    shifted = lines.boundaries(np.concatenate([rng.integers(0, 2 ** 63, 7, np.uint64), h]))
    assert {e + 7 for e in ends if e > 2} <= set(shifted)
    assert 1.5 < 200 / len(ends) < 8


def test_against_brute_force(spark, make_docs):
    shared = "\n".join(f"shared line {i}" for i in range(20))
    rows = [(5, f"own {i}\nmore {i}\n{shared}\nend {i}") for i in (1,)] + [(i, f"own {i}\nmore {i}\n{shared}\nend {i}") for i in range(10, 30)]
    rows += [(40, None), (41, ""), (42, "single"), (42, "single"), (None, shared), (43, "a\na\na\na\na\na"), (44, shared + "\n" + shared), (5, rows[0][1])]
    docs = make_docs([(*r, None, None, None, 1) for r in rows], ", copy int")
    out = lines.drop_repeated_chunks(docs).collect()
    want = brute(rows)
    key = lambda r: (str(r[0]), r[1], r[2], r[3])
    expected = [(rows[k][0], len(want[k]), sum(g for _, _, g in want[k]), sum(n for n, _, g in want[k] if g),
                 "\n".join(c for _, c, g in want[k] if not g)) for k in range(len(rows))]
    assert sorted((( r._id, r.n_chunks, r.n_removed, r.lines_removed, r.text) for r in out), key=key) == sorted(expected, key=key)
    assert sum(r.n_removed for r in out) > 20
    assert lines.drop_repeated_chunks(docs.limit(0)).count() == 0


def test_bytes_decide_not_digests(make_docs):
    docs = make_docs([(1, "aa\nbb"), (2, "cc\ndd"), (3, "aa\nbb"), (4, "ee\nff")])
    out = lines.repeated_chunks(docs, digest=lambda piece: b"all alike").collect()
    assert {r.id for r in out} == {3}


def test_query(spark):
    import hashlib

    from tessera.llm.queries import QUERIES
    from tests.conftest import SF001
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect())
    want = brute(rows)
    got = {r.doc_id: r for r in QUERIES["op6_line_chunks"](spark, SF001).collect()}
    assert set(got) == {i for i, _ in rows}
    for k, (i, _) in enumerate(rows):
        left = "\n".join(c for _, c, g in want[k] if not g)
        assert (got[i].n_chunks, got[i].n_removed) == (len(want[k]), sum(g for _, _, g in want[k]))
        assert got[i].text_sha256 == hashlib.sha256(left.encode()).hexdigest()
