import random

import numpy as np
import pytest

from tessera.llm import graph, neardup


def shingle_set(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    if not words:
        return frozenset()
    return frozenset([tuple(words)] if len(words) < 5 else [tuple(words[i:i + 5]) for i in range(len(words) - 4)])


def brute(rows, percent=85):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and root(i) != root(j):
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * len(sets[i] | sets[j]):
                    parent[root(i)] = root(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[root(i)] = min(least.get(root(i), k), k)
    return [(k, len(s), least.get(root(i))) for i, ((k, _), s) in enumerate(zip(rows, sets))]


def copies(rng, base, n, edits, first):
    out = []
    for k in range(n):
        words = base.split()
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"new{rng.random():.6f}"
        out.append((first + k, " ".join(words)))
    return out


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    text = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, text(rng.randint(1, 120))) for i in range(100, 160)]
    rows += copies(rng, text(200), 60, 8, 1000) + copies(rng, text(60), 25, 3, 2000) + copies(rng, text(7), 6, 1, 3000)
    rows += [(7, "Equal Words here"), (3, "equal  words\there"), (9, "équal É"), (8, "équal é"), (10, None), (11, ""), (12, " \n"), (13, "one"), (14, "ONE"),
             (None, rows[0][1]), (5, rows[1][1]), (5, rows[1][1])]
    return rows


def check(out, rows):
    got = sorted((str(r._id), r.n_shingles, str(r.component_id)) for r in out)
    assert got == sorted((str(a), b, str(c)) for a, b, c in brute(rows))


def test_against_brute_force(make_docs, corpus):
    docs = make_docs([(*r, None, None, None, 1) for r in corpus], ", tag long")
    out = neardup.near_duplicates(docs).collect()
    check(out, corpus)
    linked = [r for r in out if r.n_shingles]
    assert sum(r.kept for r in linked) == len({(r.component_id if r.component_id is not None else "none") for r in linked})


def test_large_families_in_chunks(make_docs, corpus, monkeypatch):
    monkeypatch.setattr(neardup, "FAMILY", 8)
    monkeypatch.setattr(neardup, "REGION", 4)
    check(neardup.near_duplicates(make_docs(corpus)).collect(), corpus)


def test_kept_rows_have_all_columns(make_docs, corpus):
    docs = make_docs([(*r, "en", "s", 1, 1) for r in corpus], ", _row long")
    out = neardup.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    ids = [r.doc_id for r in out.collect()]
    assert len(ids) == len(set(ids)) and {10, 11, 12, 3, 8, 9, 13} <= set(ids) and not {7, 14} & set(ids)      # only A-Z are lower-cased
    assert neardup.drop_near_duplicates(docs.limit(0)).count() == 0


def test_long_text_and_signature_parts():
    s = neardup.shingles(" ".join(f"w{i}" for i in range(60_000)))
    assert len(s) == 59_996
    whole = ((s[None, :] * neardup._MUL[:3, None] + neardup._ADD[:3, None]).min(1) >> np.uint64(32)).astype(">u4")
    assert (neardup.signature(s)[:3] == whole).all()


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2 ** 63, 1000, np.uint64)
    b = np.concatenate([a[:800], rng.integers(0, 2 ** 63, 200, np.uint64)])
    assert abs((neardup.signature(a) == neardup.signature(b)).mean() - 800 / 1200) < 0.2


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(30)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)] + [(5, 5)]
    got = {r.node: r.label for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in range(60):
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert got == label
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_stage_drops_pairs_from_80_percent(spark, make_docs):
    """Pairs of similarity 0.80 to 0.85 count as copies in the pipeline's stage."""
    import corpus_pipeline
    from tests.conftest import SF001

    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    every = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    blank = {i for i, t in every if not shingle_set(t)}
    assert {r.doc_id for r in stage(spark, docs, SF001).collect()} == {c for _, _, c in brute(every, 80)} | blank
    rng = random.Random(11)
    rows = []
    for k in range(40):
        words = [f"w{rng.random():.6f}" for _ in range(110)]
        copy = list(words)
        for at in (30, 75):
            copy[at] = f"n{rng.random():.6f}"
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(copy))]
    a, b = (shingle_set(t) for _, t in rows[:2])
    assert 0.8 <= len(a & b) / len(a | b) < 0.85
    assert {r.doc_id for r in stage(spark, make_docs(rows), None).collect()} == {2 * k for k in range(40)}
    assert neardup.near_duplicates(make_docs(rows)).where("kept").count() == len(rows)


def test_pairs_in_a_crowd_are_found(make_docs, monkeypatch):
    """Many documents share a template of half their shingles: regions are crowded at every depth of a tree."""
    monkeypatch.setattr(neardup, "REGION", 16)
    rng = random.Random(8)
    word = lambda: f"w{rng.random():.7f}"
    template, rows, pairs = [word() for _ in range(120)], [], []
    for k in range(600):
        own = [word() for _ in range(70)]
        rows.append((2 * k, " ".join(template + own)))
        if k % 3 == 0:                      # the template stays, 3 of the other words change
            for _ in range(3):
                own[rng.randrange(len(own))] = word()
            rows.append((2 * k + 1, " ".join(template + own)))
            pairs.append((2 * k, 2 * k + 1))
    sets = {i: shingle_set(t) for i, t in rows}
    want = {(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    got = {r._id: r.component_id for r in neardup.near_duplicates(make_docs(rows)).collect()}
    assert len(want) > 150 and all(got[a] == got[b] for a, b in want)
    assert len(set(got.values())) == len(rows) - len(want)


def test_stars_need_no_rounds(spark, monkeypatch):
    """Edges that are separate stars already are written once, no edges too; a chain ends without a round that only confirms."""
    wrote = []
    monkeypatch.setattr(graph, "written", lambda df, name, f=graph.written: wrote.append(name) or f(df, name))
    stars = [(9 * k + i, 9 * k) for k in range(20) for i in range(1, 9)]
    got = {tuple(r) for r in graph.components(spark.createDataFrame(stars, "a long, b long")).collect()}
    assert got == set(stars) | {(b, b) for _, b in stars} and len(wrote) == 1
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0 and len(wrote) == 2
    low = -2 ** 63
    got = {tuple(r) for r in graph.components(spark.createDataFrame([(low, 5), (7, 5)], "a long, b long")).collect()}
    assert got == {(low, low), (5, low), (7, low)} and len(wrote) == 5


def test_small_families_are_components(make_docs, corpus, monkeypatch):
    """A family that one task compares whole isn't taken through rounds again."""
    calls = []
    monkeypatch.setattr(neardup, "components", lambda edges, name, f=graph.components: calls.append(name) or f(edges, name))
    check(neardup.near_duplicates(make_docs(corpus)).collect(), corpus)
    assert calls == ["families"]


def test_what_the_walk_misses_is_found(make_docs, corpus, monkeypatch):
    monkeypatch.setattr(neardup, "FAMILY", 8)
    monkeypatch.setattr(neardup, "_walked", lambda members, percent, f=neardup._walked: f(members, percent).where("a % 3 = 0"))
    check(neardup.near_duplicates(make_docs(corpus)).collect(), corpus)
