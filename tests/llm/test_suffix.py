import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tessera.llm import suffix


def brute(rows, length):
    """(kept bytes, removed runs) of each row."""
    texts = [(t or "").encode() for _, t in rows]
    times = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if times[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((bytes(x for x, g in zip(t, gone) if not g), runs, len(t)))
    return out


def check(docs, rows, length, **how):
    out = suffix.remove_repeats(docs, length, **how).select("_record.doc_id", "_kept", "_removed", "_bytes").collect()
    got = sorted((str(r.doc_id), bytes(r._kept), len(r._removed), r._bytes) for r in out)
    assert got == sorted((str(i), *w) for (i, _), w in zip(rows, brute(rows, length)))
    return got


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abcdefg é\n") for _ in range(n))
    passage, edge = text(150), text(63)
    rows = [(i, text(rng.randint(0, 300))) for i in range(20)]
    rows += [(i, text(rng.randint(0, 90)) + passage + text(rng.randint(0, 90))) for i in range(30, 60)]
    rows += [(i, text(50) + edge + text(50)) for i in range(60, 66)]            # one byte short of 64, mostly
    rows += [(70, "ab" * 200), (71, "x" * 64), (72, "x" * 65), (73, "y" * 63), (74, None), (75, ""), (None, text(100)), (None, None)]
    rows += [(80, text(200))] * 2 + [(81, rows[0][1] + rows[40][1]), (82, passage * 3), (83, passage), (83, passage + "z")]
    return rows


def test_against_brute_force(make_docs, corpus):
    docs = make_docs([(*r, None, None, None, 4) for r in corpus], ", spans int")
    assert sum(n for _, _, n, _ in check(docs, corpus, 64)) > 30


@pytest.mark.parametrize("how", [dict(crowded=3), dict(batches=5)])
def test_crowded_groups_and_more_batches(make_docs, corpus, how):
    check(make_docs(corpus), corpus, 64, **how)


def test_empty_and_whole_characters(make_docs, corpus):
    docs = make_docs(corpus)
    assert suffix.remove_repeats(docs.limit(0), 64).count() == 0
    for r in suffix.remove_repeats(docs, 64, characters=True).collect():
        bytes(r._kept).decode()


def test_runs_merge_geometrically(spark, make_docs, corpus):
    family = suffix.SuffixFamily(spark, length=64, buckets=4)
    ranks = []
    for k in range(5):
        part = make_docs([r for i, r in enumerate(corpus) if i % 5 == k])
        family.add(suffix.keyed(part, "doc_id", "text"))
        ranks.append([rank for rank, _ in family.runs()])
    assert ranks == [[0], [1], [0, 1], [2], [0, 2]]
    other = suffix.SuffixFamily(spark, family.path, length=64, buckets=4)        # attached in another session
    assert [n for _, n in other.runs()] == [n for _, n in family.runs()]
    whole = suffix.entries(suffix.keyed(make_docs(corpus), "doc_id", "text"), 64)
    rows = lambda df: sorted((r.h, r.c, str(r.id), r.tag, r.at) for r in df.drop("run").collect())
    assert rows(spark.table(family.table)) == rows(whole)


def test_runs_are_scanned_without_a_shuffle(spark, make_docs, corpus):
    family = suffix.SuffixFamily(spark, length=64, buckets=4)
    family.add(suffix.keyed(make_docs(corpus[:30]), "doc_id", "text"))
    run = family.run(family.runs()[0][1])
    met = run.join(run.groupBy("h").count().where("count > 1").hint("merge"), "h", "left_semi")
    assert "Exchange" not in met._jdf.queryExecution().executedPlan().toString()


def test_every_string_is_sampled_alike():
    rng = random.Random(2)
    core = bytes(rng.choice(b"abcd") for _ in range(64))
    sampled = set()
    for _ in range(30):
        before = bytes(rng.choice(b"abcd") for _ in range(rng.randint(0, 200)))
        t = before + core + bytes(rng.choice(b"abcd") for _ in range(rng.randint(0, 200)))
        at, h = suffix.places(t, np.array([len(t)]), 64)
        inside = [(p - len(before), x) for p, x in zip(at.tolist(), h.tolist()) if len(before) <= p <= len(before) + 64 - suffix.GRAM]
        sampled = sampled & set(inside) if sampled else set(inside)
    assert sampled


def test_long_texts_in_parts(monkeypatch):
    rng = np.random.default_rng(0)
    t = rng.integers(97, 101, 5000).astype(np.uint8).tobytes()
    whole = suffix.places(t, np.array([len(t)]), 64)
    monkeypatch.setattr(suffix, "PART", 300)
    part = suffix.sampled(t, 64)
    assert (whole[0] == part[0]).all() and (whole[1] == part[1]).all()


def test_query(spark):
    from tessera.llm.queries import QUERIES
    from tests.conftest import SF001
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    want = {i: (w[2], w[2] - len(w[0]), w[1], hashlib.sha256(w[0]).hexdigest()) for (i, _), w in zip(rows, brute(rows, 200))}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op1_suffix_family"](spark, SF001).collect()}
    assert got == want


def test_texts_whose_short_hashes_collide(spark, make_docs):
    """Rows of one id and of none, among them two texts with one 32-bit hash: only what repeats goes."""
    from pyspark.sql import functions as F
    many = spark.range(200_000).select(F.concat_ws(" ", F.lit("no two of these"), F.sha2(F.col("id").cast("string"), 512)).alias("text"))
    pair = many.groupBy(F.hash("text")).agg(F.collect_list("text").alias("texts")).where(F.size("texts") > 1).orderBy(F.array_min("texts")).first()
    one, other = sorted(pair.texts)[:2]
    rows = [(None, one), (None, other), (1, one[20:130])] + [(None, f"{i} " * 40) for i in range(30)] + [(2, one[::-1]), (2, other[::-1])]
    got = check(make_docs(rows), rows, 64)
    assert sum(n for i, _, n, _ in got if i == "2") == 0
