"""Queries with SQL against DuckDB, and the pipeline against its parts."""

import re

import duckdb
import pytest

import corpus_pipeline
from scripts.check_oracle import TABLES, digest
from tessera.llm import queries
from tests.conftest import SF001
from tests.llm.test_neardup import brute as near_brute
from tests.llm.test_suffix import brute as repeat_brute


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(queries.SQL))
def test_query_matches_sql(spark, con, key):
    df = queries.QUERIES[key](spark, SF001)
    res = con.execute(queries.SQL[key])
    cols = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(cols, res.fetchall())[0]


def test_registered():
    import __spark_entry__ as entry
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in queries.QUERIES) == list(range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries())


def test_stages_one_by_one(spark, make_docs):
    """Each stage on the rows that the one before has kept, held against brute force."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    read = lambda df: {r.doc_id: r.text for r in df.collect()}
    good = stage["quality"](spark, docs, SF001)
    assert good.columns == docs.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    left = read(good)
    assert sum((labels[i] == 1) == (i in left) for i in labels) >= 0.9 * len(labels)
    once = stage["exact_dedup"](spark, good, SF001)
    groups = {}
    for i, t in left.items():
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", t), []).append((-len(t), i))
    assert set(read(once)) == {min(g)[1] for g in groups.values()}
    near = stage["near_dedup"](spark, once, SF001)
    rows = sorted(read(once).items())
    assert set(read(near)) == {c for _, _, c in near_brute(rows, 80)}
    cut = stage["suffix_array"](spark, near, SF001)
    assert cut.columns == docs.columns
    rows = sorted(read(near).items())
    for (i, t), (kept, _, n) in zip(rows, repeat_brute(rows, 200)):
        text = read_cache(cut)[i]
        assert len(kept) <= len(text.encode()) <= n and (len(kept) < n or text == t)
        assert len(text.encode()) - len(kept) <= 6 * (n > len(kept)) * t.count("\n") + 6
    packed = stage["packing"](spark, cut, SF001)
    assert {r.doc_id for r in packed.collect()} == set(read(cut))


_cache = {}


def read_cache(df):
    if id(df) not in _cache:
        _cache[id(df)] = {r.doc_id: r.text for r in df.collect()}
    return _cache[id(df)]


def test_pipeline_on_odd_rows(spark, make_docs):
    words = "The river runs past the old mill and children walk along it to school each day"
    rows = [(1, None), (2, ""), (None, words), (4, words), (4, words), (5, words + " x"), (6, words * 4000)]
    docs = make_docs([(*r, None, None, None, 1) for r in rows], ", score int")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF001)
        assert out.columns == docs.columns, name
        out.collect()
        assert stage(spark, docs.limit(0), SF001).count() == 0
    packed = dict(corpus_pipeline.STAGES)["packing"]
    out = packed(spark, docs, SF001).collect()
    assert len({(r.doc_id, r.piece, r.sequence_id, r.offset) for r in out}) == len(out) > len(rows)        # the long text has several pieces
    assert {r.doc_id for r in out} == {1, 2, None, 4, 5, 6} and packed(spark, docs.limit(0), SF001).count() == 0
