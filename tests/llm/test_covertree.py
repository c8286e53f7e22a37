import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import covertree

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every, k):
    ok = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    ok = list({(i, tuple(v)) for i, v in ok})
    out = {}
    for i, v in ok:
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in ok if j != i)[:k]
            for r, (s, j) in enumerate(scores):
                out[i, r + 1] = (j, -s)
    return out


def search(spark, rows, every=5, k=5, **how):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)
    got = covertree.topk(df, F.col("vec_id") % every == 0, k, **how).collect()
    return {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in got}


def clustered(n, d, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 3, (6, d))
    return [(i, (centres[i % 6] + rng.normal(0, 0.2, d)).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("how", [dict(block_rows=40, query_rows=8, pivots=4), dict(block_rows=1000, query_rows=1000, pivots=2)])
def test_against_brute_force(spark, how):
    rows = clustered(300, 5, 1)
    assert search(spark, rows, **how) == brute(rows, 5, 5)


def test_odd_vectors(spark):
    rows = clustered(40, 3, 2) + [(100, None), (105, [1.0, None, 2.0]), (110, [float("nan"), 1.0, 1.0]), (115, [float("inf"), 0.0, 0.0]),
                                  (None, [1.0, 1.0, 1.0]), (120, [1.0]), (121, []), (125, [1.0, 2.0, 3.0, 4.0])]
    assert search(spark, rows, block_rows=16, query_rows=4, pivots=3) == brute(rows, 5, 5)


def test_ties_and_one_vector_for_a_third(spark):
    rows = clustered(120, 4, 3) + [(i, [1.0, 1.0, 1.0, 1.0]) for i in range(200, 260)] + [(7, clustered(120, 4, 3)[7][1])]
    assert search(spark, rows, block_rows=16, query_rows=4, pivots=4) == brute(rows, 5, 5)


def test_repeated_rows_take_one_place(spark):
    rows = clustered(120, 4, 3)
    want = brute(rows, 5, 5)
    often = [rows[want[0, r][0]] for r in (1, 3)]
    again = rows + often * 6 + [rows[0]] * 6 + [often[0]] * 80
    assert search(spark, again, block_rows=1000, query_rows=1000, pivots=2) == want
    assert search(spark, again, block_rows=16, query_rows=4, pivots=4) == want
    ended = [(i, [*v, 0.0, 0.0]) for i, v in often for _ in range(3)]       # the same vectors, ended by zeros
    assert search(spark, rows + ended, block_rows=1000, query_rows=1000, pivots=2) == want


def test_few_rows(spark):
    assert search(spark, [(0, [1.0]), (1, [2.0])]) == {(0, 1): (1, 256 * 512)}
    assert search(spark, [(0, [1.0])]) == {} and search(spark, [(1, [1.0])]) == {} and search(spark, []) == {}


def test_bounds_skip_nodes():
    rows = clustered(4000, 3, 4)
    ids, x = np.array([i for i, _ in rows]), np.floor(256 * np.array([v for _, v in rows])).astype(np.int64)
    r, q = covertree.Tree(ids, x), covertree.Tree(ids[:36:6] + 10_000, x[:36:6])     # queries near one pivot
    seen = []
    before = covertree.products
    covertree.products = lambda a, b: seen.append(len(a) * len(b)) or before(a, b)
    try:
        best = covertree.Best(6, 5)
        covertree.dual(q, r, best)
    finally:
        covertree.products = before
    for row, i in enumerate(q.ids):
        s = x @ q.x[row]
        top = np.lexsort((ids, -s))[:5]
        assert best.id[row].tolist() == ids[top].tolist()
    assert sum(seen) < 6 * 4000 / 2


def test_cover_tree_invariants():
    x = np.array([v for _, v in clustered(500, 4, 5)]) * 100
    t = covertree.Tree(np.arange(500), np.floor(x).astype(np.int64))
    for j in range(len(t.lo)):
        own = t.x[t.lo[j]:t.hi[j]].astype(float)
        assert np.sqrt(((own - t.centre[j]) ** 2).sum(1)).max() <= t.radius[j] + 1e-9
        kids = range(t.kid_lo[j], t.kid_hi[j])
        if len(kids):
            assert sum(t.hi[k] - t.lo[k] for k in kids) == t.hi[j] - t.lo[j]
            assert all(t.radius[k] <= t.radius[j] / 2 + 1e-9 for k in kids)
            gaps = [np.sqrt(((t.centre[a] - t.centre[b]) ** 2).sum()) for a in kids for b in kids if a < b]
            assert min(gaps, default=np.inf) > t.radius[j] / 2 - 1e-9
