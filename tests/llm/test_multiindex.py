import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import multiindex

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=5, m=3):
    rows = [(i, [math.floor(256 * float(np.float32(v))) for v in x], g) for i, x, g in rows
            if i is not None and g is not None and x is not None and all(v is not None and math.isfinite(v) for v in x)]
    rows = [(i, list(x), g) for i, x, g in dict.fromkeys((i, tuple(x), g) for i, x, g in rows)]
    out = []
    for a, x, g in rows:
        if a % 50:
            continue
        score = [(-sum(map(int.__mul__, x, y)), i, h) for i, y, h in rows if i != a]
        for p, i, _ in sorted(s for s in score if s[2] == g)[:k]:
            fit = sorted(s for s in score if s[2] != g and 50 * -p <= 100 * -s[0] <= 95 * -p)[:m]
            out += [(a, i, n, j, -p, -s) for n, (s, j, _) in enumerate(fit, 1)]
    return sorted(out)


def mined(df, **kw):
    out = multiindex.mine(df, F.col("vec_id") % 50 == 0, F.col("label"), **kw)
    return sorted(tuple(r) for r in out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.fixture
def small(monkeypatch):
    """Many cells, shelves, blocks and rounds out of few rows."""
    for name, value in {"CELL_ROWS": 6, "SHELF_ROWS": 10, "BLOCK_ANCHORS": 2, "TOGETHER": 2, "FIRST_ROWS": 8}.items():
        monkeypatch.setattr(multiindex, name, value)


def cloud(n, seed, width=6, labels=4):
    rng = random.Random(seed)
    centre = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(8)]
    return [(i, [c + rng.gauss(0, .3) for c in rng.choice(centre)], rng.randrange(labels)) for i in range(n)]


def test_many_rounds(spark, small):
    rows = cloud(250, 1)
    assert mined(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_ties_repeats_and_odd_rows(spark, small):
    rng = random.Random(2)
    rows = [(i, [float(rng.randrange(-1, 2)) for _ in range(3)], rng.randrange(2)) for i in range(150)]
    rows += [(i, [1.0, 1.0, 1.0], 0) for i in range(1000, 1120)]            # one vector with a third of the rows
    rows += [(50, [1.0, 0.0, 1.0], 1), (50, [1.0, 0.0, 1.0], 1), (None, [1.0], 1), (7, None, 1), (8, [1.0, None], 0), (9, [float("nan")], 0),
             (10, [float("inf")], 1), (2000, [1.0], None), (2050, [], 0), (2100, [2.0], 1), (2150, [-1.0, 5.0, 1.0, 3.0], 1), (2200, [0.0] * 3, 0)]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_few_rows(spark):
    rows = [(0, [1.0, 0.5], 1), (50, [1.0, 0.25], 1), (3, [0.75, 0.5], 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert mined(df) == brute(rows) != []
    assert mined(df.limit(0)) == mined(df.where("vec_id = 3")) == mined(df.where("vec_id = 0")) == []
    assert multiindex.mine(df.limit(0), F.lit(True), F.col("label")).columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_names_that_clash(spark, small):
    rows = cloud(120, 3)
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "x", "asks", "cell", "far", "block", "state"):
        df = df.withColumn(name, F.lit("?"))
    assert mined(df) == brute(rows)
    assert mined(df, positives=2, negatives=1) == brute(rows, 2, 1)


def test_most_cells_are_left_out(spark, small):
    """Clusters apart: the heap stops before half of the rows are read."""
    rng = random.Random(4)
    rows = [(i, [10.0 * (j == i % 8) + rng.gauss(0, .1) for j in range(8)], rng.randrange(3)) for i in range(800)]
    index = multiindex.Index((np.empty((0, 0)),) * 2, 4, 8)
    x = np.array([[math.floor(256 * v) for v in r[1]] for r in rows])
    index.books = tuple(multiindex.codebook(h.astype(float), 8) for h in (x[:, :4], x[:, 4:]))
    cell, far, off = index.cell(x.astype(float))
    index.fill([(c, int((cell == c).sum()), far[cell == c].max(), off[cell == c].max()) for c in np.unique(cell)])
    labels, ids = np.array([r[2] for r in rows]), np.arange(800)
    search = multiindex.Search(ids[:1], labels[:1], x[:1], [0], [multiindex.LEAST], [multiindex.MOST], True, 5)
    seen = read = 0
    while True:
        seen, done, wanted = search.plan(index, seen, 50)
        for w in wanted:
            pick = np.isin(cell, w["cells"])
            read += int(pick.sum())
            got = search.meet(ids[pick], labels[pick], x[pick])
            search.take(*(np.array(v) for v in zip(*got)) if got else (np.array([], int),) * 3)
        if done and not wanted:
            break
    assert search.size[0] == 5 and read < 400
