import numpy as np
import pytest

from tessera.llm import quality
from tests.conftest import SF01

GOOD = "The quiet river runs past the old mill, and children walk along it to school. "
BAD = "buy!! %%% now!! $$$ click ||| click ||| click ||| "


@pytest.fixture(scope="module")
def machine(spark):
    docs = spark.createDataFrame([(i, (GOOD if i % 3 else BAD) * (1 + i % 7), i % 50) for i in range(300)], "doc_id long, text string, m long")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(300)] + [(None, 1), (5, None), (6, 9), (1, 1)], "doc_id long, quality int")
    return quality.fit(docs, labels, meta=("m",))


def test_pairs_by_sums_of_squares(machine):
    rng = np.random.default_rng(0)
    index, value = rng.choice(len(machine.w), 40, replace=False), rng.normal(size=40)
    got = machine.raw(index, value, np.array([0]))[0][0]
    pairs = sum(machine.v[index[i]] @ machine.v[index[j]] * value[i] * value[j] for i in range(40) for j in range(i))
    assert got == pytest.approx(machine.w0 + machine.w[index] @ value + pairs)


def test_gradient_step_lowers_the_loss(machine):
    rows = [machine.entries(*[x if k == 0 else [*x, 1.0] for k, x in enumerate(quality.read_text(t))]) for t in (GOOD, BAD) * 20]
    labels = np.array([1.0, 0.0] * 20)
    blank = quality.Machine(machine.edges, 0.0, np.zeros_like(machine.w), np.random.default_rng(1).normal(0, 0.05, machine.v.shape))
    lengths = np.array([len(i) for i, _ in rows])
    flat = [np.concatenate([r[k] for r in rows]) for k in (0, 1)]
    loss = lambda m: -np.mean(np.log(np.where(labels > 0, p := m.score(*flat, np.cumsum(lengths) - lengths), 1 - p)))
    assert loss(quality.train(blank, rows, labels, 3, 0)) < 0.5 * loss(blank)


def test_scores_and_odd_rows(spark, machine):
    rows = [(1, GOOD * 5, 3, 1.0), (1, GOOD * 5, 3, 1.0), (2, BAD * 5, 3, None), (3, None, None, 2.0), (None, "", 7, 0.0), (4, GOOD * 20_000, 1, 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, m long, score double")
    out = quality.score(docs, machine, meta=("m",))
    assert out.columns == docs.columns                       # the column named score gave way
    by = {}
    for r in out.collect():
        assert 0 <= r.score <= 1
        by.setdefault(r.doc_id, []).append(r.score)
    assert len(by[1]) == 2 and by[1][0] == by[1][1] > 0.7 > 0.3 > by[2][0]
    assert quality.score(docs.limit(0), machine, meta=("m",)).count() == 0


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.score(docs, quality.fit(docs, labels)).first().score == 0.5


def test_held_out_rows_of_the_table(spark):
    import zlib

    from tessera.llm.queries import QUERIES
    got = {r.doc_id: r for r in QUERIES["op3_factorisation_machine"](spark, SF01).collect()}
    assert len(got) == spark.read.parquet(f"{SF01}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.7) for i, r in got.items())
    labels = [r for r in spark.read.parquet(f"{SF01}/labels.parquet").collect() if got[r.doc_id].held_out]
    right = [got[r.doc_id].predicted == r.quality for r in labels]
    assert len(right) > 50 and np.mean(right) > 0.95


def test_one_id_with_a_third_of_all_rows(spark):
    """Labels and documents repeated under one id are trained on once: the machine is the same without them."""
    docs = [(i, (GOOD if i % 3 else BAD) * (1 + i % 7)) for i in range(60)]
    labels = [(i, int(i % 3 > 0)) for i in range(60)]
    frame = lambda rows, kind: spark.createDataFrame(rows, kind)
    once = quality.fit(frame(docs, "doc_id long, text string"), frame(labels, "doc_id long, quality int"))
    more = quality.fit(frame(docs + [docs[4]] * 40, "doc_id long, text string"), frame(labels + [labels[4]] * 40 + [(4, 0)], "doc_id long, quality int"))
    assert once.w0 == more.w0 and (once.w == more.w).all() and (once.v == more.v).all()
