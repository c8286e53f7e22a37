"""Quality classifier: a factorisation machine (operator 3).

Inputs of a score are hashed words, statistics of a text's structure and metadata that
the caller names, all as one sparse vector x. The machine scores

    w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

in time linear in the entries of x, since the pairwise sum is half of
sum_f (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2. It is trained by rounds of Adagrad on
shards of a bounded sample of labelled rows, whose weights are averaged after each round.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tessera.llm.common import slices, text_bytes, written

#: Labelled rows that training uses (in expectation), and the tasks among which they are dealt.
SAMPLE_ROWS, TRAIN_SHARDS = 20_000, 4
BUCKETS, FACTORS, BINS, ROUNDS, EPOCHS = 1 << 13, 6, 10, 5, 3

STATISTICS = ("chars", "words", "word length", "upper", "digits", "signs", "pipes", "lines", "line length",
              "distinct words", "same word again", "commonest word", "same line again", "words with signs",
              "ends of sentences", "not ascii")
_signs = re.compile(r"[^\w\s.,;:'\"?!()-]")
_upper, _digit, _end = re.compile(r"[A-Z]"), re.compile(r"[0-9]"), re.compile(r"[.?!](?:\s|$)")
_sign_word = re.compile(r"\w(?:([^\w\s])\1+)(?=\s|$)")


def structure(text: str, words: list[str]) -> list[float]:
    """The values named in STATISTICS; of an empty text all are 0."""
    n, m = max(len(text), 1), max(len(words), 1)
    lines = text.split("\n")
    again = sum(map(str.__eq__, words, words[1:]))
    return [np.log1p(len(text)), np.log1p(len(words)), len(text) / m, len(_upper.findall(text)) / n,
            len(_digit.findall(text)) / n, len(_signs.findall(text)) / n, text.count("|") / m, np.log1p(len(lines)),
            np.log1p(len(text) / len(lines)), len(set(words)) / m, again / m, _commonest(words) / m,
            1 - len(set(lines)) / len(lines), len(_sign_word.findall(text)) / m, len(_end.findall(text)) / m,
            (len(text.encode()) - len(text)) / n]


def _commonest(words: list[str]) -> int:
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    return max(counts.values(), default=0)


def read_text(text: str | None) -> tuple[np.ndarray, list[float]]:
    """(distinct hashed words, statistics) of a whole text; null counts as empty."""
    text = text or ""
    words = text.split()
    hashed = np.fromiter((crc32(w.encode()) for w in set(text.lower().split())), np.int64) % BUCKETS
    return np.unique(hashed), structure(text, words)


@dataclass
class Machine:
    """edges: (statistics and metadata, BINS - 1) bounds of bins; w0, w, v: the weights."""

    edges: np.ndarray
    w0: float
    w: np.ndarray
    v: np.ndarray

    def entries(self, hashed: np.ndarray, numbers: list[float]) -> tuple[np.ndarray, np.ndarray]:
        """(index, value) of a row: words share a length of 1, each number is one of its bins.

        The bin after the last stands for a missing number.
        """
        x = np.asarray(numbers, float)
        at = (x[:, None] > self.edges).sum(1)
        at[np.isnan(x)] = BINS
        index = np.concatenate([hashed, BUCKETS + np.arange(len(x)) * (BINS + 1) + at])
        value = np.concatenate([np.full(len(hashed), 1 / np.sqrt(max(len(hashed), 1))), np.full(len(x), 1 / np.sqrt(len(x)))])
        return index, value

    def raw(self, index: np.ndarray, value: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the logistic curve, and each row's sums of factors."""
        vx = self.v[index] * value[:, None]
        sums = np.add.reduceat(vx, start, axis=0)
        pairs = 0.5 * (sums ** 2 - np.add.reduceat(vx ** 2, start, axis=0)).sum(1)
        return self.w0 + np.add.reduceat(self.w[index] * value, start) + pairs, sums

    def score(self, index, value, start) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(index, value, start)[0], -30, 30)))


def train(m: Machine, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int, seed: int,
          rate: float = 0.3, l2: float = 1e-5, batch: int = 64) -> Machine:
    """Some epochs of Adagrad on the logistic loss."""
    m = replace(m, w=m.w.copy(), v=m.v.copy())
    order, size = np.random.default_rng(seed), len(m.w)
    g0, gw, gv = 1e-6, np.full(size, 1e-6), np.full(m.v.shape, 1e-6)
    for _ in range(epochs):
        for pick in np.array_split(order.permutation(len(rows)), max(1, len(rows) // batch)):
            index, value = (np.concatenate([rows[i][k] for i in pick]) for k in (0, 1))
            lengths = np.array([len(rows[i][0]) for i in pick])
            start, doc = np.cumsum(lengths) - lengths, np.repeat(np.arange(len(pick)), lengths)
            raw, sums = m.raw(index, value, start)
            err = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[pick]) / len(pick)
            d = err.sum()
            g0 += d * d
            m.w0 -= rate * d / np.sqrt(g0)
            ex = err[doc] * value
            dw = np.bincount(index, ex, size) + l2 * m.w
            gw += dw * dw
            m.w -= rate * dw / np.sqrt(gw)
            for f in range(m.v.shape[1]):
                dv = np.bincount(index, ex * (sums[doc, f] - m.v[index, f] * value), size) + l2 * m.v[:, f]
                gv[:, f] += dv * dv
                m.v[:, f] -= rate * 0.3 * dv / np.sqrt(gv[:, f])
    return m


def _numbers(batch: pa.RecordBatch, meta: list[str]) -> list[list[float]]:
    """Metadata of each row, log-scaled; a null or non-finite value is missing."""
    found = []
    for c in meta:
        x = batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False).astype(float)
        found.append(np.where(np.isfinite(x), np.sign(x) * np.log1p(np.abs(x)), np.nan))
    return np.array(found).T.tolist() if found else [[] for _ in range(batch.num_rows)]


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
        meta: tuple[str, ...] = (), sample_rows: int = SAMPLE_ROWS) -> Machine:
    """A machine trained on the labelled rows of ``docs``.

    ``labels`` has ``id_col`` and ``label_col`` (0 or 1; other values and nulls are
    ignored; of repeated ids one row counts, 1 if any of them says so). About
    ``sample_rows`` ids are used, chosen by a hash: that bounds what is broadcast at any size
    of input. Each is trained on once, on the row of ``docs`` whose text has the greatest hash if
    several have the id: that bounds the training, whatever share of the rows one id has.
    Without labelled rows every score is 0.5. ``meta`` names numeric columns of ``docs``.
    """
    spark = docs.sparkSession
    given = labels.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{label_col}`").cast("int").alias("_y"))
    given = given.where("_id IS NOT NULL AND _y IN (0, 1)").groupBy("_id").agg(F.max("_y").alias("_y"))
    n = given.count()
    chance = F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = given.where(chance < F.lit(sample_rows / max(n, 1)))
    names = [f"_m{i}" for i in range(len(meta))]
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"),
                       *[F.col(f"`{c}`").cast("double").alias(k) for c, k in zip(meta, names)])
    met = rows.join(F.broadcast(sample), "_id").groupBy("_id").agg(F.max_by(
        F.struct("_text", *names, "_y"), F.xxhash64("_text")).alias("r")).select("_id", "r.*")

    def features(batches):
        for batch in batches:
            for a, b in slices(batch, text_bytes(batch, "_text")):
                part = batch.slice(a, b - a)
                read = [read_text(t) for t in part.column("_text").to_pylist()]
                more = _numbers(part, names)
                yield pa.RecordBatch.from_arrays([
                    part.column("_id").cast(pa.string()), pa.array([h.tolist() for h, _ in read], pa.list_(pa.int32())),
                    pa.array([s + x for (_, s), x in zip(read, more)], pa.list_(pa.float64())),
                    part.column("_y")], names=["id", "hashed", "numbers", "y"])

    ready = written(met.mapInArrow(features, "id string, hashed array<int>, numbers array<double>, y int"), "labelled")
    width = len(STATISTICS) + len(meta)
    cuts = [i / BINS for i in range(1, BINS)]
    quantiles = ready.select(*[F.percentile_approx(F.when(~F.isnan(F.col("numbers")[i]), F.col("numbers")[i]), cuts, 2000)
                               for i in range(width)]).first()
    edges = np.array([q or [0.0] * len(cuts) for q in quantiles])
    size = BUCKETS + width * (BINS + 1)
    m = Machine(edges, 0.0, np.zeros(size), np.random.default_rng(1).normal(0, 0.05, (size, FACTORS)))
    if not n:
        return Machine(edges, 0.0, np.zeros(size), np.zeros((size, FACTORS)))
    dealt = ready.withColumn("shard", F.pmod(F.xxhash64("id", F.lit("shard")), F.lit(TRAIN_SHARDS)))
    for k in range(ROUNDS):
        found = dealt.groupBy("shard").applyInPandas(
            _trainer(spark.sparkContext.broadcast(m), k), "n long, w0 double, w array<double>, v array<double>").collect()
        if found:                           # TRAIN_SHARDS rows of fixed length
            found.sort(key=lambda r: (r.n, r.w0))
            mean = lambda x: np.average(np.array(x), axis=0, weights=[r.n for r in found])
            m = Machine(edges, float(mean([r.w0 for r in found])), mean([r.w for r in found]),
                        mean([r.v for r in found]).reshape(size, FACTORS))
    return m


def _trainer(now, seed: int):
    """What trains the machine ``now`` on one shard."""

    def one_shard(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["id", "y"], kind="stable")
        rows = [now.value.entries(np.asarray(h, np.int64), x) for h, x in zip(group["hashed"], group["numbers"])]
        got = train(now.value, rows, group["y"].to_numpy(float), EPOCHS, seed)
        return pd.DataFrame({"n": [len(rows)], "w0": [got.w0], "w": [got.w.tolist()], "v": [got.v.ravel().tolist()]})

    return one_shard


def score(docs: DataFrame, machine: Machine, text_col: str = "text", meta: tuple[str, ...] = (), out: str = "score") -> DataFrame:
    """``docs`` plus ``out``, the chance of label 1 by the machine, from 0 to 1.

    Null and empty texts are scored by their statistics, all 0; a missing metadata value
    has weights of its own. Each row is scored by itself; an empty table gives no rows. A
    column named ``out`` gives way to the score.
    """
    docs = docs.drop(out)
    model = docs.sparkSession.sparkContext.broadcast(machine)
    schema = StructType([*docs.schema.fields, StructField(out, DoubleType())])
    meta = list(meta)

    def run(batches):
        m = model.value
        for batch in batches:
            for a, b in slices(batch, text_bytes(batch, text_col)):
                part = batch.slice(a, b - a)
                rows = [m.entries(h, s + x) for (h, s), x in
                        zip(map(read_text, part.column(text_col).to_pylist()), _numbers(part, meta))]
                lengths = np.array([len(i) for i, _ in rows])
                got = m.score(np.concatenate([i for i, _ in rows]), np.concatenate([v for _, v in rows]),
                              np.cumsum(lengths) - lengths)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(got)], names=[*part.schema.names, out])

    return docs.mapInArrow(run, schema)
