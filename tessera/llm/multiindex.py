"""Hard-negative mining over an inverted multi-index (operator 11).

A vector is two halves, each with a codebook of its own; a pair of codewords is a cell. For
anchor a no row of cell (i, j) scores more than (a1.c_i + |a1| r_i) + (a2.c_j + |a2| s_j),
r and s being the radii of the codewords. Both half bounds are sorted, and a heap walks the
cells by their sum (the multi-sequence algorithm), so whatever is left scores no more than
the cell on top. A search has slots: a window of scores, the same or other labels, and room
for some rows. It ends when no slot can get anything better from the cells that are left.

Anchors of one cell search together, as blocks; the bound of a block is the greatest of its
anchors'. In each round every open block asks for its next cells, up to a number of rows
that grows fourfold; blocks and stored rows meet in a join, and what was found is merged
into the blocks' state, a written table. Positives are one search (a slot for each anchor),
negatives another (a slot for each positive).
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import discard, drawn, written
from tessera.llm.covertree import products

#: Rows that codebooks are fitted on, steps of that, most codewords of a half, and rows that a cell should hold.
SAMPLE_ROWS, STEPS, MOST_CODEWORDS, CELL_ROWS = 8192, 8, 256, 256
#: Rows stored together, anchors of a block, blocks that meet stored rows in one task, and rows asked for in the first round.
SHELF_ROWS, BLOCK_ANCHORS, TOGETHER, FIRST_ROWS = 4096, 256, 64, 4096
LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
STATE = "block string, seen long, done boolean, wanted array<struct<shelf:int,cells:array<int>>>, state binary"


def codebook(x: np.ndarray, k: int) -> np.ndarray:
    """At most ``k`` centres of the rows of ``x``: Lloyd's steps from the first distinct rows."""
    centre = np.unique(x, axis=0, return_index=True)[1]
    centre = x[np.sort(centre)[:k]]
    for _ in range(STEPS):
        own = nearest(x, centre)[0]
        n = np.bincount(own, minlength=len(centre))
        total = np.zeros_like(centre)
        np.add.at(total, own, x)
        centre = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centre)
    return centre


def nearest(x: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's nearest centre and the distance to it."""
    own = np.argmin((centre ** 2).sum(1) - 2 * x @ centre.T, axis=1)
    return own, np.sqrt(((x - centre[own]) ** 2).sum(1))


@dataclass
class Index:
    """Codebooks, radii, and what each cell holds; at most MOST_CODEWORDS squared cells."""

    books: tuple[np.ndarray, np.ndarray]
    half: int
    width: int
    rows: np.ndarray = None         # of each cell
    radii: np.ndarray = None        # of each cell, in either half
    reach: tuple[np.ndarray, np.ndarray] = None     # radii of the codewords
    shelf: np.ndarray = None        # where a cell is stored, and on how many shelves from there
    shelves: np.ndarray = None

    def matrix(self, vectors) -> np.ndarray:
        out = np.zeros((len(vectors), self.width), np.int64)
        for row, v in zip(out, vectors):
            row[:len(v)] = v
        return out

    def cell(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each row's cell, and the distances to its two codewords."""
        (a, far), (b, off) = nearest(x[:, :self.half], self.books[0]), nearest(x[:, self.half:], self.books[1])
        return a * len(self.books[1]) + b, far, off

    def fill(self, cells: list) -> None:
        """Take in (cell, rows, radius, radius), and lay the cells on shelves."""
        n, k = len(self.books[0]) * len(self.books[1]), len(self.books[1])
        self.rows, self.radii = np.zeros(n, np.int64), np.zeros((2, n))
        for c, rows, far, off in cells:
            self.rows[c], self.radii[:, c] = rows, (far, off)
        grid = self.radii.reshape(2, -1, k)
        self.reach = grid[0].max(1), grid[1].max(0)
        self.shelf, self.shelves = np.zeros(n, np.int64), np.ones(n, np.int64)
        at = held = 0
        for c in np.flatnonzero(self.rows).tolist():
            rows = int(self.rows[c])
            if held and held + rows > SHELF_ROWS:
                at, held = at + 1, 0
            self.shelf[c], self.shelves[c] = at, -(-rows // SHELF_ROWS)
            held += rows
            if held >= SHELF_ROWS:
                at, held = at + int(self.shelves[c]), 0

    def walk(self, x: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """(bound, codeword, codeword) of all cells, the greatest bound for any row of ``x`` first."""
        sums = []
        for part, book, reach in zip((x[:, :self.half], x[:, self.half:]), self.books, self.reach):
            bound = part @ book.T + np.sqrt((part ** 2).sum(1))[:, None] * reach
            sums.append(bound.max(0))
        left, right = np.argsort(-sums[0], kind="stable"), np.argsort(-sums[1], kind="stable")
        a, b = sums[0][left], sums[1][right]
        heap = [(-(a[0] + b[0]), 0, 0)]
        while heap:
            bound, p, q = heappop(heap)
            yield -bound, int(left[p]), int(right[q])
            if q + 1 < len(b):
                heappush(heap, (-(a[p] + b[q + 1]), p, q + 1))
            if q == 0 and p + 1 < len(a):
                heappush(heap, (-(a[p + 1] + b[0]), p + 1, 0))


class Search:
    """A block of anchors and its slots: windows [low, high] of one anchor each, with the ``k`` best rows so far."""

    def __init__(self, ids, labels, x, row, low, high, same: bool, k: int):
        self.ids, self.labels, self.x, self.same, self.k = ids, labels, x, same, k
        self.row, self.low, self.high = (np.asarray(v, np.int64) for v in (row, low, high))
        self.score = np.full((len(self.row), k), LEAST)
        self.found = np.full((len(self.row), k), MOST)
        self.size = np.zeros(len(self.row), np.int64)

    def need(self) -> np.ndarray:
        """What a row must score at least to matter to a slot."""
        full = (self.size == self.k) & (self.k > 0)
        return np.where(self.low > self.high, MOST, np.where(full, self.score[:, -1], self.low))

    def plan(self, index: Index, seen: int, budget: int) -> tuple[int, bool, list[dict]]:
        """Cells walked so far, whether that is all that can matter, and what to read for it."""
        need = self.need().astype(float)
        live = need < MOST
        if not live.any():
            return seen, True, []
        x = self.x[np.unique(self.row[live])].astype(float)
        own = self.x[self.row[live]].astype(float)
        need, high = need[live], self.high[live].astype(float)
        ends, half = need.min(), index.half
        dots = own[:, :half] @ index.books[0].T, own[:, half:] @ index.books[1].T
        norms = [np.sqrt((v ** 2).sum(1)) for v in (own[:, :half], own[:, half:])]
        wanted, rows, k = {}, 0, len(index.books[1])
        for n, (bound, i, j) in enumerate(index.walk(x)):
            if bound + 1e-6 * (abs(bound) + 1) < ends:
                return n, True, _wanted(wanted)
            if n < seen:
                continue
            if rows >= budget:
                return n, False, _wanted(wanted)
            c = i * k + j
            if not index.rows[c]:
                continue
            centre, spread = dots[0][:, i] + dots[1][:, j], norms[0] * index.radii[0, c] + norms[1] * index.radii[1, c]
            spread = spread + 1e-6 * (np.abs(centre) + spread + 1)
            if ((centre + spread >= need) & (centre - spread <= high)).any():
                rows += int(index.rows[c])
                for s in range(int(index.shelves[c])):
                    wanted.setdefault(int(index.shelf[c]) + s, []).append(c)
        return index.rows.size, True, _wanted(wanted)

    def meet(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> list[tuple[int, int, int]]:
        """(slot, score, id) of the rows that may stand among a slot's best."""
        scores, need, out = products(self.x.astype(np.int64), x.astype(np.int64)), self.need(), []
        for a in range(len(self.ids)):
            slots = np.flatnonzero(self.row == a)
            if not len(slots):
                continue
            s = scores[a]
            ok = (s >= need[slots].min()) & (s <= self.high[slots].max()) & (ids != self.ids[a])
            ok &= (labels == self.labels[a]) if self.same else (labels != self.labels[a])
            at = np.flatnonzero(ok)
            if not len(at):
                continue
            at = at[np.lexsort((ids[at], -s[at]))]
            for slot in slots:
                some = at[(s[at] >= need[slot]) & (s[at] <= self.high[slot])][:self.k]
                out += zip([int(slot)] * len(some), s[some].tolist(), ids[some].tolist())
        return out

    def take(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        for s in np.unique(slot):
            new, n = slot == s, self.size[s]
            sc, fo = np.concatenate([self.score[s, :n], score[new]]), np.concatenate([self.found[s, :n], ids[new]])
            best = np.lexsort((fo, -sc))[:self.k]
            self.size[s] = n = len(best)
            self.score[s, :n], self.found[s, :n] = sc[best], fo[best]


def _wanted(cells: dict[int, list[int]]) -> list[dict]:
    return [{"shelf": s, "cells": sorted(c)} for s, c in sorted(cells.items())]


def _small(x: np.ndarray) -> np.ndarray:
    """Whole numbers in as few bytes as hold them."""
    most = int(np.abs(x).max(initial=0))
    return x.astype(np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64)


def _state(block: str, search: Search, index: Index, seen: int, budget: int) -> pd.DataFrame:
    seen, done, wanted = search.plan(index, seen, budget)
    # what is still to be read may not be all that can matter once it has been
    return pd.DataFrame({"block": [block], "seen": [seen], "done": [done and not wanted], "wanted": [wanted], "state": [pickle.dumps(search, 5)]})


def _rounds(state: DataFrame, shelves: DataFrame, index: Index) -> list[DataFrame]:
    """Tables of the blocks' final states."""
    ended, budget = [], FIRST_ROWS
    while True:
        state = written(state, "searches")
        ended.append(state.where("done"))
        going = state.where("NOT done")
        asks = going.select("block", F.explode("wanted").alias("w")).select("block", "w.shelf", "w.cells")
        ways = asks.groupBy("shelf").agg(F.ceil(F.count(F.lit(1)) / F.lit(TOGETHER)).alias("ways"))
        if going.isEmpty():
            return ended
        asks = written(asks.join(ways, "shelf").withColumn("way", F.pmod(F.xxhash64("block"), F.col("ways"))).drop("ways"), "asks")
        left = asks.select("shelf", "way").distinct().join(shelves, "shelf")
        right = asks.join(going.select("block", "state"), "block").select(
            F.col("shelf").alias("shelf_"), F.col("way").alias("way_"), "block", "cells", "state")

        def meet(stored: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
            out = []
            for packed in stored["packed"]:
                cell, ids, labels, x = pickle.loads(packed)
                for block, cells, data in zip(asking["block"], asking["cells"], asking["state"]):
                    pick = np.isin(cell, np.asarray(cells))
                    out += [(block, *row) for row in pickle.loads(data).meet(ids[pick], labels[pick], x[pick])]
            return pd.DataFrame(out, columns=["block", "slot", "score", "id"]).astype({"slot": "int64", "score": "int64", "id": "int64"})

        hits = left.groupBy("shelf", "way").cogroup(right.groupBy("shelf_", "way_")).applyInPandas(
            meet, "block string, slot long, score long, id long")
        budget *= 4
        more = budget

        def update(old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
            out = []
            for block, seen, data in zip(old["block"], old["seen"], old["state"]):
                search = pickle.loads(data)
                search.take(new["slot"].to_numpy(), new["score"].to_numpy(), new["id"].to_numpy())
                out.append(_state(block, search, index, int(seen), more))
            return pd.concat(out) if out else pd.DataFrame(columns=["block", "seen", "done", "wanted", "state"])

        state = going.groupBy("block").cogroup(hits.groupBy("block")).applyInPandas(update, STATE)


def mine(vectors: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         id_col: str = "vec_id", vec_col: str = "embedding", scale: float = 256.0) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components become floor(scale * x); the score is the integer inner product (exact as
    long as it fits a long); higher scores come first, ties by smaller id. An anchor's
    positives are its first ``positives`` other rows of its label; of each positive the first
    ``negatives`` rows of other labels are returned whose score is ``low`` to ``high`` percent
    of the positive's (none of a negative score's). ``label`` (a whole number) and ``is_anchor``
    are computed from a row. Rows with a null id or label, a null vector or null or
    non-finite components take no part. Of vectors of different lengths the shorter one counts
    as ended by zeros. Rows repeated with one id, label and vector count once; of rows that
    share label and vector but not the id, all are anchors, and those with the smallest ids
    are enough as partners, since they tie everywhere. With fewer partners than asked for all
    are returned; without anchors, none. Other columns are never looked at.

    The codebooks are fitted on about ``SAMPLE_ROWS`` rows chosen by a hash; they decide
    only how rows are stored: every row is indexed, and the result is exact whatever they are.
    """
    spark = vectors.sparkSession
    x = F.col("x")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("long").alias("label"),
                          F.col(f"`{vec_col}`").cast("array<double>").alias("x"), F.coalesce(is_anchor, F.lit(False)).alias("asks"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & x.isNotNull()).where(~bad)
    rows = rows.withColumn("x", F.transform(x, lambda v: F.floor(v * F.lit(scale))))
    rows = rows.groupBy("id", "label", "x").agg(F.max("asks").alias("asks"))
    alike = Window.partitionBy("x", "label").orderBy("id")
    rows = written(rows, "rows")
    partners = rows.withColumn("n", F.row_number().over(alike)).where(F.col("n") <= max(positives + 1, negatives)).drop("n")
    stats = rows.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not stats[0]:
        return spark.createDataFrame([], out)
    width = max(2, stats[1])
    some = [r.x for r in drawn(rows.select("id", "x"), ["id", "x"], SAMPLE_ROWS, stats[0])]
    index = Index((np.empty((0, 0)),) * 2, (width + 1) // 2, width)
    sample = index.matrix(some).astype(float)
    k = min(MOST_CODEWORDS, max(1, round((stats[0] / CELL_ROWS) ** 0.5)))
    index.books = codebook(sample[:, :index.half], k), codebook(sample[:, index.half:], k)

    def place(batches):
        for batch in batches:
            cell, far, off = index.cell(index.matrix(batch.column("x").to_pylist()).astype(float))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32()), pa.array(far), pa.array(off)],
                                             names=[*batch.schema.names, "cell", "far", "off"])

    placed = "id long, label long, x array<long>, asks boolean, cell int, far double, off double"
    stored = written(partners.mapInArrow(place, placed), "stored")
    anchors = written(rows.where("asks").mapInArrow(place, placed), "anchors")
    cells = stored.groupBy("cell").agg(F.count(F.lit(1)), F.max("far"), F.max("off")).collect()     # MOST_CODEWORDS squared at most
    index.fill([tuple(c) for c in cells])

    # a row for each cell
    where = spark.createDataFrame([(int(c.cell), int(index.shelf[c.cell]), int(index.shelves[c.cell])) for c in cells],
                                  "cell int, first int, ways int")

    def shelve(group: pd.DataFrame) -> pd.DataFrame:
        packed = (group["cell"].to_numpy(), group["id"].to_numpy(np.int64), group["label"].to_numpy(np.int64), _small(index.matrix(group["x"])))
        return pd.DataFrame({"shelf": [int(group["shelf"].iloc[0])], "packed": [pickle.dumps(packed, 5)]})

    shelves = written(stored.join(F.broadcast(where), "cell").withColumn(
        "shelf", (F.col("first") + F.pmod(F.xxhash64("id"), F.col("ways"))).cast("int")).select("shelf", "cell", "id", "label", "x")
        .groupBy("shelf").applyInPandas(shelve, "shelf int, packed binary"), "shelves")

    def begin(group: pd.DataFrame) -> pd.DataFrame:
        n = len(group)
        search = Search(group["id"].to_numpy(np.int64), group["label"].to_numpy(np.int64), _small(index.matrix(group["x"])),
                        range(n), [LEAST] * n, [MOST] * n, True, positives)
        return _state(group["block"].iloc[0], search, index, 0, FIRST_ROWS)

    sizes = anchors.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_ANCHORS)).alias("ways"))
    block = F.concat_ws(".", "cell", F.pmod(F.xxhash64("id"), F.col("ways")))
    blocks = anchors.join(F.broadcast(sizes), "cell").select(block.alias("block"), "id", "label", "x")
    near = _rounds(blocks.groupBy("block").applyInPandas(begin, STATE), shelves, index)

    def turn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, data in zip(frame["block"], frame["state"]):
                s = pickle.loads(data)
                row, at = np.nonzero(np.arange(s.k) < s.size[:, None])
                score = s.score[row, at]
                search = Search(s.ids, s.labels, s.x, s.row[row], [-(-low * p // 100) for p in score.tolist()],
                                [high * p // 100 for p in score.tolist()], False, negatives)
                search.asked = s.found[row, at], score
                yield _state(name, search, index, 0, FIRST_ROWS)

    far = _rounds(_all(near).mapInPandas(turn, STATE), shelves, index)

    def results(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for data in frame["state"]:
                s = pickle.loads(data)
                slot, at = np.nonzero(np.arange(s.k) < s.size[:, None])
                yield pd.DataFrame({"anchor_id": s.ids[s.row[slot]], "positive_id": s.asked[0][slot], "rank": (at + 1).astype(np.int32),
                                    "negative_id": s.found[slot, at], "positive_score": s.asked[1][slot], "negative_score": s.score[slot, at]})

    done = written(_all(far).mapInPandas(results, out), "negatives")
    discard(rows, stored, anchors, shelves)
    return done


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out
