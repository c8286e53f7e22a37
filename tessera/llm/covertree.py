"""Exact top-k inner products by dual-tree search over cover trees (operator 5).

Candidates and queries are both indexed. Vectors are dealt to the nearest of some pivots
and from there to blocks of bounded size; each block becomes a cover tree, in one task.
Every node keeps its centre, its covering radius and its rows. For a group of queries
with centre a and radius r and a candidate node with centre b and radius s no inner
product exceeds a.b + r|b| + s|a| + rs; a pair of nodes is dropped when that is below the
worst k-th score that any query of the group has so far. The same bound, on the roots,
first picks each query block's most promising candidate block, and then drops blocks.
"""

from __future__ import annotations

import io
import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import drawn, written

#: Rows of a candidate and a query block, pivots (at least, and at most), and query blocks that meet a tree in one task.
BLOCK_ROWS, QUERY_ROWS, PIVOTS, MOST_PIVOTS, TOGETHER = 4096, 512, 64, 8192, 16
#: Rows of a leaf, queries that stay one group, and children into which a larger group is still split.
LEAF, QUERY_LEAF, SPLIT = 64, 64, 16


class Tree:
    """A cover tree over rows of ``x``, which are reordered so that a node's are adjacent.

    Children of a node with covering radius r are centred on rows more than r/2 apart;
    together they cover the node within r/2. Arrays by node: centre (row), radius (to the
    farthest row), first and last row, first and last child.
    """

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        n = len(x)
        order, y = np.arange(n), x.astype(float)
        far = lambda rows, c: np.sqrt(((y[rows] - y[c]) ** 2).sum(1))
        centre, radius, lo, hi, kid_lo, kid_hi = [0], [float(far(order, 0).max())], [0], [n], [], []
        at = 0
        while at < len(centre):
            rows, r = order[lo[at]:hi[at]], radius[at]
            kid_lo.append(len(centre))
            if len(rows) > LEAF and r > 0:
                c, parts = centre[at], []
                while len(rows):
                    d = far(rows, c)
                    near = d <= r / 2
                    parts.append(rows[near])
                    centre.append(c)
                    radius.append(float(d[near].max()))
                    rows = rows[~near]
                    c = rows[0] if len(rows) else c
                ends = lo[at] + np.cumsum([len(p) for p in parts])
                order[lo[at]:hi[at]] = np.concatenate(parts)
                lo += [lo[at], *ends[:-1].tolist()]
                hi += ends.tolist()
            kid_hi.append(len(centre))
            at += 1
        self.ids, self.x = ids[order], x[order]
        self.centre = y[centre]
        self.norm = np.sqrt((self.centre ** 2).sum(1))
        self.radius, self.lo, self.hi, self.kid_lo, self.kid_hi = map(np.array, (radius, lo, hi, kid_lo, kid_hi))

    def __len__(self) -> int:
        return len(self.ids)


class Best:
    """The k best (score, id) of each query, and pairs of a query and its own row left out."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), np.iinfo(np.int64).min)
        self.id = np.full((n, k), np.iinfo(np.int64).max)
        self.size = np.zeros(n, int)

    def worst(self, rows: slice) -> float:
        return -np.inf if (self.size[rows] < self.k).any() else float(self.score[rows, -1].min())

    def offer(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        hit = scores >= self.score[q, -1]
        if not hit.any():
            return
        m = self.size[q]
        s, i = np.concatenate([self.score[q, :m], scores[hit]]), np.concatenate([self.id[q, :m], ids[hit]])
        first = np.lexsort((i, -s))[:self.k]
        self.size[q] = m = len(first)
        self.score[q, :m], self.id[q, :m] = s[first], i[first]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of integer rows; by float64 where that is exact."""
    d = min(a.shape[1], b.shape[1])
    a, b = a[:, :d], b[:, :d]
    if float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(d, 1) < 2 ** 53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


def dual(q: Tree, r: Tree, best: Best) -> None:
    """Offer to ``best`` (rows as in ``q``) all of ``r`` that the bounds don't rule out."""
    d = min(q.centre.shape[1], r.centre.shape[1])
    todo = [(0, 0)]
    while todo:
        i, j = todo.pop()
        rows = slice(q.lo[i], q.hi[i])
        a, n = q.centre[i, :d], np.sqrt((q.centre[i] ** 2).sum())
        nodes = np.arange(r.kid_lo[j], r.kid_hi[j])
        if not len(nodes):
            nodes = np.array([j])
        bound = r.centre[nodes, :d] @ a + q.radius[i] * r.norm[nodes] + r.radius[nodes] * n + q.radius[i] * r.radius[nodes]
        live = bound + 1e-6 * (np.abs(bound) + 1) >= best.worst(rows)
        nodes, bound = nodes[live], bound[live]
        if not len(nodes):
            continue
        kids = np.arange(q.kid_lo[i], q.kid_hi[i])
        if q.hi[i] - q.lo[i] > QUERY_LEAF and 0 < len(kids) <= SPLIT and q.radius[i] >= r.radius[j]:
            todo += [(k, j) for k in kids]      # a tighter group of queries may rule out more
            continue
        end = (r.kid_hi[nodes] == r.kid_lo[nodes])
        if end.any():                       # all rows of the nodes without children, at once
            pick = np.concatenate([np.arange(r.lo[k], r.hi[k]) for k in nodes[end]])
            got, ids = products(q.x[rows], r.x[pick]), r.ids[pick]
            for k in range(got.shape[0]):
                row = q.lo[i] + k
                s, own = got[k], ids != q.ids[row]
                best.offer(row, s[own], ids[own])
        rest = np.argsort(bound[~end], kind="stable")
        todo += [(i, k) for k in nodes[~end][rest]]     # the most promising one comes off first


def _pack(tree: Tree) -> bytes:
    out = io.BytesIO()
    pickle.dump(tree, out, protocol=5)
    return out.getvalue()


def _forest(rows: DataFrame, block: list[str]) -> DataFrame:
    """One cover tree for each block: block, n, centre, radius, tree."""

    def build(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id", kind="stable")
        width = max(map(len, group["x"]))
        x = np.array([np.pad(np.asarray(v, np.int64), (0, width - len(v))) for v in group["x"]], np.int64).reshape(len(group), width)
        tree = Tree(group["id"].to_numpy(np.int64), x)
        return pd.DataFrame({"block": [".".join(map(str, key))], "n": [len(tree)], "centre": [tree.centre[0].tolist()],
                             "radius": [float(tree.radius[0])], "tree": [_pack(tree)]})

    return rows.groupBy(*block).applyInPandas(build, "block string, n long, centre array<double>, radius double, tree binary")


def _dealt(rows: DataFrame, pivots: np.ndarray, size: int) -> DataFrame:
    """``rows`` (id, x) plus pivot and chunk: blocks of about ``size`` rows near one pivot."""
    norms = (pivots ** 2).sum(1) if len(pivots) else None

    def nearest(batches):
        for batch in batches:
            x = batch.column("x").to_pylist()
            d = pivots.shape[1]
            y = np.array([np.pad(np.asarray(v[:d], float), (0, max(0, d - len(v)))) for v in x]).reshape(len(x), d)
            at = np.argmin(norms - 2 * y @ pivots.T, axis=1).astype(np.int32) if len(x) else np.array([], np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at)], names=[*batch.schema.names, "pivot"])

    near = written(rows.mapInArrow(nearest, "id long, x array<long>, pivot int"), "pivots")
    sizes = near.groupBy("pivot").count()               # a row for each pivot
    chunks = F.ceil(F.col("count") / F.lit(size))
    return near.join(F.broadcast(sizes), "pivot").select(
        "id", "x", "pivot", F.pmod(F.xxhash64("id"), chunks).alias("chunk"))


def _ended(x: Column) -> Column:
    """``x`` without the zeros at its end, which change no product."""
    zeros = F.array_position(F.transform(F.reverse(x), lambda v: v != 0), F.lit(True)) - 1      # -1: nothing else
    return F.slice(x, F.lit(1), F.when(zeros >= 0, F.size(x) - zeros.cast("int")).otherwise(0))


def _bound() -> Column:
    """The most that an inner product of two blocks can be."""
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: F.coalesce(x * y, F.lit(0.0))), F.lit(0.0), lambda s, x: s + x)
    norm = lambda a: F.sqrt(dot(a, a))
    q, r = F.col("q.centre"), F.col("r.centre")
    return (dot(q, r) + F.col("q.radius") * norm(r) + F.col("r.radius") * norm(q) + F.col("q.radius") * F.col("r.radius"))


def _search(pairs: DataFrame, queries: DataFrame, trees: DataFrame, tops: DataFrame | None, k: int) -> DataFrame:
    """Scores of the pairs (q, r) of blocks: query_id, vec_id, score; k of a query and task at most."""
    where = pairs.withColumn("together", F.floor(F.col("no") / F.lit(TOGETHER)))
    # new names on one side: both come from the same pairs
    left = where.select(F.col("r").alias("tree_r"), F.col("together").alias("with_r")).distinct().join(trees.select(F.col("block").alias("tree_r"), "tree"), "tree_r")
    right = where.join(queries.select(F.col("block").alias("q"), F.col("tree").alias("asked")), "q")
    if tops is not None:
        right = right.join(tops, "q", "left")
    else:
        right = right.withColumn("tops", F.lit(None).cast("array<struct<query_id:bigint,vec_id:bigint,score:bigint>>"))

    def meet(cands: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        out = []
        for packed in cands["tree"]:
            r = pickle.loads(packed)
            for asked, known in zip(asks["asked"], asks["tops"]):
                q = pickle.loads(asked)
                best = Best(len(q), k)
                seeds: dict[int, list] = {}
                for t in known if known is not None else ():
                    seeds.setdefault(t["query_id"], []).append((t["score"], t["vec_id"]))
                for row, i in enumerate(q.ids):
                    if found := seeds.get(i):
                        best.offer(row, np.array([s for s, _ in found]), np.array([v for _, v in found]))
                dual(q, r, best)
                for row, m in enumerate(best.size):
                    out += [(q.ids[row], best.id[row, c], best.score[row, c]) for c in range(m)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    return (left.groupBy("tree_r", "with_r").cogroup(right.select("r", "together", "asked", "tops").groupBy("r", "together"))
            .applyInPandas(meet, "query_id long, vec_id long, score long"))


def _top(scores: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scores.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def topk(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
         scale: float = 256.0, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS, pivots: int | None = None) -> DataFrame:
    """Each query's ``k`` best other rows: query_id, rank, vec_id, score.

    Components become floor(scale * x); the score is the integer inner product (exact as
    long as it fits a long), ties go to the smaller id. Queries are the rows where
    ``is_query`` holds; ids name rows, and a row is no candidate for its own id. Rows
    with a null id, a null vector or null or non-finite components take no part. Of
    vectors of different lengths the shorter one counts as ended by zeros. Rows repeated
    with one id and vector count once. With fewer than ``k`` candidates all are returned;
    without rows, none. ``pivots`` rows, chosen by a hash, only decide which
    rows share a block: every row is searched whatever they are. Unless given there is one
    for each block's worth of rows, from PIVOTS to MOST_PIVOTS, so that blocks stay small and
    their rows near each other as the data grow.
    """
    x = F.col("x")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vec_col}`").cast("array<double>").alias("x"),
                          is_query.alias("asks")).where(F.col("id").isNotNull() & x.isNotNull()).where(~bad)
    rows = rows.withColumn("x", _ended(F.transform(x, lambda v: F.floor(v * F.lit(scale)))))
    # repeats go before there are trees: in one they would take several of a query's k places
    rows = written(rows.groupBy("id", "x").agg(F.max("asks").alias("asks")), "rows")
    n = rows.count()
    if pivots is None:
        pivots = min(MOST_PIVOTS, max(PIVOTS, n // block_rows))
    some = drawn(rows, ["id", "x"], 2 * pivots, n)[:pivots]
    width = max((len(r.x) for r in some), default=0)
    centres = np.array([np.pad(np.asarray(r.x, float), (0, width - len(r.x))) for r in some]).reshape(len(some), width)
    empty = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not some:
        return empty
    trees = written(_forest(_dealt(rows.select("id", "x"), centres, block_rows), ["pivot", "chunk"]), "trees")
    queries = written(_forest(_dealt(rows.where("asks").select("id", "x"), centres, query_rows), ["pivot", "chunk"]), "queries")
    number = written(queries.select("block").withColumn(
        "no", F.row_number().over(Window.orderBy("block")) - 1), "numbers")     # a row for each query block
    asked = number.count()
    if not asked:
        return empty
    # every query block meets every candidate block's root: the query set against all rows, in blocks
    roots = trees.select(F.col("block").alias("r"), F.struct("centre", "radius").alias("rr"),
                         F.explode(F.sequence(F.lit(0), F.lit(asked - 1))).alias("no"))
    asks = queries.join(number, "block").select(F.col("block").alias("q"), "no", F.struct("centre", "radius").alias("qq"))
    bound = (roots.join(asks, "no").select("no", F.col("q").alias("q_"), F.col("r").alias("r_"), F.col("qq").alias("q"), F.col("rr").alias("r"))
             .withColumn("bound", _bound()).select(F.col("q_").alias("q"), F.col("r_").alias("r"), "no", "bound"))
    pairs = written(bound.withColumn("turn", F.row_number().over(
        Window.partitionBy("q").orderBy(F.desc("bound"), "r"))), "pairs")
    first = written(_top(_search(pairs.where("turn = 1"), queries, trees, None, k), k), "first")
    ids = queries.select(F.col("block").alias("q"), "n")
    owner = written(_owners(queries), "owners")
    tops = first.join(owner, "query_id").groupBy("q").agg(
        F.collect_list(F.struct("query_id", "vec_id", "score")).alias("tops"),
        F.min(F.when(F.col("rank") == k, F.col("score"))).alias("worst"),
        F.sum((F.col("rank") == k).cast("int")).alias("full"))
    known = ids.join(tops, "q", "left")
    rest = pairs.where("turn > 1").join(known.select("q", "worst", "full", "n"), "q").where(
        (F.col("full") < F.col("n")) | F.col("full").isNull() | (F.col("bound") + F.abs(F.col("bound")) * 1e-6 + 1e-6 >= F.col("worst")))
    more = _search(rest.select("q", "r", "no"), queries, trees, tops.select("q", "tops"), k)
    return _top(first.select("query_id", "vec_id", "score").unionByName(more), k).select("query_id", "rank", "vec_id", "score")


def _owners(queries: DataFrame) -> DataFrame:
    """query_id and its block."""

    def read(batches):
        for batch in batches:
            for block, packed in zip(batch.column("block").to_pylist(), batch.column("tree").to_pylist()):
                ids = pickle.loads(packed).ids
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array([block] * len(ids))], names=["query_id", "q"])

    return queries.select("block", "tree").mapInArrow(read, "query_id long, q string")
