"""Near-duplicates by an LSH forest of MinHash signatures (operator 9).

Each distinct set of word shingles gets TREES signatures of DEPTH hashes, and with each
signature a place in one of TREES sorted orders. Rows whose signatures share a prefix lie
together; a region of BASE shared hashes that is larger than REGION rows is taken at a
greater depth, which differs from region to region. Longest-common-prefix neighbours
whose sketches agree are candidates, and chains of candidates make families. Links are
confirmed on full sets, within families:

* a family of up to FAMILY sets is compared whole, in one task;
* a larger one is walked in several sorted orders, chunk by chunk; then every set that is
  not in the family's largest component is compared with all others, in blocks.

So a link is lost only if its two sets meet in no order: (1 - s^BASE)^TREES for sets of
similarity s, about 1 in 90,000 at 0.85 and less above, unless a third set joins them.
A region that is crowded at a tree's full depth is ordered by the next tree's hashes; what
is alike in both trees is cut by node number, and tasks cut regions: the chance leaves these
out. For lower limits ``trees`` can be more: at 0.8 it is 1 in 5,500 with 12 and 1 in 97,000
with 16.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import discard, kept_rows, slices, text_bytes, written
from tessera.llm.graph import components

SHINGLE, TREES, DEPTH, BASE = 5, 12, 6, 3
#: Trees that signatures can have at most.
MOST_TREES = 16
#: Rows of a region that are compared with each other by sketch, and the share of hashes that must agree.
REGION, AGREE = 256, 0.6
#: Sets of a family that one task compares, orders in which a larger one is walked, and sets of one batch of families.
FAMILY, ORDERS, BATCH = 512, 4, 2048

_random = np.random.default_rng(9)
_MUL = _random.integers(0, 2 ** 63, TREES * DEPTH, np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _random.integers(0, 2 ** 63, TREES * DEPTH, np.uint64)
# the first TREES trees are the same however many follow
_MUL = np.r_[_MUL, _random.integers(0, 2 ** 63, (MOST_TREES - TREES) * DEPTH, np.uint64) * np.uint64(2) + np.uint64(1)]
_ADD = np.r_[_ADD, _random.integers(0, 2 ** 63, (MOST_TREES - TREES) * DEPTH, np.uint64)]
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of a text's distinct ``k``-word shingles.

    Words are runs without ASCII white space, A-Z lower-cased. Fewer than ``k`` words are
    one shingle; null, empty and blank texts have none.
    """
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(len(words) - k + 1, 1)
    total = np.full(n, min(len(words), k), np.uint64)
    for i in range(min(k, len(words))):
        total = _mixed(total * np.uint64(0x9E3779B97F4A7C15) + hashes[i:i + n])
    return np.unique(total)


def signature(found: np.ndarray, trees: int = TREES) -> np.ndarray:
    """``trees`` * DEPTH 32-bit minima of a set's hashes."""
    mul, add = _MUL[:trees * DEPTH, None], _ADD[:trees * DEPTH, None]
    least = np.full(len(mul), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 1 << 14):        # bounded memory for very long texts
        least = np.minimum(least, (found[None, at:at + (1 << 14)] * mul + add).min(1))
    return (least >> np.uint64(32)).astype(">u4")


def _signed(rows: DataFrame, k: int, trees: int = TREES) -> DataFrame:
    """id, row, tag, n, whole (digest of the set), sig, sketch for rows (id, row, tag, text)."""

    def run(batches):
        for batch in batches:
            for a, b in slices(batch, text_bytes(batch, "text")):
                part = batch.slice(a, b - a)
                sets = [shingles(t, k) for t in part.column("text").to_pylist()]
                sigs = [signature(s, trees) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([
                    part.column("id"), part.column("row"), part.column("tag"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([None if s is None else s.tobytes() for s in sigs], pa.binary()),
                    pa.array([None if s is None else (s & 255).astype(np.uint8).tobytes() for s in sigs], pa.binary())],
                    names=["id", "row", "tag", "n", "whole", "sig", "sketch"])

    return rows.mapInArrow(run, "id long, row long, tag long, n long, whole binary, sig binary, sketch binary")


class Sets:
    """Union-find by arrays: the least position of each one's component."""

    @staticmethod
    def labels(linked: np.ndarray) -> np.ndarray:
        """Components of a symmetric matrix of links, as the least position in each."""
        n = len(linked)
        label = np.arange(n)
        near = linked | np.eye(n, dtype=bool)
        while True:
            new = np.where(near, label[None, :], n).min(1)
            new = np.minimum(new, new[new])
            if (new == label).all():
                return label
            label = new


def _region_edges(nodes: np.ndarray, keys: np.ndarray, sketches: np.ndarray, depth: int = BASE) -> Iterator[tuple[int, int]]:
    """Candidate edges of rows in sorted order that share ``depth`` hashes: spanning stars only."""
    if len(nodes) <= REGION:
        agree = np.zeros((len(nodes), len(nodes)), np.int16)
        for c in range(sketches.shape[1]):
            agree += sketches[:, c, None] == sketches[None, :, c]
        label = Sets.labels(agree >= AGREE * sketches.shape[1])
        yield from ((int(nodes[i]), int(nodes[j])) for i, j in enumerate(label) if i != j)
        return
    if depth < keys.shape[1]:       # a crowded region: one hash deeper
        starts = np.flatnonzero(np.r_[True, keys[1:, depth] != keys[:-1, depth]])
    else:
        starts = np.arange(0, len(nodes), REGION)
    for a, b in zip(starts, np.r_[starts[1:], len(nodes)]):
        if b - a > 1:
            yield from _region_edges(nodes[a:b], keys[a:b], sketches[a:b], depth + 1)
    for some in np.array_split(starts, -(-len(starts) // REGION)):     # neighbours across the cuts
        yield from _region_edges(nodes[some], keys[some], sketches[some], depth + 1)
    for a in starts[1:]:
        if (sketches[a] == sketches[a - 1]).mean() >= AGREE:
            yield int(nodes[a]), int(nodes[a - 1])


def _candidates(classes: DataFrame, trees: int = TREES) -> DataFrame:
    """Edges (a, b) between nodes of ``classes`` (node, sig, sketch): LCP neighbours in each order."""
    wide = DEPTH * 4
    rows = classes.select("node", "sig", "sketch", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    # after a tree's own hashes come those of the next one: where many rows share the first, the others order them
    key = F.expr(f"concat(substring(sig, tree * {wide} + 1, {wide}), substring(sig, (tree + 1) % {trees} * {wide} + 1, {wide}))")
    rows = rows.select(F.col("tree").cast("byte").alias("tree"), key.alias("key"), "node", "sketch")
    # dealt by the whole place in the order: a crowded region spreads over as many tasks as it needs
    order = rows.repartitionByRange("tree", "key", "node").sortWithinPartitions("tree", "key", "node")
    most = 16 * REGION

    def run(batches):
        held = None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            now = (np.asarray(batch.column("tree")), np.frombuffer(b"".join(batch.column("key").to_pylist()), ">u4").reshape(n, 2 * DEPTH),
                   np.asarray(batch.column("node")), np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint8).reshape(n, -1))
            held, edges = _walk(now if held is None else tuple(np.concatenate(x) for x in zip(held, now)), most, False)
            if edges:
                yield _edge_batch(edges)
        if held is not None and (edges := _walk(held, most, True)[1]):
            yield _edge_batch(edges)

    return order.mapInArrow(run, "a long, b long")


def _edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*edges)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _walk(rows: tuple, most: int, last: bool) -> tuple[tuple | None, list[tuple[int, int]]]:
    """(rows still held, edges) of whole regions. The last one is held back until it has ended; once it has more
    than ``most`` rows it is cut where a deeper region of it begins, which is held back whole."""
    tree, key, node, sketch = rows
    n, at, stop = len(node), len(node), len(node)
    new = np.r_[True, (tree[1:] != tree[:-1]) | (key[1:, :BASE] != key[:-1, :BASE]).any(1)]
    if not last:
        at = stop = np.flatnonzero(new)[-1]
        for depth in range(BASE, key.shape[1]):
            if n - at <= most:
                break
            deeper = np.flatnonzero(key[at + 1:, depth] != key[at:-1, depth]) + at + 1
            at = stop = deeper[-1] if len(deeper) else at
        if n - at > most:
            at, stop = n - 1, n             # alike in everything: goes on from its last row
    starts = np.flatnonzero(new[:stop])
    edges: list[tuple[int, int]] = []
    for a, b in zip(starts, np.r_[starts[1:], stop]):
        if b - a > 1:
            edges += _region_edges(node[a:b], key[a:b], sketch[a:b])
    return (None if last else tuple(x[at:] for x in rows)), edges


def shared(sets: list[np.ndarray], others: list[np.ndarray] | None = None) -> np.ndarray:
    """Sizes of the intersections of sets of hashes, exactly; with ``others``, of the ones with the others."""
    every = sets + (others or [])
    owner = np.repeat(np.arange(len(every)), [len(s) for s in every])
    _, at, times = np.unique(np.concatenate(every) if every else np.empty(0, np.uint64), return_inverse=True, return_counts=True)
    often = times[at] > 1                   # a hash in one set only is in no intersection
    column = np.cumsum(times > 1) - 1
    owner, at = owner[often], column[at[often]]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    n, m = len(sets), len(others) if others is not None else len(sets)
    out = np.zeros((n, m), np.float32)
    width = max(1, (8 << 20) // (4 * max(len(every), 1)))
    for c in range(0, int(at[-1]) + 1 if len(at) else 0, width):
        a, b = np.searchsorted(at, [c, c + width])
        part = np.zeros((len(every), width), np.float32)
        part[owner[a:b], at[a:b] - c] = 1
        out += part[:n] @ (part[n:] if others is not None else part).T
    return out.astype(np.int64)


def linked(sets: list[np.ndarray], percent: int, others: list[np.ndarray] | None = None) -> np.ndarray:
    """Which sets are at least ``percent`` similar (intersection over union)."""
    both = shared(sets, others)
    n = np.array([len(s) for s in sets])
    m = n if others is None else np.array([len(s) for s in others])
    return 100 * both >= percent * (n[:, None] + m[None, :] - both)


def _unpacked(column) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in column]


def _small_families(members: DataFrame, percent: int) -> DataFrame:
    """Final edges of families (family, node, set) that fit one task: from each set to the least node of its component."""
    # as many tasks as any shuffle has at least: comparing takes time, not bytes, so small ones must not be put together
    batches = max(-(-members.count() // BATCH), int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, own in group.drop_duplicates("node").sort_values("node").groupby("family"):
            nodes = own["node"].to_numpy()
            label = Sets.labels(linked(_unpacked(own["found"]), percent))
            out += [(nodes[i], nodes[j]) for i, j in enumerate(label) if i != j]
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    dealt = members.withColumn("batch", F.pmod(F.xxhash64("family"), F.lit(batches))).repartition(batches, "batch")
    return dealt.groupBy("batch").applyInPandas(compare, "a long, b long")


def _walked(members: DataFrame, percent: int) -> DataFrame:
    """Edges of large families (family, node, found, sig), chunk by chunk in ORDERS sorted orders."""
    wide = DEPTH * 4
    rows = members.select("family", "node", "found", "sig", F.explode(F.sequence(F.lit(0), F.lit(ORDERS - 1))).alias("tree"))
    rows = rows.select("family", "tree", F.expr(f"substring(sig, tree * {wide} + 1, {wide})").alias("key"), "node", "found")
    order = rows.repartitionByRange("family", "tree", "key", "node").sortWithinPartitions("family", "tree", "key", "node")
    half = REGION // 2

    def run(batches):
        held: list[tuple] = []

        def compare(rows):
            label = Sets.labels(linked(_unpacked(r[3] for r in rows), percent))
            return [(rows[i][2], rows[j][2]) for i, j in enumerate(label) if i != j]

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("family", "tree", "node", "found"))):
                if held and (row[:2] != held[-1][:2] or len(held) == REGION):
                    if len(held) > 1 and (edges := compare(held)):
                        yield _edge_batch(edges)
                    held = held[-half:] if row[:2] == held[-1][:2] else []      # chunks overlap by half
                if not held or row[2] != held[-1][2]:
                    held.append(row)
        if len(held) > 1 and (edges := compare(held)):
            yield _edge_batch(edges)

    return order.mapInArrow(run, "a long, b long")


def _rest(own: DataFrame, percent: int) -> DataFrame:
    """Edges between the components (family, node, found, label) of large families: from every set that isn't
    in its family's largest component to all others of the family. Their ends are labels."""
    sizes = own.groupBy("family", "label").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("family").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.sum("n").alias("all"),
                                       F.max("n").alias("most"))
    main = main.select("family", "main", F.ceil(F.col("all") / F.lit(FAMILY)).alias("blocks"),
                       F.ceil((F.col("all") - F.col("most")) / F.lit(FAMILY)).alias("parts")).where("parts > 0")
    rows = own.join(main, "family")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block")
    part = F.pmod(F.xxhash64("node", F.lit("part")), F.col("parts")).alias("part")
    every = rows.select(F.col("family").alias("f"), block, F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
                        F.col("label").alias("of"), F.col("found").alias("its"))
    few = rows.where("label <> main").select("family", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block_"),
                                             part.alias("part_"), "label", "found")

    def compare(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        x, y = a["of"].to_numpy(), b["label"].to_numpy()
        if not len(x) or not len(y):
            return pd.DataFrame({"a": [], "b": []}).astype("int64")
        i, j = np.nonzero(linked(_unpacked(a["its"]), percent, _unpacked(b["found"])))
        # of what one set is linked with in a block, its components are enough
        edges = pd.DataFrame({"a": x[i], "b": y[j]}).astype("int64")
        return _spanning(edges[edges["a"] != edges["b"]])

    return every.groupBy("f", "block", "part").cogroup(few.groupBy("family", "block_", "part_")).applyInPandas(compare, "a long, b long")


def _spanning(edges: pd.DataFrame) -> pd.DataFrame:
    """A star for each component of ``edges``."""
    nodes, at = np.unique(edges[["a", "b"]].to_numpy().ravel(), return_inverse=True)
    a, b = at.reshape(-1, 2).T
    label = np.arange(len(nodes))
    while len(a):
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = np.minimum(new, new[new])
        if (new == label).all():
            break
        label = new
    out = label != np.arange(len(nodes))
    return pd.DataFrame({"a": nodes[out], "b": nodes[label[out]]}).astype("int64")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85, k: int = SHINGLE,
                    trees: int = TREES) -> DataFrame:
    """Decide every row: _id, _tag, n_shingles, component_id and kept.

    Rows are linked when 100 * intersection >= ``percent`` * union of their sets of
    shingles (see ``shingles``); component_id is the smallest id that links reach, the
    row's own included. Rows without shingles are linked with nothing and are each their
    own component. A null id never names a component: where all ids are null
    component_id is null. One row of each component is kept, the one with the smallest
    id (of rows repeated with one id, one; nulls last). _tag is a hash of the text, which
    tells rows of one id apart. An empty table gives no rows; other columns are not read.
    ``trees``, at most MOST_TREES, settles how rarely a link is missed (see above).
    """
    if not ORDERS <= trees <= MOST_TREES:
        raise ValueError(f"trees must be from {ORDERS} to {MOST_TREES}")
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.monotonically_increasing_id().alias("row"),
                       F.xxhash64(text).alias("tag"), text.alias("text"))
    signed = written(_signed(rows, k, trees), "signed")
    # copies count once from here on
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row", "tag", "sig", "sketch"))
    classes = written(signed.where("n > 0").groupBy("whole").agg(first.alias("f")).select(
        "whole", F.col("f.row").alias("node"), "f.id", "f.tag", "f.sig", "f.sketch"), "classes")
    family = written(components(_candidates(classes.select("node", "sig", "sketch"), trees), "families"), "family")
    sizes = family.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    wanted = classes.select("node", "id", "tag", "sig").join(
        family.join(sizes, "label").select("node", F.col("label").alias("family"), "size"), "node")
    texts = rows.select(F.col("id").alias("id_"), F.col("tag").alias("tag_"), "text")
    met = wanted.join(texts, F.col("id").eqNullSafe(F.col("id_")) & (F.col("tag") == F.col("tag_")))

    def sets(batches):
        for batch in batches:
            for a, b in slices(batch, text_bytes(batch, "text")):
                part = batch.slice(a, b - a)
                found = [shingles(t, k).tobytes() for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("family", "size", "node", "sig")), pa.array(found, pa.binary())],
                                                 names=["family", "size", "node", "sig", "found"])

    members = met.select("family", "size", "node", "sig", "text").mapInArrow(
        sets, "family long, size long, node long, sig binary, found binary")
    members = written(members, "members")
    links = written(_small_families(members.where(F.col("size") <= FAMILY).select("family", "node", "found"), percent), "links")
    # a family is whole in its task, so these are components already
    label = links.select(F.col("a").alias("node"), F.col("b").alias("label"))
    large = members.where(F.col("size") > FAMILY)
    if not large.isEmpty():
        large = written(large.dropDuplicates(["node"]), "large")
        walked = written(_walked(large, percent), "walked")
        own = written(large.join(components(walked, "walked-components"), "node", "left").select(
            "family", "node", "found", F.coalesce("label", "node").alias("label")), "large-families")
        joined = components(_rest(own, percent), "rest").select(F.col("node").alias("label"), F.col("label").alias("least"))
        label = label.unionAll(own.select("node", "label").join(joined, "label", "left").select("node", F.coalesce("least", "label")))
    of = classes.select("whole", "node", "id").join(label, "node", "left").select(
        "whole", "node", "id", F.coalesce("label", "node").alias("label"))
    of = written(of, "labels")
    discard(classes, family, members)
    least = of.groupBy("label").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", F.col("node").alias("row"))).alias("f"))
    of = of.join(least, "label").select("whole", F.col("f.id").alias("component_id"), F.col("f.row").alias("keep_row"))
    some = signed.where("n > 0").select("id", "row", "tag", "n", "whole").join(of, "whole").select(
        F.col("id").alias("_id"), F.col("tag").alias("_tag"), F.col("n").alias("n_shingles"), "component_id",
        (F.col("row") == F.col("keep_row")).alias("kept"))
    none = signed.where("n = 0").select(F.col("id").alias("_id"), F.col("tag").alias("_tag"), F.col("n").alias("n_shingles"),
                                        F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    return some.unionByName(none)


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85,
                        trees: int = TREES) -> DataFrame:
    """The rows of ``docs`` that are kept, one of each component, with the columns of ``docs``."""
    keep = near_duplicates(docs, id_col, text_col, percent, trees=trees).where("kept").select("_id", "_tag")
    return kept_rows(docs, keep.distinct(), id_col, F.xxhash64(F.col(f"`{text_col}`")))
