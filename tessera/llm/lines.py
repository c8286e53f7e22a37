"""Line dedup by content-defined chunks of lines (operator 6).

A text's lines are hashed, and a rolling hash over the last WINDOW line hashes chooses
where a chunk ends. Boundaries depend on the lines nearby alone, so a passage that stands
elsewhere, after other lines, is cut at the same lines again. Chunks of several lines that
occur more than once in all documents are compared byte by byte and removed, but for the
first occurrence.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import discard, release, slices, text_bytes, written

#: Lines that the rolling hash sees, and the chance of a boundary after a line is one in MEAN.
WINDOW, MEAN, LEAST_LINES = 2, 3, 2

_MUL = np.uint64(0x9E3779B97F4A7C15)


def line_hash(line: bytes) -> int:
    return xxhash.xxh3_64_intdigest(line.strip())


def boundaries(hashes: np.ndarray, window: int = WINDOW, mean: int = MEAN) -> list[int]:
    """Numbers of lines before each chunk's end; the last one is the number of lines.

    A chunk ends after a line if the hash of the ``window`` line hashes up to it leaves no
    remainder by ``mean``. The first window - 1 lines of a text end none.
    """
    n = len(hashes)
    if n < window:
        return [n] if n else []
    rolled = np.zeros(n - window + 1, np.uint64)
    for i in range(window):
        rolled = (rolled ^ (rolled >> np.uint64(29))) * _MUL + hashes[i:i + n - window + 1]
    rolled = (rolled ^ (rolled >> np.uint64(32))) * _MUL
    ends = (np.flatnonzero((rolled >> np.uint64(33)) % np.uint64(mean) == 0) + window).tolist()
    return ends if ends and ends[-1] == n else [*ends, n]


def chunks(text: str | None, window: int = WINDOW, mean: int = MEAN) -> list[tuple[int, str]]:
    """(lines, text) of each chunk; joined by line feeds they are the text. An empty or null text has none."""
    if not text:
        return []
    lines = text.split("\n")
    hashes = np.fromiter((line_hash(x.encode()) for x in lines), np.uint64, len(lines))
    ends = boundaries(hashes, window, mean)
    return [(b - a, "\n".join(lines[a:b])) for a, b in zip([0, *ends], ends)]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, tag (a hash of the text) and text."""
    text = F.col(f"`{text_col}`")
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(text).alias("tag"), text.alias("text"))


def digested(docs: DataFrame, window: int, mean: int, digest: Callable[[str], bytes]) -> DataFrame:
    """id, tag, row and the (lines, digest) of every chunk, for documents (id, tag, text)."""

    def run(batches):
        for batch in batches:
            for a, b in slices(batch, text_bytes(batch, "text")):
                part = batch.slice(a, b - a)
                found = [[{"lines": n, "digest": digest(c)} for n, c in chunks(t, window, mean)] for t in part.column("text").to_pylist()]
                kind = pa.list_(pa.struct([("lines", pa.int32()), ("digest", pa.binary())]))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("id", "tag", "row")), pa.array(found, kind)],
                                                 names=["id", "tag", "row", "found"])

    return docs.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        run, "id long, tag long, row long, found array<struct<lines:int,digest:binary>>")


def _pieces(rows: DataFrame, window: int, mean: int) -> DataFrame:
    """id, tag, chunk and piece of the chunks that rows (id, tag, text, wanted) name."""

    def run(batches):
        for batch in batches:
            for a, b in slices(batch, text_bytes(batch, "text")):
                part = batch.slice(a, b - a)
                out = []
                for i, g, t, wanted in zip(*(part.column(c).to_pylist() for c in ("id", "tag", "text", "wanted"))):
                    found = chunks(t, window, mean)
                    out += [(i, g, k, found[k][1]) for k in wanted]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.string()))],
                                                     names=["id", "tag", "chunk", "piece"])

    return rows.mapInArrow(run, "id long, tag long, chunk int, piece string")


def _same(a: str, b: str) -> Column:
    return F.col(f"{a}.id").eqNullSafe(F.col(f"{b}.id")) & (F.col(f"{a}.tag") == F.col(f"{b}.tag"))


def digest128(piece: str) -> bytes:
    return xxhash.xxh3_128_digest(piece)


def repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, mean: int = MEAN,
                    least_lines: int = LEAST_LINES, digest: Callable[[str], bytes] = digest128) -> DataFrame:
    """id, tag, copy, chunk and lines of the chunks to remove.

    A chunk of at least ``least_lines`` lines goes if the same bytes occur before it: in
    a document with a smaller id (null ids last; of one id, an earlier row) or earlier in
    its own. Chunks whose digests agree with the first one's but whose bytes differ stay.
    ``tag`` is a hash of the text and ``copy`` numbers rows that have id and text in
    common. Null and empty texts have no chunks. Other columns are not read.
    """
    rows = _keyed(docs, id_col, text_col)
    signed = written(digested(rows, window, mean, digest), "digests")
    numbered = signed.withColumn("copy", F.row_number().over(Window.partitionBy("id", "tag").orderBy("row")))
    every = numbered.select("id", "tag", "copy", "row", F.posexplode("found").alias("chunk", "c")).select(
        "id", "tag", "copy", "row", "chunk", "c.lines", "c.digest").where(F.col("lines") >= least_lines)
    # one row for each digest leaves a task, however often it occurs; written, so that the join has it and the
    # chunks straight from their shuffles and a hot digest can be split
    again = written(every.groupBy("digest").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct(
        F.col("id").isNull().alias("none"), "id", "row", "chunk")).alias("first")).where("times > 1"), "again")
    met = written(every.join(again, "digest").select("id", "tag", "copy", "chunk", "lines", "digest", (
        (F.col("row") == F.col("first.row")) & (F.col("chunk") == F.col("first.chunk"))).alias("first")), "repeated")
    wanted = met.groupBy("id", "tag").agg(F.collect_set("chunk").alias("wanted"))
    # merge joins of texts with lists at any size: a list small enough to broadcast here isn't so elsewhere
    texts = wanted.alias("w").hint("merge").join(rows.alias("t"), _same("w", "t")).select("w.id", "w.tag", "t.text", "w.wanted")
    # only chunks that occur again carry their bytes to the comparison
    found = written(_pieces(texts, window, mean).dropDuplicates(["id", "tag", "chunk"]), "pieces")
    release(docs.sparkSession)
    whole = met.alias("m").join(found.alias("p"), _same("m", "p") & (F.col("m.chunk") == F.col("p.chunk"))).select("m.*", "p.piece")
    first = whole.where("first").select("digest", F.col("piece").alias("same"))
    gone = whole.where("NOT first").join(first, "digest").where(F.col("piece") == F.col("same"))
    gone = written(gone.select("id", "tag", "copy", "chunk", "lines"), "removed")
    discard(signed, again, met, found)
    return gone


def drop_repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, mean: int = MEAN,
                         least_lines: int = LEAST_LINES, digest: Callable[[str], bytes] = digest128) -> DataFrame:
    """_id, text (what stays, chunks joined by line feeds), n_chunks, n_removed and lines_removed for every row of ``docs``.

    See ``repeated_chunks`` for what goes. Null and empty texts come back as empty text
    without chunks.
    """
    gone = repeated_chunks(docs, id_col, text_col, window, mean, least_lines, digest)
    # the same three columns number the copies and join them, so that texts are shuffled once
    key = [F.coalesce("id", F.lit(0)).alias("key"), F.col("id").isNull().alias("none"), "tag"]
    names = ["key", "none", "tag"]
    lists = gone.groupBy(*key).agg(F.collect_list(F.struct("copy", "chunk", "lines")).alias("gone"))
    rows = _keyed(docs, id_col, text_col).select("id", *key, "text").withColumn(
        "copy", F.row_number().over(Window.partitionBy(*names).orderBy(F.lit(1))))
    own = F.filter("gone", lambda g: g["copy"] == F.col("copy"))
    met = rows.join(lists.hint("merge"), names, "left").withColumn("own", own).select(
        "id", "text", F.transform("own", lambda g: g["chunk"]).alias("gone"),
        F.coalesce(F.aggregate("own", F.lit(0).cast("long"), lambda n, g: n + g["lines"]), F.lit(0)).cast("long").alias("lines"))

    def run(batches):
        for batch in batches:
            for a, b in slices(batch, text_bytes(batch, "text")):
                part = batch.slice(a, b - a)
                texts, n, dropped = [], [], []
                for t, g in zip(part.column("text").to_pylist(), part.column("gone").to_pylist()):
                    found, out = chunks(t, window, mean), set(g or ())
                    texts.append("\n".join(c for k, (_, c) in enumerate(found) if k not in out))
                    n.append(len(found))
                    dropped.append(len(out))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(texts, pa.string()), pa.array(n, pa.int64()), pa.array(dropped, pa.int64()),
                                                  part.column("lines")], names=["_id", "text", "n_chunks", "n_removed", "lines_removed"])

    return met.mapInArrow(run, "_id long, text string, n_chunks long, n_removed long, lines_removed long")
