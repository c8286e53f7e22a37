"""Removal of long repeats by a logarithmic family of suffix arrays (operator 1).

The arrays are sparse. Of every ``length`` bytes in a row, the place where their least
GRAM-byte hash begins is sampled (the leftmost of equal ones); since that depends on the
bytes alone, two equal strings of ``length`` bytes are sampled at the same places. An
entry of an array is a sampled suffix: a fingerprint of its first GRAM bytes, by which the
array is sorted, a fingerprint of all that a repeat through this place could cover, the
document and the place.

Each batch of documents becomes an array of its own, is merge-joined with every array of
the family (all are bucketed and sorted alike, so none is shuffled again), and joins the
family as a run of rank 0. Two runs of one rank are merged to one of the next, so n
batches leave about log n runs. Suffixes that agree in their first bytes are then compared
byte by byte in both directions: they are sorted as suffixes and as reversed prefixes, and
the longest common extensions of neighbours tell which strings through the place occur
more than once. Suffixes whose surroundings agree in a second 64-bit fingerprint as well count
as equal without that look.
"""

from __future__ import annotations

import functools
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import bucket_count, discard, make_folder, release, remove, slices, text_bytes, written
from tessera.session import scratch_path

#: Bytes by which sampled suffixes are matched; a repeat must be longer.
GRAM = 48
#: Bytes of text sampled at a time, places compared in one task, and those of one fingerprint
#: from which a group counts as crowded; there, so many neighbouring strings are first judged by
#: the bytes that all of them have.
PART, TOGETHER, CROWDED, BLOCK = 1 << 20, 20_000, 65_536, 16

_random = np.random.default_rng(48)
_TABLE = _random.integers(0, 2 ** 64, 256, np.uint64, endpoint=False)
_ODD = _random.integers(0, 2 ** 63, 8, np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = np.uint64(24)


def _grams(data: np.ndarray) -> np.ndarray:
    """Hashes of all strings of GRAM bytes, by doubling."""
    x, have, parts, at = _TABLE[data], 1, GRAM, 0
    total, done = None, 0
    while True:
        if parts & have:                    # this power of two is part of GRAM
            if total is None:
                total = x
            else:
                n = min(len(total), len(x) - done)
                total = total[:n] * _ODD[7] + x[done:done + n]
            done += have
        if have * 2 > parts:
            break
        x = x[:-have] * _ODD[at] + x[have:]
        have, at = have * 2, at + 1
    total = (total ^ (total >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return total ^ (total >> np.uint64(29))


def places(data: bytes, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, fingerprints) sampled from texts that lie end to end and stop at ``ends``."""
    b = np.frombuffer(data, np.uint8)
    starts = np.r_[0, ends[:-1]]
    if len(b) < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h = _grams(b)
    # the place in the low bits settles ties to the left
    least = (h >> _PLACE << _PLACE) | np.arange(len(h), dtype=np.uint64)
    width, w = length - GRAM + 1, 1
    while 2 * w <= width:
        least = np.minimum(least[:-w], least[w:])
        w *= 2
    if width > w:
        least = np.minimum(least[:w - width], least[width - w:])
    inside = np.zeros(len(least) + 1, np.int32)         # strings that don't cross an end
    long = ends - starts >= length
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, (ends - length + 1)[long], -1)
    least = least[np.cumsum(inside)[:-1] > 0]
    at = (least & np.uint64((1 << 24) - 1)).astype(np.int64)
    at = at[np.r_[True, at[1:] != at[:-1]]] if len(at) else at
    return at, h[at]


def sampled(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and fingerprints of one text of any size, in parts that overlap."""
    found = []
    for a in range(0, max(len(text) - length, 0) + 1, PART):
        part = text[a:a + PART + length - 1]
        at, h = places(part, np.array([len(part)]), length)
        found.append((at + a, h))
    at, first = np.unique(np.concatenate([x for x, _ in found]), return_index=True)
    return at, np.concatenate([h for _, h in found])[first]


def _sampled_batch(texts: list[bytes], length: int):
    """(number of the text, place, fingerprint) of several texts."""
    k = 0
    while k < len(texts):
        if len(texts[k]) > PART:
            at, h = sampled(texts[k], length)
            yield np.full(len(at), k), at, h
            k += 1
            continue
        first, size = k, 0
        while k < len(texts) and size + len(texts[k]) <= PART:
            size += len(texts[k])
            k += 1
        ends = np.cumsum([len(t) for t in texts[first:k]])
        at, h = places(b"".join(texts[first:k]), ends, length)
        owner = np.searchsorted(ends, at, side="right")
        yield owner + first, at - np.r_[0, ends][owner], h


def _grouped(owner: np.ndarray, h: np.ndarray, c: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, list]:
    """(first of each group of places that agree in text, h and c, the others of its group or None)."""
    order = np.lexsort((at, c, h, owner))
    o, x, y = owner[order], h[order], c[order]
    new = np.flatnonzero(np.r_[True, (o[1:] != o[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])])
    end = np.r_[new[1:], len(order)]
    more: list = [None] * len(new)
    for k in np.flatnonzero(end - new > 1).tolist():
        more[k] = at[order[new[k] + 1:end[k]]]
    return order[new], more


def entries(docs: DataFrame, length: int) -> DataFrame:
    """h, c, id, tag, at, more of the sampled suffixes of docs (id, tag, text).

    Places of one text that agree in both fingerprints, as those of a line that it says
    again and again, are one entry: the first place and, in ``more``, the others.
    """
    reach = length - GRAM

    def run(batches):
        for batch in batches:
            for a, b in slices(batch, text_bytes(batch, "text")):
                part = batch.slice(a, b - a)
                texts = [(t or "").encode() for t in part.column("text").to_pylist()]
                for owner, at, h in _sampled_batch(texts, length):
                    # the seed tells apart equal bytes that lie otherwise around the place
                    c = np.array([xxhash.xxh3_64_intdigest(texts[o][max(p - reach, 0):p + length], min(p, reach))
                                  for o, p in zip(owner.tolist(), at.tolist())], np.uint64)
                    if not len(at):
                        continue
                    first, more = _grouped(owner, h, c, at)
                    whose = pa.array(owner[first])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(h[first].view(np.int64)), pa.array(c[first].view(np.int64)), part.column("id").take(whose),
                        part.column("tag").take(whose), pa.array(at[first]), pa.array(more, pa.list_(pa.int64()))],
                        names=["h", "c", "id", "tag", "at", "more"])

    return docs.mapInArrow(run, "h long, c long, id long, tag binary, at long, more array<long>")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, tag (``text_tag``, for rows of one id) and text."""
    text = F.col(f"`{text_col}`")
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_tag(text).alias("tag"), text.alias("text"))


def text_tag(text: Column) -> Column:
    """What tells texts of one id (or of none) apart: 128 bits, so that no two of any corpus agree by chance."""
    return F.unhex(F.md5(F.encode(text, "UTF-8")))


def times() -> Column:
    """Places of an entry."""
    return 1 + F.coalesce(F.size("more"), F.lit(0))


class SuffixFamily:
    """Sparse suffix arrays of all batches so far, in one table with a partition for each run.

    ``add(batch)`` gives the suffixes whose first bytes occur more than once, as far as
    the batch is concerned: its own and those of earlier batches that it meets. The table
    lies at ``path`` (any store that Spark writes). A batch whose adding failed can be
    added again once ``forget`` has dropped its unfinished run. ``buckets`` is the number
    of shuffle partitions where none is given; a family keeps the one that it began with.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, length: int = 200, buckets: int | None = None):
        if length <= GRAM:
            raise ValueError(f"repeats must be longer than {GRAM} bytes")
        self.spark, self.length, self.buckets = spark, length, bucket_count(spark, buckets)
        self.path = path or scratch_path(spark, "suffix-family")
        self.table = "suffix_family_" + uuid.uuid4().hex
        make_folder(spark, self.path)
        spark.sql(f"CREATE TABLE {self.table} (h BIGINT, c BIGINT, id BIGINT, tag BINARY, at BIGINT, more ARRAY<BIGINT>, run STRING) USING parquet "
                  f"PARTITIONED BY (run) CLUSTERED BY (h) SORTED BY (h) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")
        spark.sql(f"MSCK REPAIR TABLE {self.table}")
        self.made = 0

    def runs(self) -> list[tuple[int, str]]:
        """(rank, run) of all runs, smallest rank first."""
        names = [r[0].partition("=")[2] for r in self.spark.sql(f"SHOW PARTITIONS {self.table}").collect()]
        return sorted((int(n.split("-")[0]), n) for n in names)

    def run(self, name: str) -> DataFrame:
        return self.spark.table(self.table).where(F.col("run") == name).drop("run")

    def _write(self, rows: DataFrame, rank: int) -> str:
        self.made += 1
        name = f"{rank}-{self.made}-{uuid.uuid4().hex[:8]}"
        rows.select("h", "c", "id", "tag", "at", "more", F.lit(name).alias("run")).write.insertInto(self.table)
        return name

    def forget(self, name: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS PARTITION (run = '{name}')")
        remove(self.spark, f"{self.path}/run={name}")

    def add(self, batch: DataFrame) -> DataFrame:
        """Add documents (id, tag, text); returns h, c, id, tag, at, more of suffixes that met another."""
        older = self.runs()
        new = entries(batch, self.length)
        name = self._write(new.repartition(self.buckets, "h").sortWithinPartitions("h"), 0)
        own = self.run(name)
        mine = own.groupBy("h").agg(F.sum(times()).alias("n"))
        again = mine.where("n > 1").select("h")
        met = own.join(again.hint("merge"), "h", "left_semi")
        for _, other in older:              # scan each run of the family side by side with the new one
            theirs = self.run(other)
            met = met.unionByName(own.join(again.hint("merge"), "h", "left_anti").join(theirs.select("h").hint("merge"), "h", "left_semi"))
            met = met.unionByName(theirs.join(mine.select("h").hint("merge"), "h", "left_semi"))
        met = written(met, "met")
        self._merge()
        return met

    def _merge(self) -> None:
        """Two runs of one rank become one of the next, bucket by bucket."""
        while True:
            by: dict[int, list[str]] = {}
            for rank, name in self.runs():
                by.setdefault(rank, []).append(name)
            two = next(((rank, names[:2]) for rank, names in sorted(by.items()) if len(names) > 1), None)
            if two is None:
                return
            rank, names = two
            auto = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
            before = self.spark.conf.get(auto)
            self.spark.conf.set(auto, "false")          # one task for each bucket, as nothing else asks for it here
            try:
                self._write(self.spark.table(self.table).where(F.col("run").isin(names)).sortWithinPartitions("h"), rank + 1)
            finally:
                self.spark.conf.set(auto, before)
            for name in names:
                self.forget(name)


def _sorted_extensions(group: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common) of rows sorted by group and bytes; common: bytes shared with the one before, -1 in another group."""
    wide = np.pad(data, ((0, 0), (0, -data.shape[1] % 8)))
    keys = np.ascontiguousarray(wide).view(">u8").astype(np.uint64)
    order = np.lexsort([*keys.T[::-1], group])
    rows, of = data[order], group[order]
    differ = rows[1:] != rows[:-1]
    common = np.where(differ.any(1), differ.argmax(1), data.shape[1])
    common[of[1:] != of[:-1]] = -1
    return order, np.r_[-1, common].astype(np.int64)


def repeats(group: np.ndarray, left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray, length: int) -> np.ndarray:
    """For each place, which strings of ``length`` bytes through it another place of its group has too.

    ``left`` holds the bytes before each place, nearest first, ``right`` those from it on;
    n_left and n_right say how many are real. Column o of the result stands for the string
    that begins o bytes before the place. Exact: only bytes are compared.
    """
    n, reach = left.shape
    by_left, same_left = _sorted_extensions(group, left)
    by_right, same_right = _sorted_extensions(group, right)
    out = np.zeros((n, reach + 1), bool)
    a, b = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(reach + 1):
        real = (n_left >= o) & (n_right >= length - o)
        if real.sum() < 2:
            continue
        a[by_left] = np.cumsum(same_left < o)           # classes with o equal bytes before the place
        b[by_right] = np.cumsum(same_right < length - o)
        key = (a * (n + 1) + b)[real]
        order = np.argsort(key, kind="stable")
        same = np.diff(key[order]) == 0
        twice = np.empty(len(key), bool)
        twice[order] = np.r_[False, same] | np.r_[same, False]
        out[real, o] = twice
    return out


def _spans(found: np.ndarray, length: int) -> list[list[tuple[int, int]]]:
    """Bytes, counted from the place, that the strings of each row of ``repeats`` cover."""
    edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    out: list[list[tuple[int, int]]] = [[] for _ in range(len(found))]
    rows, first = np.nonzero(edge == 1)
    last = np.nonzero(edge == -1)[1] - 1
    for r, a, b in zip(rows.tolist(), first.tolist(), last.tolist()):
        out[r].append((-b, length - a))
    return out


SPANS = "array<struct<start:bigint,end:bigint>>"


def _contexts(places_: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """h, c, n_left and the bytes around places (h, c, id, tag, at) of documents."""
    reach = length - GRAM
    per_doc = places_.groupBy("id", "tag").agg(F.collect_list(F.struct("h", "c", "at")).alias("places"))
    texts = docs.select(F.col("id").alias("id_"), F.col("tag").alias("tag_"), "text")
    met = per_doc.join(texts, F.col("id").eqNullSafe(F.col("id_")) & (F.col("tag") == F.col("tag_"))).select("places", "text")

    def run(batches):
        for batch in batches:
            for a, b in slices(batch, text_bytes(batch, "text")):
                part = batch.slice(a, b - a)
                rows = []
                for found, t in zip(part.column("places").to_pylist(), part.column("text").to_pylist()):
                    t = t.encode()
                    rows += [(p["h"], p["c"], min(p["at"], reach), t[max(p["at"] - reach, 0):p["at"] + length]) for p in found]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
                                                     names=["h", "c", "n_left", "bytes"])

    return met.mapInArrow(run, "h long, c long, n_left int, bytes binary")


def _compared(contexts: DataFrame, length: int) -> DataFrame:
    """h, c, spans of contexts in groups of moderate size, whole groups to a task."""
    reach = length - GRAM
    tasks = -(-contexts.count() // TOGETHER)

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates(["h", "c"])
        n = len(rows)
        left, right = np.zeros((n, reach), np.uint8), np.zeros((n, length), np.uint8)
        n_left = rows["n_left"].to_numpy(np.int64)
        n_right = np.array([len(x) for x in rows["bytes"]]) - n_left
        for i, (x, k) in enumerate(zip(rows["bytes"], n_left.tolist())):
            b = np.frombuffer(x, np.uint8)
            left[i, :k], right[i, :len(b) - k] = b[:k][::-1], b[k:]
        found = repeats(rows["h"].to_numpy(), left, right, n_left, n_right, length)
        return pd.DataFrame({"h": rows["h"], "c": rows["c"], "spans": [[{"start": a, "end": b} for a, b in s] for s in _spans(found, length)]})

    dealt = contexts.withColumn("task", F.pmod(F.xxhash64("h"), F.lit(max(tasks, 1))))
    return dealt.groupBy("task").applyInPandas(compare, f"h long, c long, spans {SPANS}")


def _counted(contexts: DataFrame, length: int) -> DataFrame:
    """The same for crowded groups: their strings are counted one by one, by 128-bit digests.

    Strings that begin within BLOCK bytes of each other have most of their bytes in
    common. A place where these occur nowhere else of its group has no repeat there, so
    only the blocks that others share are taken apart.
    """
    reach = length - GRAM

    def blocks(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                out = []
                part = batch.slice(start, 1024)
                for h, c, k, x in zip(*(part.column(i).to_pylist() for i in ("h", "c", "n_left", "bytes"))):
                    low, high = max(0, length - (len(x) - k)), min(reach, k)        # of strings that lie within
                    out += [(h, c, a, xxhash.xxh3_128_digest(x[k - a:k - min(a + BLOCK - 1, reach) + length]))
                            for a in range(0, reach + 1, BLOCK) if a <= high and a + BLOCK > low]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                                                     names=["h", "c", "block", "core"])

    def strings(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                out = []
                part = batch.slice(start, 256)
                for h, c, k, x, found in zip(*(part.column(i).to_pylist() for i in ("h", "c", "n_left", "bytes", "blocks"))):
                    low, high = max(0, length - (len(x) - k)), min(reach, k)
                    out += [(h, c, o, xxhash.xxh3_128_digest(x[k - o:k - o + length])) for a in found
                            for o in range(max(a, low), min(a + BLOCK - 1, high) + 1)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                                                     names=["h", "c", "o", "digest"])

    cores = written(contexts.mapInArrow(blocks, "h long, c long, block long, core binary"), "cores")
    core = ["h", "block", "core"]
    shared = cores.groupBy(*core).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*core)
    live = cores.join(shared, core).groupBy("h", "c").agg(F.collect_set("block").alias("blocks"))
    contexts = contexts.join(live, ["h", "c"])
    every = written(contexts.mapInArrow(strings, "h long, c long, o long, digest binary"), "strings")
    # at the same place in the string: one string seen from two places of a text is one occurrence
    same = ["h", "o", "digest"]
    twice = every.groupBy(*same).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*same)
    found = every.join(twice, same).groupBy("h", "c").agg(F.sort_array(F.collect_set("o")).alias("os"))

    def joined(batches):
        for batch in batches:
            out = []
            for os in batch.column("os").to_pylist():
                row = np.zeros((1, length - GRAM + 1), bool)
                row[0, os] = True
                out.append([{"start": a, "end": b} for a, b in _spans(row, length)[0]])
            yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("c"), pa.array(out, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                                             names=["h", "c", "spans"])

    return found.mapInArrow(joined, f"h long, c long, spans {SPANS}")


def find_repeats(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text", batches: int = 2,
                 crowded: int = CROWDED) -> DataFrame:
    """id, tag and spans (bytes from start to end) of documents with strings that repeat.

    A span is covered by strings of ``length`` bytes, each of which also starts at some
    other place of any document, the same one included. Null texts count as empty;
    documents shorter than ``length`` have no such strings; of rows repeated with one id
    and text each is a repeat of the other. The documents are added to the family in
    ``batches`` batches, dealt by a hash of the id.
    """
    spark, reach = docs.sparkSession, length - GRAM
    rows = keyed(docs, id_col, text_col)
    family = SuffixFamily(spark, length=length)
    parts = []
    for k in range(batches):
        parts.append(family.add(rows.where(F.pmod(F.xxhash64("id", F.lit("batch")), F.lit(batches)) == k)))
        release(spark)
    hits = functools.reduce(DataFrame.unionByName, parts)
    for _, name in family.runs():           # a family of this call alone; a lasting one would stay
        family.forget(name)
    spark.sql(f"DROP TABLE {family.table}")
    # a place that several batches met counts once; rows repeated with id and text are told by their number
    own = hits.groupBy("h", "c", "id", "tag", "at").agg(F.first("more").alias("more"))
    copies = rows.where(F.octet_length("text") >= length).groupBy("id", "tag").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    own = written(own.join(copies.select(F.col("id").alias("i"), F.col("tag").alias("t"), "rows"),
                           F.col("id").eqNullSafe(F.col("i")) & (F.col("tag") == F.col("t")), "left")
                  .select("h", "c", "id", "tag", "at", "more", (F.coalesce("rows", F.lit(1)) * times()).alias("n")), "hits")
    discard(*parts)
    kinds = written(own.groupBy("h", "c").agg(F.sum("n").alias("n"), F.min(F.struct(F.col("id").isNull(), "id", "tag", "at")).alias("one")), "contexts")
    sizes = kinds.groupBy("h").agg(F.count(F.lit(1)).alias("kinds"))
    contexts, kinds = kinds, written(kinds.join(sizes, "h"), "kinds")
    discard(contexts)
    sizes = kinds.select("h", "kinds").distinct()
    some = written(_contexts(kinds.where("kinds > 1").select("h", "c", "one.id", "one.tag", "one.at"), rows, length), "bytes")
    release(spark)
    # groups whose surroundings are all alike need no look at their bytes
    alike = F.array(F.struct(F.lit(-reach).cast("long").alias("start"), F.lit(length).cast("long").alias("end")))
    whole = kinds.where("n > 1").select("h", "c", alike.alias("spans"))
    many = sizes.where(F.col("kinds") > crowded).select("h")
    rest = _compared(some.join(many, "h", "left_anti"), length)
    if not many.isEmpty():
        rest = rest.unionByName(_counted(some.join(many, "h", "left_semi"), length))
    around = written(whole.unionByName(rest.where(F.size("spans") > 0)), "spans")
    discard(some, kinds)
    # spans of every place of an entry, counted from the text's begin
    places_ = F.concat(F.array("at"), F.coalesce("more", F.array().cast("array<bigint>")))
    moved = F.flatten(F.transform(places_, lambda p: F.transform("spans", lambda s: F.struct(
        F.greatest(p + s["start"], F.lit(0)).alias("start"), (p + s["end"]).alias("end")))))
    found = own.join(around, ["h", "c"]).select("id", "tag", moved.alias("spans"))
    result = written(found.groupBy("id", "tag").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans")), "repeats")
    discard(own, around)
    return result


def merged(spans: list[dict], n: int) -> list[tuple[int, int]]:
    """Sorted spans within ``n`` bytes, joined where they touch."""
    out: list[tuple[int, int]] = []
    for s in spans:
        a, b = s["start"], min(s["end"], n)
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text", characters: bool = False,
                   batches: int = 2, crowded: int = CROWDED) -> DataFrame:
    """_record (struct of all columns of ``docs``), _kept, _removed (array of start, end) and _bytes for every row.

    _kept is what is left of the text's bytes (binary) once the spans of ``find_repeats``
    are gone; every occurrence goes, the first one too. With ``characters`` a character
    that is only partly covered stays, so that _kept is UTF-8 again. Null texts give no
    bytes. An empty table gives no rows.
    """
    spans = find_repeats(docs, length, id_col, text_col, batches, crowded)
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_record"), F.col(f"`{id_col}`").cast("long").alias("_id"),
                       text_tag(text).alias("_tag"), text.alias("_text"))
    met = rows.join(spans, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_tag") == F.col("tag")), "left").select("_record", "_text", "spans")
    met = met.select(*[c for c in met.columns if c != "_record"], "_record")

    def run(batches_):
        for batch in batches_:
            for a, b in slices(batch, text_bytes(batch, "_text")):
                part = batch.slice(a, b - a)
                kept, removed, sizes = [], [], []
                for t, s in zip(part.column("_text").to_pylist(), part.column("spans").to_pylist()):
                    t = (t or "").encode()
                    gone = merged(s or [], len(t))
                    if characters:
                        gone = [(x, y) for x, y in (_whole(t, x, y) for x, y in gone) if x < y]
                    edges = [0, *(e for g in gone for e in g), len(t)]
                    kept.append(b"".join(t[x:y] for x, y in zip(edges[::2], edges[1::2])))
                    removed.append([{"start": x, "end": y} for x, y in gone])
                    sizes.append(len(t))
                yield pa.RecordBatch.from_arrays([
                    part.column("_record"), pa.array(kept, pa.binary()),
                    pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(sizes, pa.int64())],
                    names=["_record", "_kept", "_removed", "_bytes"])

    kind = docs.schema.simpleString()
    return met.mapInArrow(run, f"_record {kind}, _kept binary, _removed {SPANS}, _bytes long")


def _whole(t: bytes, a: int, b: int) -> tuple[int, int]:
    """The characters that lie wholly within bytes a to b."""
    while a < b and t[a] & 0xC0 == 0x80:
        a += 1
    while b > a and b < len(t) and t[b] & 0xC0 == 0x80:
        b -= 1
    return a, b
