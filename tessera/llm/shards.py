"""Sharding by sampled splitters (operator 7), DataFrame functions only.

A sample of keys, drawn in proportion to size, gives quantile splitters. Records go to
the key ranges between splitters; ranges that hold more than their share are given more
splitters of their own, drawn from within them, until none is overfull. Ranges are put
end to end; sums over the ranges (bounded in number) say where each begins, and a window
inside a range (bounded in size) says where each record lies. A shard is then an equal
stretch of bytes: its last range is cut where the stretch ends, or, if a group of equal
keys lies there that is no larger than a shard, before or after that group.
"""

from __future__ import annotations

import json
from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from tessera.llm.common import written

#: Ranges for each shard, rounds of subdivision, and how many times its share makes a range overfull.
RANGES, ROUNDS, OVERFULL = 32, 6, 4


def range_of(key: Column, splitters: list[tuple], kind: StructType) -> Column:
    """Number of splitters at or below ``key``: a binary search in a constant array."""
    if not splitters:
        return F.lit(0)
    steps = F.array(*[F.lit(1 << b) for b in range(ceil(log2(len(splitters) + 1)) - 1, -1, -1)])
    text = json.dumps([dict(zip(kind.names, s)) for s in splitters], default=str)
    given = F.from_json(F.lit(text), ArrayType(kind))
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        F.get(given, at + step - 1) <= key, at + step).otherwise(at))


def _order(values: tuple) -> tuple:
    """Spark's order of a key in Python: nulls first."""
    return tuple((v is not None, v) for v in values)


def shard_by_size(df: DataFrame, keys: list[Column], size: Column, shards: int, ranges: int = RANGES) -> DataFrame:
    """``df``'s rows in ``shards`` stretches of key order of nearly equal size.

    Returns _record (struct of all columns of ``df``, so no name clashes), _size, shard
    and slot (gapless from 0 in key order within a shard). ``keys`` are columns of
    numbers, strings, dates or booleans; nulls sort first. Rows whose first key is equal are
    a group and lie in one shard, that of the group's middle, unless they hold more bytes
    than a shard should: such a group (it may have a third of all rows) is subdivided like
    any other range, its rows told apart by the other keys and a row number. So a stretch
    is off by half a group's size at each end, and by half a record's where one is cut. A null size or one
    below 1 counts as 1. An empty table gives no rows; with fewer rows than shards some
    shards stay empty. Everything in ``df`` is written and shuffled once: pass ids and
    sizes rather than texts where that will do.
    """
    parts = [k.alias(f"k{i}") for i, k in enumerate(keys)]
    keyed = written(df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_record"),
        F.greatest(F.coalesce(size, F.lit(1)), F.lit(1)).cast("long").alias("_size"),
        F.struct(*parts, F.monotonically_increasing_id().alias("row")).alias("_key")), "sized")
    total = keyed.agg(F.sum("_size")).first()[0]
    if not total:
        return keyed.select("_record", "_size", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    share = total / (shards * ranges)
    kind = keyed.schema["_key"].dataType

    def drawn(rows: DataFrame, for_each_range: int) -> list[tuple]:
        """Every 4th of a sample of keys, which has about so many for a share of bytes.

        A key's chance is its size's; it is the same whenever a task is run again.
        """
        chance = (F.pmod(F.xxhash64("_key", F.lit("draw")), F.lit(1 << 30)) + 0.5) / float(1 << 30)
        hits = rows.where(chance < F.col("_size") * F.lit(for_each_range / share)).select("_key.*")
        return sorted(map(tuple, hits.collect()), key=_order)[3::4]

    def range_number(splitters: list[tuple]) -> Column:
        return range_of(F.col("_key"), splitters, kind)

    splitters = drawn(keyed, 4)
    for _ in range(ROUNDS):
        held = keyed.groupBy(range_number(splitters).alias("_range")).agg(
            F.sum("_size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
        over = [r[0] for r in held.where((F.col("bytes") > OVERFULL * share) & (F.col("rows") > 8)).collect()]
        more = set(drawn(keyed.where(range_number(splitters).isin(over)), 8)) - set(splitters) if over else ()
        if not more:
            break
        splitters = sorted([*splitters, *more], key=_order)

    ranged = keyed.withColumn("_range", range_number(splitters))
    # as many rows as there are ranges
    sums = ranged.groupBy("_range").agg(F.sum("_size").alias("b"), F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_range", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("b0"),
                         F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"))
    inside = Window.partitionBy("_range").orderBy("_key")
    upto = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = (ranged.select("_record", "_size", "_range", F.col("_key.k0").alias("_group"),
                            (F.row_number().over(inside) - 1).alias("i"),
                            F.coalesce(F.sum("_size").over(upto), F.lit(0)).alias("b"))
              .join(F.broadcast(starts), "_range"))

    def stretch(begin: Column, length: Column) -> Column:
        return F.least(F.lit(shards - 1), F.floor((begin * 2 + length) * shards / F.lit(2 * total))).cast("int")

    begin = F.col("b0") + F.col("b")
    placed = written(placed.select("_record", "_size", "_group", (F.col("n0") + F.col("i")).alias("at"), begin.alias("begin"),
                                   stretch(begin, F.col("_size")).alias("shard")), "placed")
    # a group lies across a cut: one for each cut at most
    torn = placed.groupBy("_group").agg(F.min("begin").alias("g0"), F.sum("_size").alias("gb"), F.min("shard").alias("lo"), F.max("shard").alias("hi"))
    torn = torn.where((F.col("lo") < F.col("hi")) & (F.col("gb") * shards <= F.lit(total))).select(
        F.col("_group").alias("_torn"), stretch(F.col("g0"), F.col("gb")).alias("whole"))
    placed = written(placed.join(F.broadcast(torn), F.col("_group").eqNullSafe(F.col("_torn")), "left").select(
        "_record", "_size", "at", F.coalesce("whole", "shard").alias("shard")), "whole-groups")
    first = placed.groupBy("shard").agg(F.min("at").alias("first"))       # one row per shard
    return placed.join(F.broadcast(first), "shard").select(
        "_record", "_size", "shard", (F.col("at") - F.col("first")).alias("slot"))
