"""Filter interaction audit (operator 12).

Which filter removes a document depends on the order that the filters run in. A document is
read once: every filter that it fails becomes a bit. Copies are found by an existential
self-join: a row fails where a row of the same hash and the same text has a smaller id, a
left-semi join that stops at the first such row. The ids that it returns are put beside
those of the other failures and the bits of an id are combined; from then on there are only
counts for each part and combination of bits, from which any order follows.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import discard, written

#: White space between words, and signs that no clean text has.
SPACE, SIGNS = r"[\x20\x09-\x0D]+", "[#$%&*|]"
#: A text with more rows than this, and than one in so many of all rows, is spread: so there are at most 10,000 such.
HOT_ROWS, HOT_SHARE = 1000, 10_000


def conditions(text: Column) -> dict[str, Column]:
    """A: under 200 words; B: under half of them distinct; C: capitals are over 3% of the
    characters; D: one of the signs ``#$%&*|``."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    many, kinds = F.size(words), F.size(F.array_distinct(words))
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    return {"A": many < 200, "B": 100 * kinds < 50 * many, "C": 100 * capitals.cast("long") > 3 * F.length(text).cast("long"),
            "D": text.rlike(SIGNS)}


def _hash(text: Column) -> Column:
    return F.xxhash64(text)


def copies(docs: DataFrame, hash_of=_hash) -> DataFrame:
    """The rows of ``docs`` (id, text and any others) whose text a smaller id has too.

    Hashes with two ids or more are found from numbers alone; only their rows bring texts
    along. Texts with a great share of the rows (at most ``HOT_SHARE`` of them, so that
    their table can be broadcast) are dealt to several tasks by id, and the one row that
    stands for all smaller ids is given to each of these.
    """
    keyed = docs.where("id IS NOT NULL").withColumn("h", hash_of(F.col("text")))
    crowd = written(keyed.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least"), F.max("id").alias("most")), "hashes")
    total = crowd.agg(F.sum("n")).first()[0] or 0
    deal = max(HOT_ROWS, total // HOT_SHARE)
    hot = crowd.where(F.col("n") > deal).select("h", F.ceil(F.col("n") / F.lit(deal)).alias("ways"))
    ways = F.coalesce(F.col("ways"), F.lit(1))

    def dealt(df: DataFrame, each: Column) -> DataFrame:
        return df.join(F.broadcast(hot), "h", "left").withColumn("way", each).drop("ways")

    everywhere = F.explode(F.sequence(F.lit(0).cast("long"), ways - 1))
    one = F.pmod(F.xxhash64("id"), ways)
    shared = dealt(crowd.where("least < most").select("h"), everywhere)
    rows = written(dealt(keyed, one).join(shared, ["h", "way"], "left_semi"), "candidates")
    first = dealt(rows.groupBy("h", "text").agg(F.min("id").alias("first")), everywhere)
    a, b = rows.alias("a"), first.alias("b")
    same = (F.col("a.h") == F.col("b.h")) & (F.col("a.way") == F.col("b.way")) & (F.col("a.text") == F.col("b.text"))
    out = written(a.join(b.hint("merge"), same & (F.col("b.first") < F.col("a.id")), "left_semi").select(
        *[c for c in docs.columns if c != "text"]), "copies")
    discard(crowd, rows)
    return out


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
          tests: Mapping[str, Column] | None = None, copy_letter: str = "E", hash_of=_hash) -> DataFrame:
    """For each part, order of the filters and step: kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley (see the contract of the query).

    ``tests`` maps letters to conditions that a failing row meets, over a column named
    ``text`` (by default those of ``conditions``); ``copy_letter`` is the filter that rows
    fail whose text a smaller id has. Null texts are empty ones, null parts are the part "".
    A row with a null id is no one's copy and has no label. Rows repeated with one id are
    each counted, and none is a copy of another. A row is good or toxic if any label row of
    its id is. Without rows there are no parts, and no result. Other columns are never looked at.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text"),
                       F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"))
    tests = dict(tests or conditions(F.col("text")))
    letters = "".join(sorted([*tests, copy_letter]))
    bit = {c: 1 << i for i, c in enumerate(letters)}
    failed = sum((F.when(test, bit[c]).otherwise(0) for c, test in tests.items()), F.lit(0))
    key = ["id", "digest", "part"]                   # a SHA-256 stands for the text
    known = base.withColumn("digest", F.unhex(F.sha2(F.encode("text", "UTF-8"), 256)))
    rows = known.select(*key, failed.alias("bits")).groupBy(*key, "bits").agg(F.count(F.lit(1)).alias("n"))
    again = copies(known, hash_of).select(*key).distinct()
    each = (rows.unionByName(again.select(*key, F.lit(bit[copy_letter]).alias("bits"), F.lit(0).cast("long").alias("n")))
            .groupBy(*key).agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n")))
    # an id has few rows from here on, whatever it had before
    by_id = written(each.groupBy("id", "part", "bits").agg(F.sum("n").alias("n")), "bits")
    marks = labels.groupBy(F.col(f"`{id_col}`").cast("long").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("bad"))
    counts = written(by_id.join(marks, "id", "left").groupBy("part", "bits").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good") == 1, F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("bad") == 1, F.col("n")).otherwise(0)).alias("bad")), "counts")
    return orders(counts, letters)


def orders(counts: DataFrame, letters: str) -> DataFrame:
    """Every order and step over ``counts`` (part, bits, n, good, bad)."""
    every = ["".join(p) for p in permutations(letters)]
    at = F.col("step")
    bit = lambda k: F.expr(f"shiftleft(1, instr('{letters}', substr(filter_order, {k}, 1)) - 1)")
    earlier = sum((F.when(at > k, bit(k)).otherwise(0) for k in range(1, len(letters))), F.lit(0))
    steps = (counts.withColumn("filter_order", F.explode(F.lit(every)))
             .withColumn("step", F.explode(F.lit(list(range(1, len(letters) + 1)))))
             .withColumn("own", bit("step")).withColumn("earlier", earlier))
    fails = F.col("bits").bitwiseAND(F.col("own")) != 0
    reached = F.col("bits").bitwiseAND(F.col("earlier")) == 0
    total = lambda when, what="n": F.sum(F.when(when, F.col(what)).otherwise(0)).cast("long")
    # of the filters that a document fails each comes first in as many orders
    share = F.lit(len(every)) / F.bit_count("bits")
    return steps.groupBy("part", "filter_order", "step").agg(
        total(reached & ~fails).alias("kept"), total(reached & fails).alias("removed"), total(~reached & fails).alias("redundant"),
        total(F.col("bits") == F.col("own")).alias("unique_fails"), total(reached & fails, "good").alias("good_lost"),
        total(reached & fails, "bad").alias("toxic_lost"),
        F.sum(F.when(fails, F.col("n") * share.cast("long")).otherwise(0)).cast("long").alias("shapley"))
