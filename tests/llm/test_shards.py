from pyspark.sql import functions as F

from tessera.llm.shards import shard_by_size


def check(out, n, shards):
    assert len(out) == n
    at = {}
    for r in out:
        at.setdefault(r.shard, []).append(r)
    assert set(at) <= set(range(shards))
    for rows in at.values():
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
    return at


def balanced(at, total, shards, largest):
    sizes = [sum(r._size for r in at.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 2 * largest, sizes


def test_a_key_with_a_third_of_all_rows(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("k"),
                                  (F.col("id") % 50 + 1).alias("size"), F.lit(1).alias("_size"))
    out = shard_by_size(df, [F.col("k")], F.col("size"), 8, ranges=4).collect()
    at = check(out, 3000, 8)
    total = sum(r._size for r in out)
    groups = {}
    for r in out:
        groups.setdefault(r._record.k, []).append(r)
    sizes = {k: sum(r._size for r in g) for k, g in groups.items()}
    assert sizes[7] > total / 8 and len({r.shard for r in groups[7]}) > 1           # larger than a shard: subdivided
    assert all(len({r.shard for r in g}) == 1 for k, g in groups.items() if sizes[k] <= total / 8)
    balanced(at, total, 8, max(50, *(n for k, n in sizes.items() if n <= total / 8)))
    order = sorted(out, key=lambda r: (r.shard, r.slot))              # shards are stretches of key order
    assert [r._record.k for r in order] == sorted(r._record.k for r in out)


def test_rows_the_same_in_everything(spark):
    df = spark.range(2000).select(F.lit(1).alias("k"), F.lit(3).alias("size"))
    out = shard_by_size(df, [F.col("k")], F.col("size"), 5, ranges=4).collect()
    balanced(check(out, 2000, 5), 6000, 5, 3)


def test_nulls_strings_and_few_rows(spark):
    df = spark.createDataFrame([(None, None), ("b", 0), ("a", 4), ("é\"\\", -3), (None, 9)], "k string, size long")
    out = shard_by_size(df, [F.col("k")], F.col("size"), 3).collect()
    check(out, 5, 3)
    assert sorted(r._size for r in out) == [1, 1, 1, 4, 9]
    assert shard_by_size(df.limit(0), [F.col("k")], F.col("size"), 3).count() == 0
    assert len(check(shard_by_size(df.limit(1), [F.col("k")], F.col("size"), 40).collect(), 1, 40)) == 1


def test_query(spark):
    import zlib

    from tessera.llm.queries import QUERIES
    from tests.conftest import SF01
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    df = QUERIES["op7_sampled_splitters"](spark, SF01)
    out = df.collect()
    assert {r.doc_id for r in out} == set(texts) and len(out) == len(texts)
    assert all((r.size, r.text_crc32) == (len(texts[r.doc_id]) + 16, zlib.crc32(texts[r.doc_id])) for r in out)
    at = check(out, len(texts), 40)
    sizes = [sum(r.size for r in at[s]) for s in range(40)]
    groups = {}
    for r in out:
        groups.setdefault(texts[r.doc_id], []).append(r)
    of = {t: sum(r.size for r in g) for t, g in groups.items()}
    assert max(sizes) - min(sizes) <= 2 * max(of.values())
    assert all(len({r.shard for r in g}) == 1 for t, g in groups.items() if of[t] <= sum(sizes) / 40)
    assert not any(x in df._jdf.queryExecution().toString() for x in ("Python", "Arrow", "Pandas"))
