"""Sources and sinks (S1-S19): round trips and edge rows."""

import json
import os
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import scratch_path
from tessera.sources import (DocumentTable, backup, count_csv, count_jsonl, output_path, read_csv, read_jsonl,
                             storage_info, write_csv, write_jsonl, write_sink)
from tests.conftest import rows


def items(spark):
    return spark.createDataFrame(
        [("Ann", 30, ["a", "b"], True, "r1"), ("Bob, \"Jr\"", 25, [], False, "r1"),
         ("Cé\nline", None, None, True, "r2")],
        "name string, age int, tags array<string>, active boolean, run_id string")


def test_csv_roundtrip_and_cells(spark):
    path = write_csv(items(spark), scratch_path(spark, "t_csv"))
    back = read_csv(spark, path)
    assert back.columns == ["active", "age", "name", "run_id", "tags"]      # sorted union
    got = {r["name"]: r for r in rows(back)}
    assert got["Bob, \"Jr\""]["tags"] == "[]" and got["Ann"]["tags"] == '["a", "b"]'
    assert got["Ann"]["active"] == "True" and got["Cé\nline"]["age"] == ""
    assert count_csv(spark, path) == 3
    text = "".join(open(os.path.join(at, f)).read() for at, _, files in os.walk(path) for f in files if f.endswith(".csv"))
    assert '"Bob, ""Jr"""' in text


def test_csv_revive_json(spark):
    path = write_csv(items(spark), scratch_path(spark, "t_csv2"))
    back = read_csv(spark, path, revive_json=True)
    r = {x["name"]: x for x in back.select(F.variant_get("name", "$", "string").alias("name"),
                                          F.try_variant_get("tags", "$", "array<string>").alias("tags")).collect()}
    assert r["Ann"]["tags"] == ["a", "b"]


def test_jsonl_roundtrip_nulls_and_bad_lines(spark):
    path = write_jsonl(items(spark), scratch_path(spark, "t_jsonl"))
    with open(os.path.join(path, "extra.json"), "w") as fh:
        fh.write("\n{broken\n\n")
    raw = [json.loads(line) for f in os.listdir(path) if f.endswith(".json")
           for line in open(os.path.join(path, f)) if line.strip() and not line.startswith("{broken")]
    assert any("age" in r and r["age"] is None for r in raw)          # explicit nulls kept
    back = read_jsonl(spark, path, items(spark).schema)
    assert back.count() == 3
    assert count_jsonl(spark, path) == 4                              # malformed counted, blank not


def test_jsonl_ascii(spark):
    df = spark.createDataFrame([(1, "Crème 😀")], "id int, t string")
    path = write_jsonl(df, scratch_path(spark, "t_ascii"), ensure_ascii=True)
    line = spark.read.text(path).first()[0]
    assert line == json.dumps({"id": 1, "t": "Crème 😀"}, separators=(",", ":"))
    assert rows(read_jsonl(spark, path, df.schema))[0]["t"] == "Crème 😀"


def test_document_table(spark):
    path = scratch_path(spark, "t_table")
    t = DocumentTable(spark, path)
    t.save(items(spark), target_name="people")
    t.save(items(spark).limit(1).withColumn("name", F.lit("Zed")), target_name="people")
    assert t.count() == 4
    ids = [r["_id"] for r in t.load(items(spark).schema).collect()]
    assert len(set(ids)) == 4                                        # unique across writes
    newest = rows(t.load(items(spark).schema, limit=1))[0]
    assert newest["name"] == "Zed" and newest["target_name"] == "people"
    assert t.load(items(spark).schema, target_name="people").count() == 4
    assert t.load(items(spark).schema, target_name="nobody").count() == 0
    t.clear()
    assert t.count() == 0


def test_backup_and_sink_factory(spark):
    df = items(spark)
    p = backup(df, scratch_path(spark, "t_bak") + ".jsonl")
    assert read_jsonl(spark, p, df.schema).count() == 3
    try:
        backup(df, "/tmp/x.xml")
        raise AssertionError("expected failure")
    except ValueError:
        pass
    try:
        write_sink(df, "sqlite3", "/tmp/none")
        raise AssertionError("expected failure")
    except ValueError:
        pass


def test_storage_info_and_naming(spark):
    path = write_csv(items(spark), scratch_path(spark, "t_info"))
    r = rows(storage_info(spark, path))[0]
    assert r["exists"] and r["files"] >= 1 and r["size_bytes"] > 0
    assert rows(storage_info(spark, path + "_missing"))[0]["exists"] is False
    import datetime as dt
    assert output_path("out", "processed", "csv", dt.datetime(2024, 1, 2, 3, 4, 5)) == "out/processed_20240102_030405.csv"


def test_clear_table_info_pages(spark):
    from tessera.sources import clear, read_pages, split_fetched, table_info
    df = items(spark)
    p = write_csv(df, scratch_path(spark, "t_clear"))
    clear(spark, p, "csv", df.schema)
    assert read_csv(spark, p).count() == 0
    assert rows(table_info(df, "items"))[0] == {"table": "items", "columns": "name,age,tags,active,run_id",
                                                "row_count": 3}
    pg = spark.createDataFrame([(1, "u", "<p>x</p>"), (2, "v", None)], "page_id long, url string, html string")
    good, bad = split_fetched(pg)
    assert good.count() == 1 and bad.count() == 1


def test_csv_dialect_options(spark):
    df = spark.createDataFrame([("a;b", 1), ('say "hi"', 2)], "t string, n int")
    path = write_csv(df, scratch_path(spark, "t_dialect"), delimiter=";", quote_all=False)
    text = "".join(open(os.path.join(path, f)).read() for f in sorted(os.listdir(path)) if f.endswith(".csv"))
    assert text.splitlines()[0] == "n;t"
    assert '"a;b"' in text and '"say ""hi"""' in text and "1;" in text      # minimal quoting
    back = read_csv(spark, path, delimiter=";")
    assert sorted(r["t"] for r in back.collect()) == ["a;b", 'say "hi"']
    # appended files of other columns are read by their own header
    more = spark.createDataFrame([("extra", 3, "x")], "a string, n int, t string")
    write_csv(more, path, delimiter=";", quote_all=False, mode="append")
    write_csv(df, path, delimiter=";", quote_all=False, mode="append")
    back = read_csv(spark, path, delimiter=";").collect()
    assert sorted((r["n"], r["t"], r["a"] or "") for r in back) == [
        ("1", "a;b", ""), ("1", "a;b", ""), ("2", 'say "hi"', ""), ("2", 'say "hi"', ""), ("3", "x", "extra")]
    with open(os.path.join(path, "foreign.csv"), "w") as fh:
        fh.write("t;n\nz;9\n")
    with pytest.raises(Exception):                  # never a silent shift
        read_csv(spark, path, delimiter=";").collect()


def test_csv_line_breaks_and_numbers(spark):
    df = spark.createDataFrame([("a\nb", 12345678.0, 1.5e-5), ("c", 1e16, -0.0)], "t string, x double, y double")
    path = write_csv(df, scratch_path(spark, "t_lines"))
    back = read_csv(spark, path, multiline=True).collect()
    assert sorted((r["t"], r["x"], r["y"]) for r in back) == [("a\nb", "12345678.0", "1.5e-05"), ("c", "1e+16", "-0.0")]
    assert count_csv(spark, path, multiline=True) == 2


def test_table_keeps_ids_drops_bad_json_and_filters_hot_columns(spark):
    path = scratch_path(spark, "t_ids")
    hot = T.StructType([T.StructField("age", T.IntegerType())])
    t = DocumentTable(spark, path, hot)
    df = spark.createDataFrame([(77, "Ann", 3), (78, "Bo", 4)], "id long, name string, age int")
    t.save(df, target_name="p", batch_key="first")
    t.save(df, target_name="p", batch_key="first")
    bad = t.table().where("hot_age = 3").withColumn("data", F.lit('{"id": 1, "name"'))
    t.restore(bad)
    assert sorted((r["id"], r["name"]) for r in t.load(df.schema).collect()) == [(77, "Ann"), (78, "Bo")]
    assert t.count() == 3
    some = t.load(df.schema, where={"age": 4})
    assert [r["id"] for r in some.collect()] == [78]
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(hot_age,4\)", some._jdf.queryExecution().executedPlan().toString())


def test_jsonl_rejects(spark):
    from tessera.sources.jsonl import read_jsonl_with_rejects
    path = write_jsonl(items(spark), scratch_path(spark, "t_rej"))
    with open(os.path.join(path, "extra.json"), "w") as fh:
        fh.write('{broken\n\n{"name": "Zed", "age": 1}\n')
    good, bad = read_jsonl_with_rejects(spark, path, items(spark).schema)
    assert good.count() == 4 and bad.count() == 1


@pytest.mark.parametrize("quote_all", [True, False])
def test_csv_cells_with_line_breaks(spark, tmp_path, quote_all):
    """What is written by default reads back; batches without breaks stay splittable."""
    from tessera.sources.csv import csv_folders
    path = str(tmp_path / "c")
    odd = [("a\nb", 1), ("c", 2), ('q"\r\n"z,', 3), ("\r", 4), (" tail\n", 5), ("  ", 6)]
    write_csv(spark.createDataFrame([("x", 0)], "s string, n int"), path, quote_all=quote_all)
    write_csv(spark.createDataFrame(odd, "s string, n int").coalesce(1), path, mode="append", quote_all=quote_all)
    write_csv(spark.createDataFrame([(" y ", 7)], "s string, n int"), path, mode="append", quote_all=quote_all)
    got = {(r.s, r.n) for r in read_csv(spark, path).collect()}
    assert got == {(s, str(n)) for s, n in [("x", 0), *odd, (" y ", 7)]}
    assert count_csv(spark, path) == 8
    assert [lines for _, lines in csv_folders(spark, path)] == [False, True]
    write_csv(spark.createDataFrame([("z", 7)], "s string, n int"), path)
    assert [(r.s, r.n) for r in read_csv(spark, path).collect()] == [("z", "7")]
    write_csv(spark.createDataFrame(odd, "s string, n int"), path)
    write_csv(read_csv(spark, path).unionAll(spark.createDataFrame([("8", "new")], "n string, s string")), path)       # onto itself
    assert count_csv(spark, path) == 7
    write_csv(read_csv(spark, path).where("s <> 'new'"), path)
    assert count_csv(spark, path) == 6 and [lines for _, lines in csv_folders(spark, path)] == [True]


def test_half_written_batches_are_not_seen(spark, tmp_path):
    from tessera.sources.batches import BatchStore
    store = BatchStore(spark, str(tmp_path / "s"))
    a, b = spark.range(3), spark.range(10, 12).withColumn("x", F.lit("y"))

    def fails(_):
        raise IOError("between two writes")

    with pytest.raises(IOError):
        store.commit("k", {"first": a, "second": fails})
    with pytest.raises(FileNotFoundError):
        store.read("first")
    n = lambda done: done["first"].agg(F.count(F.lit(1)).alias("n"))
    assert store.commit("k", {"first": a, "counted": n}) and not store.commit("k", {"first": a.unionAll(a), "counted": n})
    assert store.commit("l/2", {"first": b, "counted": n})
    assert sorted((r.id, r.x) for r in store.read("first").collect()) == [(0, None), (1, None), (2, None), (10, "y"), (11, "y")]
    assert sorted(r.n for r in store.read("counted").collect()) == [2, 3] and store.rows("first") == 5
    assert store.read("counted", "l/2").first().n == 2
    assert not store.manifests.add("k", {}) and [m["key"] for m in store.manifests.all()] == ["k", "l/2"]


def test_table_opens_the_newest_batches_and_skips_pages(spark, tmp_path):
    hot = T.StructType([T.StructField("n", T.LongType()), T.StructField("s", T.StringType())])
    t = DocumentTable(spark, str(tmp_path / "t"), hot)
    for k in range(4):
        t.save(spark.range(k * 10, k * 10 + 10).select(F.col("id").alias("n"), F.lit(f"b{k}").alias("s")), target_name="p", batch_key=f"k{k}")
    t.save(spark.range(0).select(F.col("id").alias("n"), F.lit("none").alias("s")), target_name="p", batch_key="empty")
    schema = T.StructType(hot.fields)
    newest = t.load(schema, limit=12)
    assert all("batch=k3" in f or "batch=k2" in f or "empty" in f for f in newest.inputFiles())
    assert sorted(r.n for r in newest.collect())[-10:] == list(range(30, 40)) and newest.count() == 12
    assert t.load(schema).count() == 40 and DocumentTable(spark, str(tmp_path / "none")).load(schema).count() == 0
    # a value is looked for in few pages of a large file
    big = DocumentTable(spark, str(tmp_path / "big"), hot)
    big.save(spark.range(200_000).select((F.col("id") * 7919 % 200_003).alias("n"), F.lit("x").alias("s")).coalesce(1), target_name="p")
    one = big.table().where("hot_n = 15838").select("seq")
    assert "PushedFilters: [IsNotNull(hot_n), EqualTo(hot_n,15838)]" in one._jdf.queryExecution().toString()
    one.collect()

    def scans(plan):
        found = [plan] if "Scan" in plan.nodeName() else []
        if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            return scans(plan.executedPlan())
        kids = plan.children()
        return found + [s for i in range(kids.size()) for s in scans(kids.apply(i))]

    df = big.table().where("hot_n = 15838").select("seq")
    q = df._jdf.queryExecution().executedPlan()
    rows = q.executeCollect()
    read = sum(s.metrics().apply("numOutputRows").value() for s in scans(q))
    assert len(rows) == 1 and read < 100_000


def test_rows_come_back_as_they_were(spark, tmp_path):
    t, u = DocumentTable(spark, str(tmp_path / "t")), DocumentTable(spark, str(tmp_path / "u"))
    t.save(spark.createDataFrame([(1, "a"), (2, None)], "n int, target_name string"), run_id="r")
    u.restore(t.table(), "copy")
    u.restore(t.table(), "copy")
    drop = lambda d: sorted((r.data, r.run_id, r.target_name, r.created_at) for r in d.table().collect())
    assert drop(t) == drop(u) and u.count() == 2
