"""Search (Q1-Q5), metrics (A1-A14), chunks, merge, flatten, redact."""

import random

from pyspark.sql import functions as F

import tessera.functions as tf
from tessera.operators import metrics
from tessera.operators.chunk import assign_chunks
from tessera.operators.flatten import flatten_json
from tessera.operators.search import apply_limit, filter_by_field, newest_first, search
from tests.conftest import rows


def store(spark):
    return spark.createDataFrame(
        [(11, "crane", 12.5, ["lift"], True, "w7", None), (12, "winch", 3.0, [], False, "w7", "sold"),
         (13, "hoist", 40.0, ["lift", "pull"], True, "w8", None), (14, "jack", 0.5, None, True, "w8", "")],
        "id long, machine string, tonnes double, uses array<string>, working boolean, week string, note string")


def test_search(spark):
    df = store(spark)
    assert [r["machine"] for r in rows(search(df, {"working": True, "week": "w7"}))] == ["crane"]
    assert sorted(r["id"] for r in rows(search(df, {"note": None}))) == [11, 13]        # explicit null only
    assert search(df, {"colour": "red"}).count() == 0               # a field that no row has
    assert filter_by_field(df, "working", True, limit=2).count() == 2
    assert apply_limit(df, 0).count() == 4                          # a falsy limit is none
    assert [r["id"] for r in rows(newest_first(df, "tonnes", "id", limit=2))] == [13, 11]


def test_chunks_split_hot_key(spark):
    # one key holds most rows; positions must still be consecutive and exact
    data = [(i, "hot" if i % 4 else f"k{i}", i) for i in range(200)]
    df = spark.createDataFrame(data, "id int, k string, ord int")
    out = assign_chunks(df, 7, ["ord"], ["k"], num_partitions=8)
    hot = sorted((r["ord"], r["chunk_id"], r["chunk_pos"]) for r in rows(out.filter("k = 'hot'")))
    assert [(c, p) for _, c, p in hot] == [(i // 7, i % 7) for i in range(len(hot))]
    try:
        assign_chunks(df, 0, ["ord"])
        raise AssertionError("expected failure")
    except ValueError:
        pass


def test_merge_maps(spark):
    df = spark.createDataFrame([({"a": "1", "b": "2"}, {"b": "3", "c": "4"})], "x map<string,string>, y map<string,string>")
    assert rows(df.select(tf.merge_maps("x", "y").alias("m")))[0]["m"] == {"a": "1", "b": "3", "c": "4"}


def test_flatten_paths_and_values(spark):
    text = '{"ship":{"crew":{"cook":true,"mate":null},"holds":[[],{"tons":12.5},["tea"]]},"log":{},"port":"Emden"}'
    out = [(r["path"], r["value"]) for r in rows(flatten_json(spark.createDataFrame([(1, text)], "id int, j string"), "j", ["id"]))]
    assert out == [("ship.crew.cook", "true"), ("ship.crew.mate", None), ("ship.holds.1.tons", "12.5"), ("ship.holds.2.0", "tea"), ("port", "Emden")]


def test_redact(spark):
    df = spark.createDataFrame([("u", "p", {"api_token": "t", "name": "n"}, ("s", "ok"))],
                               "user string, password string, extra map<string,string>, "
                               "nested struct<smtp_password:string, host:string>")
    r = rows(tf.redact(df))[0]
    assert r["user"] == "u" and r["password"] == "***REDACTED***"
    assert r["extra"] == {"api_token": "***REDACTED***", "name": "n"}
    assert r["nested"]["smtp_password"] == "***REDACTED***" and r["nested"]["host"] == "ok"


def log(spark):
    return spark.createDataFrame(
        [("t1", "ok", 0.05, 1, 10), ("t1", "ok", 3.0, 2, 5), ("t1", "failed", 120.0, 3, 0), ("t2", "ok", 0.7, 4, 2)],
        "target string, status string, seconds double, ts int, saved int")


def test_histogram(spark):
    r = {x["target"]: x for x in rows(metrics.duration_histogram(log(spark), ["target"], "seconds"))}
    assert r["t1"]["le_0_1"] == 1 and r["t1"]["le_5"] == 2 and r["t1"]["le_100"] == 2 and r["t1"]["le_inf"] == 3
    assert r["t1"]["duration_sum"] == 123.05 and r["t2"]["le_1"] == 1


def test_summary_counts_and_last(spark):
    ok = F.col("status") == "ok"
    s = rows(metrics.run_summary(log(spark), ok, F.col("saved"), "seconds"))[0]
    assert s == {"completed": 3, "failed": 1, "total_saved": 17, "total_duration": 3.75, "avg_duration": 1.25}
    empty = log(spark).limit(0)
    assert rows(metrics.run_summary(empty, ok, F.col("saved"), "seconds"))[0]["avg_duration"] == 0.0
    assert rows(metrics.job_counts(log(spark), ok))[0] == {"total_runs": 4, "successful_runs": 3, "failed_runs": 1}
    last = {x["target"]: x for x in rows(metrics.last_values(log(spark), ["target"], "ts", "status", ok))}
    assert last["t1"]["last_value"] == "failed" and last["t1"]["last_attempt"] == 3 and last["t1"]["last_success"] == 2
    c = {(x["target"], x["status"]): x["requests"] for x in rows(metrics.requests_by_status(log(spark), "target", "status"))}
    assert c == {("t1", "ok"): 2, ("t1", "failed"): 1, ("t2", "ok"): 1}


def test_checks_and_quality(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k int, v string")
    suite = {x["check_name"]: x for x in rows(metrics.check_suite(df, {
        "not_null": F.count_if(F.col("v").isNull()), "positive": F.count_if(F.col("k") <= 0)}))}
    assert suite["not_null"]["status"] == "unhealthy" and suite["positive"]["status"] == "healthy"
    assert suite["overall"]["status"] == "unhealthy"
    assert rows(metrics.quality_report(df))[0] == {"rows": 3, "null_cells": 1, "duplicate_rows": 1}
    assert rows(metrics.storage_health(lambda: df, spark, "t"))[0] == {"storage": "t", "status": "healthy", "row_count": 3, "error": None}
    gone = rows(metrics.storage_health(lambda: spark.read.parquet("/tmp/no such table"), spark, "t"))[0]
    assert gone["status"] == "unhealthy" and gone["row_count"] is None and gone["error"]


def test_flatten_struct(spark):
    from tessera.operators.flatten import flatten_struct
    df = spark.createDataFrame([(1, ((1,), [1, 2]))], "id int, a struct<b:struct<c:int>, x:array<int>>")
    out = flatten_struct(df)
    assert out.columns == ["id", "a.b.c", "a.x"]
    assert tuple(out.first()) == (1, 1, [1, 2])


def test_run_log(spark):
    from tessera.plans.runner import append_run_log, run_target
    from tessera.session import scratch_path
    from tests.test_extract import catalogue, spec
    path = scratch_path(spark, "run_log")
    done = run_target(catalogue(spark), spec(spark), run_id="r9", dry_run=True)[1]
    failed = run_target(catalogue(spark), {**spec(spark), "extract": {}}, run_id="r10")[1]
    append_run_log(spark, [done, failed], path)
    log = spark.read.parquet(path)
    ok = F.col("status") == "success"
    assert rows(metrics.job_counts(log, ok))[0] == {"total_runs": 2, "successful_runs": 1, "failed_runs": 1}
    assert rows(metrics.active_runs(log, F.lit(True), ok))[0] == {"active_runs": 1, "queue_size": 0}


def test_merge_versions_matches_recursive_merge(spark):
    import json
    from tessera.operators.merge import merge_versions

    def merge_dicts(*dicts):          # the documented semantics: recursive, later wins
        result = {}
        for d in dicts:
            for k, v in d.items():
                if k in result and isinstance(result[k], dict) and isinstance(v, dict):
                    result[k] = merge_dicts(result[k], v)
                else:
                    result[k] = v
        return result

    def flat(d, p=None):
        out = []                        # pairs: keys with dots may give one path twice
        for k, v in d.items():
            key = k if p is None else f"{p}.{k}"
            if isinstance(v, dict) and v:
                out += flat(v, key)
            else:
                out.append((key, v if v != {} else "{}"))
        return out

    versions = {
        1: [{"a": {"b": 1, "c": 2}, "x": [1, 2, 3], "s": "keep"},
            {"a": {"c": 3, "d": 4}, "x": [9]},
            {"a": 5},
            {"a": {"e": 6}, "t": True}],
        2: [{"k": {"deep": {"z": 1}}}, {"k": {"deep": {"y": 2}}, "k2": None}],
        3: [{"o": 5, "p": {}, "q": {"r": 1}}, {"o": {}, "p": {"z": 0}, "q": {}}],
        4: [{"a": {"b": 1}, "a.b": 2}, {"a": {"c": {}}}, {"a": {"c": 7}}],
    }
    rng = random.Random(3)

    def some(depth):
        kinds = [lambda: rng.randrange(9), lambda: {}, lambda: [1, {"a": None}], lambda: None]
        if depth < 4:
            kinds += [lambda: {rng.choice("ab.c"): some(depth + 1) for _ in range(rng.randrange(1, 4))}] * 5
        return rng.choice(kinds)()

    def document():
        d = some(0)
        return d if isinstance(d, dict) else document()

    for i in range(10, 90):
        versions[i] = [document() for _ in range(rng.randrange(1, 7))]
    versions[99] = [document() for _ in range(200)]         # an id with a great share of all versions
    rows_in = [(i, v, json.dumps(d)) for i, ds in versions.items() for v, d in enumerate(ds)]
    df = spark.createDataFrame(rows_in, "id int, ver int, doc string")
    got = {}
    for r in merge_versions(df, ["id"], "doc", "ver").collect():
        got.setdefault(r["id"], []).append((r["path"], r["value"]))
    for i, ds in versions.items():
        want = [(k, None if v is None else json.dumps(v, separators=(",", ":")) if isinstance(v, (list, bool)) else str(v))
                for k, v in flat(merge_dicts(*ds))]
        assert sorted(got.get(i, []), key=str) == sorted(want, key=str), i


def test_any_json_row_is_flattened_and_merged(spark):
    """Halves of surrogate pairs, numbers of any size, documents that are no objects."""
    from tessera.operators.merge import merge_versions
    docs = [(1, 0, r'{"k":"\ud800","\udfff":[2.50,"\ud83d\ude00"],"n":1e400,"m":-0}'), (1, 1, r'{"n":12345678901234567890123}'),
            (2, 0, '{"a":{"b":1}}'), (2, 1, "7"), (3, 0, "[1]"), (3, 1, '{"a":{}}'), (4, 0, '{"a":1}'), (4, 1, "{}"), (5, 0, "null"),
            (6, 0, '{"a":1}'), (6, 1, "3"), (6, 2, "{}"), (None, 0, '{"a":1}'), (None, 1, '{"b":2}'), (7, 0, "no json"), (8, 0, None)]
    df = spark.createDataFrame(docs, "id int, ver int, doc string")
    one = [(r.path, r.value) for r in flatten_json(df.limit(1), "doc", ["id"]).collect()]
    assert one == [("k", "\ufffd"), ("\ufffd.0", "2.50"), ("\ufffd.1", "\U0001f600"), ("n", "1e400"), ("m", "-0")]
    got = sorted(((r.id, r.path, r.value) for r in merge_versions(df, ["id"], "doc", "ver").collect()), key=str)
    assert got == sorted([(1, "k", "\ufffd"), (1, "\ufffd", '[2.50,"\U0001f600"]'), (1, "n", "12345678901234567890123"), (1, "m", "-0"), (2, "", "7"),
                          (3, "a", "{}"), (4, "a", "1"), (5, "", None), (None, "a", "1"), (None, "b", "2")], key=str)


def test_flatten_long_strings_and_deep_nesting(spark):
    import json
    deep = "[" * 200 + "1" + "]" * 200
    long = 'x\\"' * 300_000
    rows_in = [(1, json.dumps({"a": long})), (2, deep), (3, '{"a":' * 200 + "{}" + "}" * 200), (4, "not json"), (5, None),
               (6, '{"n": NaN}'), (7, "[" * 100_000), (8, '{"a.b": 1, "a": {"b": 2}}'), (9, '"root"'), (10, "1e3")]
    out = rows(flatten_json(spark.createDataFrame(rows_in, "id int, j string"), "j", ["id"]))
    by = {}
    for r in out:
        by.setdefault(r["id"], []).append((r["path"], r["value"]))
    assert by[1] == [("a", long)]
    assert by[2] == [(".".join(["0"] * 200), "1")]
    assert set(by) == {1, 2, 8, 9, 10}
    assert by[8] == [("a.b", "1"), ("a.b", "2")] and by[9] == [("", "root")] and by[10] == [("", "1e3")]
    cut = rows(flatten_json(spark.createDataFrame([(1, '{"a":{"b":[1,{"c":null}]}}')], "id int, j string"), "j", ["id"], max_depth=2))
    assert [(r["path"], r["value"]) for r in cut] == [("a.b", '[1,{"c":null}]')]


def test_search_json_absent_vs_null(spark):
    from tessera.operators.search import search_json
    df = spark.createDataFrame([('{"a": 1, "b": null}',), ('{"a": 1}',), ('{"a": 2, "b": "x"}',)], "j string") \
        .select(F.parse_json("j").alias("v"))
    assert search_json(df, "v", {"b": None}).count() == 1          # explicit null only, absent key excluded
    assert search_json(df, "v", {"a": 1}).count() == 2
    assert search_json(df, "v", {"a": 2, "b": "x"}).count() == 1
    assert search_json(df, "v", {"zzz": 1}).count() == 0


def test_convert_variant_mode(spark):
    from tessera.operators.transform import convert_types
    df = spark.createDataFrame([("42",), ("not_a_number",)], "n string")
    out = convert_types(df, {"n": "int"}, keep_raw="variant").select(
        F.schema_of_variant("n").alias("t"), F.to_json("n").alias("j")).collect()
    assert [(r["t"], r["j"]) for r in out] == [("BIGINT", "42"), ("STRING", '"not_a_number"')]


def test_check_suite_error_status(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    suite = {x["check_name"]: x["status"] for x in rows(metrics.check_suite(df, {
        "ok": F.count_if(F.col("k") < 0), "broken": F.count_if(F.col("missing_column") > 0)}))}
    assert suite == {"ok": "healthy", "broken": "error", "overall": "unhealthy"}


def test_gauges_over_time(spark):
    data = [(i % 50, [1, -1, 1][i % 3]) for i in range(400)] + [(None, 7), (3, None)]
    log = spark.createDataFrame(data, "t int, d int").repartition(6)
    course = metrics.gauge_course(log, "t", {"up": F.col("d"), "down": -F.col("d")})
    want, total = {}, 0
    for t in range(50):
        total += sum(d for x, d in data if x == t and d is not None)
        want[t] = total
    assert {r.t: (r.up, r.down) for r in course.collect()} == {t: (v, -v) for t, v in want.items()}
    peaks = {r.gauge: (r.peak, r.peak_at, r.last_value) for r in metrics.gauge_peaks(course, "t").collect()}
    top = max(want.values())
    assert peaks["up"] == (top, min(t for t, v in want.items() if v == top), want[49])
    assert metrics.gauge_course(log.limit(0), "t", {"up": F.col("d")}).count() == 0


def test_redacted_json_text():
    from tessera.functions.structs import redacted_json as r
    hidden = '"***REDACTED***"'
    assert r(' { "a" : 1.50 , "Password":"x\\"y", "l": [ {"auth":{"q":[1,{"z":"}"}]}}, "key", null ] } ') == (
        ' { "a" : 1.50 , "Password":' + hidden + ', "l": [ {"auth":' + hidden + '}, "key", null ] } ')
    assert r('{"key":[1,2],"b":{"token":null}}') == '{"key":' + hidden + ',"b":{"token":' + hidden + "}}"
    assert r('{"\\u0074oken":1}') == '{"\\u0074oken":' + hidden + "}"
    for same in ('"key"', "[]", "{}", "12", '["token", "secret"]', '{"a":"key"}', "no { json", "", '{"token": 1', None):
        assert r(same) == same
    deep = '{"a":' * 30_000 + '{"key":1}' + "}" * 30_000
    assert r(deep) == deep.replace('"key":1', '"key":' + hidden)


def test_redact_keeps_types_of_nested_maps(spark):
    from pyspark.sql import types as T
    kind = "id int, m map<string,struct<n:int,s:string,l:array<string>>>, mm map<string,map<string,int>>, js string"
    row = (1, {"secret": (1, "x", ["y"]), "open": (2, "z", None)}, {"auth": {"a": 1}, "b": {"token": 2, "c": 3}}, '{"token":1}')
    df = spark.createDataFrame([row, (2, None, None, None)], kind).withColumn("v", F.parse_json("js"))
    out = tf.redact(df, json_cols=("js",))
    assert isinstance(out.schema["m"].dataType.valueType, T.StructType) and isinstance(out.schema["v"].dataType, T.VariantType)
    r = {x.id: x for x in out.withColumn("v", F.to_json("v")).collect()}
    hidden = "***REDACTED***"
    assert r[1].m["secret"].asDict() == {"n": None, "s": hidden, "l": [hidden]} and r[1].m["open"].asDict() == {"n": 2, "s": "z", "l": None}
    assert r[1].mm == {"auth": {"a": hidden}, "b": {"token": hidden, "c": "3"}} or r[1].mm["b"] == {"token": hidden, "c": "3"}
    assert r[1].js == r[1].v == '{"token":"' + hidden + '"}' and r[2].m is None and r[2].js is None
