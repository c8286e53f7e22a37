"""Transformation (T1, T10-T15) on rows of a festival programme."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import computed
from tessera.operators.transform import (FunctionRegistry, add_computed_columns, apply_field_mapping,
                                         convert_types, evaluate_expression, transform, transform_stats)
from tests.conftest import rows

SHOWS = [("Night of the organ", "mina van der Berg", "18.5", ["music", "church"]),
         ("Juggling", "Ozan", "free", None), ("", None, "7", [])]
SCHEMA = "show string, act string, fee string, kinds array<string>"


def spec() -> dict:
    return {"field_mapping": {"show": "title", "act": "artist"}, "type_conversions": {"fee": "float", "title": "string"},
            "custom_functions": {"letters": computed.text_length("title"), "signed": computed.author_initials("artist"),
                                 "n_kinds": computed.tag_count("kinds"), "per_head": "fee / 4"}}


def shows(spark):
    return spark.createDataFrame(SHOWS, SCHEMA)


def test_mapping_then_conversion_then_functions(spark):
    out = rows(transform(shows(spark), spec()))
    assert [(r["title"], r["fee"], r["letters"], r["signed"], r["n_kinds"], r["per_head"]) for r in out[:2]] == [
        ("Night of the organ", 18.5, 18, "MVDB", 2, 4.625), ("Juggling", None, 8, "O", None, None)]
    assert out[1]["_raw"] == {"fee": "free"} and out[1]["_conv_errors"] == ["fee"] and not out[0]["_conv_errors"]
    assert not {"show", "act"} & set(out[0])


def test_mapping_rules(spark):
    df = spark.createDataFrame([("w", "x", "y", "z")], "hall string, row string, seat string, gate string")
    got = lambda m: rows(apply_field_mapping(df, m))[0]
    moved = apply_field_mapping(df, {"seat": "place", "nowhere": "lost", "hall": "house"})
    assert moved.columns == ["place", "house", "row", "gate"]              # mapped ones first, in the mapping's order
    assert got({"row": "seat", "seat": "row"}) == {"seat": "x", "row": "y", "hall": "w", "gate": "z"}
    assert got({"hall": "spot", "gate": "spot"})["spot"] == "z"            # the last of two
    assert got({"hall": "gate"})["gate"] == "z"                            # a field that keeps its name
    assert apply_field_mapping(df, {}).columns == df.columns


@pytest.mark.parametrize("text, kind, value", [
    ("-17.9", "int", -17), ("1_200", "int", 1200), (" 6 ", "int", 6), ("six", "int", None), ("", "int", None),
    ("2.50", "float", 2.5), ("-Infinity", "float", float("-inf")), ("0x1p3", "float", None),
    ("On", "bool", True), ("nope", "bool", False),
    ('["p", 3, null]', "array", ["p", "3", None]), ("[4],[5]", "array", ["[4]", "[5]"]), ("p; q , r", "array", ["p; q", "r"]), ('[1],"x":[2]', "array", ["[1]", '"x":[2]']),
    ('{"door": "left"}', "dict", {"door": "left"}), ('{"a": 1} {"b": 2}', "dict", None), ("door", "dict", None)])
def test_conversions_of_texts(spark, text, kind, value):
    r = rows(convert_types(spark.createDataFrame([(text,)], "v string"), {"v": kind}))[0]
    assert r["v"] == value
    if kind != "bool":
        assert (r["_raw"] == {"v": text}) == (value is None) == (r["_conv_errors"] == ["v"])


def test_numbers_as_python_prints_them(spark):
    numbers = [0.1, -0.0, 1e-4, 9.5e-5, 12500000.0, 3e15, 1e16, 2.25e21, float("nan"), float("-inf"), 123456789.125]
    df = spark.createDataFrame([(x, True) for x in numbers], "x double, b boolean")
    out = rows(convert_types(df, {"x": "string", "b": "string"}))
    assert [r["x"] for r in out] == [str(x) for x in numbers] and out[0]["b"] == "True"


def test_an_unknown_type_or_field_changes_nothing(spark):
    out = convert_types(shows(spark), {"fee": "money", "stage": "int"})
    assert out.columns == shows(spark).columns and rows(out) == rows(shows(spark))


def test_functions_see_the_row_as_it_came(spark):
    out = rows(add_computed_columns(shows(spark), {"show": F.lit("closed"), "was": F.col("show"), "loud": computed.upper_text("act")}))
    assert (out[0]["show"], out[0]["was"], out[0]["loud"]) == ("closed", "Night of the organ", "MINA VAN DER BERG")


def test_a_failing_expression_is_null_in_its_row_alone(spark):
    df = spark.createDataFrame([(6, 2, "12"), (6, 0, "twelve"), (None, 1, None)], "a int, b int, t string")
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    out = rows(evaluate_expression(df, "a / b"))
    assert [r["result"] for r in out] == [3.0, None, None]
    out = rows(add_computed_columns(df, {"n": "cast(t AS int) + 1", "k": "element_at(array('p', 'q'), b + 1)", "m": "a % b"}))
    assert [(r["n"], r["k"], r["m"]) for r in out] == [(13, None, 0), (None, "p", None), (None, "q", None)]
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_registry(spark):
    reg = FunctionRegistry({"doubled": "fee * 2"})
    reg.add("shout", lambda df: F.upper(df["show"]))
    reg.add("unused", "1")
    reg.remove("unused")
    reg.remove("never there")
    assert reg.names() == ["doubled", "shout"] and reg.get("doubled") == "fee * 2"
    out = rows(transform(shows(spark), {"type_conversions": {"fee": "float"}}, reg))
    assert [(r["doubled"], r["shout"]) for r in out] == [(37.0, "NIGHT OF THE ORGAN"), (None, "JUGGLING"), (14.0, "")]


def test_statistics_name_the_fields(spark):
    r = rows(transform_stats(shows(spark), transform(shows(spark).limit(2), spec())))[0]
    assert (r["original_count"], r["transformed_count"]) == (3, 2)
    assert r["removed_fields"] == "act,show" and r["common_fields"] == "fee,kinds"
    assert set(r["added_fields"].split(",")) == {"title", "artist", "letters", "signed", "n_kinds", "per_head", "_raw", "_conv_errors"}


def test_named_builders(spark):
    df = spark.createDataFrame([("Tickets EUR 2,450.75 at the door, urgent", "ftp://files.stage.example:21/a/b?c", ["x"])],
                               "note string, place string, marks array<string>")
    r = rows(df.select(
        computed.price_clean(F.regexp_extract("note", r"([0-9,.]+)", 1)).alias("price"), computed.url_category("place").alias("kind"),
        computed.domain("place").alias("host"), computed.text_hash("note").alias("h"), computed.tag_count("marks").alias("n")))[0]
    assert (r["price"], r["host"], len(r["h"]), r["n"]) == (2450.75, "files.stage.example:21", 32, 1) and r["kind"]


def test_generators_and_arrow_functions_by_name(spark):
    class Kinds:
        def eval(self, kinds):
            for k in kinds or []:
                yield k, len(k)

    FunctionRegistry.register_generator(spark, "kinds_of", Kinds, "kind string, n int")
    FunctionRegistry.register_pandas_udf(spark, "plus_one", lambda s: s + 1, "int")
    df = spark.createDataFrame([(1, ["a", "bc"]), (2, []), (3, None)], "id int, ks array<string>")
    spec = {"row_generators": ["kinds_of(ks)"], "custom_functions": {"m": "plus_one(n)"}}
    assert [(r["id"], r["kind"], r["n"], r["m"]) for r in rows(transform(df, spec))] == [(1, "a", 1, 2), (1, "bc", 2, 3)]
    for name in ("kinds_of", "plus_one"):
        FunctionRegistry.unregister(spark, name)
    with pytest.raises(Exception, match="kinds_of|RESOLVE"):
        transform(df, spec).collect()


def test_fields_are_the_union_over_rows(spark):
    from tessera.operators.transform import variant_stats
    docs = lambda *texts: spark.createDataFrame([(t,) for t in texts], "t string").select(F.parse_json("t").alias("value"))
    r = rows(variant_stats(docs('{"a":1,"b":{"x":2}}', '{"c":null}', "[1]", "null"), docs('{"b":1,"d":2}', '{"a":0}')))[0]
    assert (r["original_count"], r["transformed_count"], r["original_field_count"], r["transformed_field_count"]) == (4, 2, 3, 3)
    assert (r["added_fields"], r["removed_fields"], r["common_fields"]) == ("d", "c", "a,b")
    r = rows(variant_stats(docs("{}").limit(0), docs('{"z":1}')))[0]
    assert (r["original_count"], r["transformed_count"], r["added_fields"], r["removed_fields"]) == (0, 1, "z", "")


def test_expressions_resolved_by_many_threads(spark):
    from concurrent.futures import ThreadPoolExecutor
    df = spark.createDataFrame([(1, 0)], "a int, b int")
    with ThreadPoolExecutor(8) as pool:
        out = list(pool.map(lambda _: evaluate_expression(df, "a / b"), range(40)))
    assert spark.conf.get("spark.sql.ansi.enabled") == "true" and all(x.first()["result"] is None for x in out[::13])
