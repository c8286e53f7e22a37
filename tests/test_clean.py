"""Cleaning (C1-C12) on rows of a tool shed's stock list."""

import pytest
from pyspark.sql import functions as F

from tessera.operators.clean import (clean, clean_strings, cleaning_stats, drop_empty_rows, drop_missing,
                                     fill_missing, handle_missing, interpolate_missing)
from tessera.operators.dedupe import dedupe_first, with_input_order
from tessera.operators.validate import error_counts, validate
from tests.conftest import rows

SCHEMA = "line int, tool string, shelf string, uses array<string>, grams int"
STOCK = [
    (10, "plane", "B2", ["wood"], 1450),
    (11, " brace   and  bit ", "A1", ["wood", "holes"], 900),
    (12, "plane", "B2", ["finish"], 1500),          # the same tool and shelf again
    (13, None, "C9", None, 20),
    (14, "", "C9", [], None),
    (15, "rasp", None, ["wood"], 310),
    (16, "rasp", None, ["horn"], 311),              # equal with a null in the key
]
SPEC = {"remove_duplicates": True, "duplicate_keys": ["tool", "shelf"],
        "handle_missing": {"strategy": "default", "default_values": {"tool": "unnamed", "shelf": "floor"}}}


def stock(spark):
    return spark.createDataFrame(STOCK, SCHEMA)


def test_chain_fills_then_dedupes_then_cleans(spark):
    good, rejected = clean(stock(spark), SPEC, order_by="line")
    got = {r["line"]: (r["tool"], r["shelf"]) for r in rows(good)}
    assert got == {10: ("plane", "B2"), 11: ("brace and bit", "A1"), 13: ("unnamed", "C9"), 15: ("rasp", "floor")}
    assert rejected is None


def test_first_line_wins_whatever_the_row_order(spark):
    df = stock(spark).orderBy(F.desc("line"))
    kept = {r["line"] for r in rows(dedupe_first(df, ["tool", "shelf"], "line"))}
    assert kept == {10, 11, 13, 14, 15}
    numbered = with_input_order(spark.createDataFrame([("saw", 2), ("saw", 1), ("axe", 3)], "t string, n int").coalesce(1))
    assert sorted((r["t"], r["n"]) for r in rows(dedupe_first(numbered, ["t"], "_row_order"))) == [("axe", 3), ("saw", 2)]


def test_a_key_column_that_is_not_there_counts_as_null(spark):
    assert dedupe_first(stock(spark), ["shelf", "row"], "line").count() == dedupe_first(stock(spark), ["shelf"], "line").count() == 4


def test_dropping_needs_a_value_in_every_required_field(spark):
    assert sorted(r["line"] for r in rows(drop_missing(stock(spark), ["tool", "shelf"]))) == [10, 11, 12]
    rules = {"grams": {"required": True}, "shelf": {"required": False}}
    assert sorted(r["line"] for r in rows(handle_missing(stock(spark), {"strategy": "drop"}, rules))) == [10, 11, 12, 13, 15, 16]
    assert handle_missing(stock(spark), {"strategy": "guess"}).count() == 7


def test_defaults_fill_nulls_and_empty_texts_but_not_empty_lists(spark):
    out = {r["line"]: r for r in rows(fill_missing(stock(spark), {"tool": "?", "uses": ["any"], "bought": "1999"}))}
    assert (out[13]["tool"], out[14]["tool"], out[10]["tool"]) == ("?", "?", "plane")
    assert out[13]["uses"] == ["any"] and out[14]["uses"] == []
    assert {r["bought"] for r in out.values()} == {"1999"}
    assert {r["line"] for r in rows(interpolate_missing(stock(spark), {"tool": "?"}))} == set(out)


def test_forward_fill(spark):
    gauge = [("north", 1, 4.5), ("north", 2, None), ("north", 3, None), ("north", 4, 6.0), ("south", 1, None), ("south", 2, 7.25)]
    df = spark.createDataFrame(gauge, "site string, hour int, level double")
    out = interpolate_missing(df, {"level": -1.0}, method="ffill", partition_by=["site"], order_by="hour")
    assert [r["level"] for r in rows(out.orderBy("site", "hour"))] == [4.5, 4.5, 4.5, 6.0, -1.0, 7.25]
    with pytest.raises(ValueError):                 # never skipped in silence
        interpolate_missing(df, {"level": -1.0}, method="ffill")


def test_strings_are_cleaned_in_texts_and_lists_alone(spark):
    df = spark.createDataFrame([("\t tin   snips\x07 ", [" a  b", None, ""], {"k": " raw "}, 3, " ", None)],
                               "t string, l array<string>, m map<string,string>, n int, blank string, nothing string")
    r = rows(clean_strings(df))[0]
    assert (r["t"], r["l"], r["m"], r["n"], r["blank"], r["nothing"]) == ("tin snips", ["a b", None, ""], {"k": " raw "}, 3, "", None)


def test_validation_splits_rows_and_counts_reasons(spark):
    df = spark.createDataFrame([("drill", "7", "on"), ("lathe", "7.5", "off"), (None, "8", "perhaps"), ("vice", None, None)],
                               "tool string, size string, ready string")
    rules = {"tool": {"required": True, "type": "string"}, "size": {"type": "int"}, "ready": {"type": "bool"}}
    good, bad = validate(df, rules)
    assert sorted(r["tool"] for r in rows(good)) == ["drill", "vice"]
    assert sorted(tuple(r["_errors"]) for r in rows(bad)) == [("size:type_int",), ("tool:missing", "ready:type_bool")]
    counts = {(r["field"], r["reason"]): r["failures"] for r in rows(error_counts(df, rules))}
    assert counts[("*", "rejected_rows")] == 2 and counts[("ready", "type_bool")] == 1


@pytest.mark.parametrize("extra", [{}, {"clean_before_dedupe": True}, {"field_validation": {"grams": {"required": True}}},
                                   {"handle_missing": {"strategy": "drop"}, "field_validation": {"shelf": {"required": True}}},
                                   {"drop_empty_rows": True}, {"clean_before_dedupe": True, "field_validation": {"tool": {"required": True, "type": "string"}}}])
def test_statistics_say_what_clean_does(spark, extra):
    more = spark.createDataFrame([(17, "  plane ", "B2", None, 5), (18, "rasp  ", None, None, None)], SCHEMA)
    df, spec = stock(spark).unionByName(more), {**SPEC, **extra}
    n = clean(df, spec, order_by="line")[0].count()
    r = rows(cleaning_stats(df, spec, "line"))[0]
    assert (r["original_count"], r["cleaned_count"], r["removed_count"]) == (9, n, 9 - n)
    assert r["removal_rate"] == pytest.approx((9 - n) / 9)


def test_statistics_of_nothing(spark):
    assert rows(cleaning_stats(stock(spark).limit(0), SPEC, "line"))[0]["removal_rate"] == 0.0


def test_rows_without_any_value(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, "x"), (3, "y", None)], "id int, a string, b string")
    assert sorted(r["id"] for r in rows(drop_empty_rows(df, ignore=["id"]))) == [2, 3]
    assert drop_empty_rows(df).count() == 3


def test_cleaning_stats_of_whole_texts(spark):
    """Documents count as equal by their whole cleaned text, whatever blanks stand around it."""
    import __spark_entry__ as entry
    from tests.conftest import SF001
    texts = [r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").select("text").collect()]
    r = entry.queries()["cleaning_stats_cleaned"](spark, SF001).collect()[0]
    k = len({" ".join(t.split()) for t in texts})
    assert (r.original_count, r.cleaned_count) == (len(texts), k)
    assert k > len({t.strip()[:1] for t in texts}) and r.removed_count > 0


def test_values_carried_across_tasks(spark, monkeypatch):
    """One key with most rows spans tasks; null keys and nulls before the first value."""
    import random

    from tessera.operators.clean import carry_forward
    rng = random.Random(4)
    data = [(k, t, rng.choice([None, None, None, t * 10]), rng.choice([None, f"s{t}"]))
            for k, n in (("hot", 400), ("b", 30), (None, 20), ("late", 5)) for t in range(n)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "k string, t int, x int, s string").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = carry_forward(df, ["x", "s"], ["k"], ["t"])
        assert out.columns == df.columns
        got = sorted(((r.k, r.t, r.x, r.s) for r in out.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = []
    for key in {k for k, *_ in data}:
        x = s = None
        for k, t, a, b in sorted((r for r in data if r[0] == key), key=lambda r: r[1]):
            x, s = x if a is None else a, s if b is None else b
            want.append((k, t, x, s))
    assert got == sorted(want, key=str)
    assert carry_forward(df.limit(0), ["x"], ["k"], ["t"]).count() == 0
