"""Physical-plan properties that matter at scale: filters and columns reach the
scan, de-duplication limits rows before the shuffle, no cartesian products, no
row-at-a-time Python, Python only where HTML/URL work needs it."""

import re

import pytest

import __spark_entry__ as entry
from tests.conftest import SF001
from tests.test_oracle import own

PYTHON_OK = {"extract_title", "extract_nav_links", "next_link", "pagination_walk", "multi_target_extract",
             "extract_plain_selector", "run_result", "run_rejected", "run_target_dry", "jsonl_ascii_roundtrip", "flatten_json", "flatten_documents",
             "merge_versions", "merge_versions_documents", "redact_json", "registry_generators"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_projection_pushdown(spark):
    p = plan(entry.queries()["filter_field"](spark, SF001))
    assert re.search(r"PushedFilters: \[[^\]]*Equal[A-Za-z]*\(o_orderstatus,F\)", p)
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in p


def test_dedupe_partial_limit_before_shuffle(spark):
    df = entry.queries()["dedupe_events"](spark, SF001)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in p and "Partial" in p


def test_cleaning_stats_uses_partial_aggregation(spark):
    p = plan(entry.queries()["cleaning_stats"](spark, SF001))
    assert "Window" not in p
    assert "partial_" in p


@pytest.mark.parametrize("key", own(entry.queries()))
def test_no_cartesian_no_row_udf(spark, key):
    df = entry.queries()[key](spark, SF001)
    p = plan(df)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "BatchEvalPython" not in p                   # no row-at-a-time Python UDF
    if key not in PYTHON_OK:
        assert not any(x in p for x in ("MapInPandas", "MapInArrow", "ArrowEvalPython"))
