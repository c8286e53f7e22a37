"""HTML extraction (E1-E10) on pages of a parts catalogue and a tide table."""

import pytest

from tessera.operators.extract import (extract_items, extract_targets, next_links, pagination_walk, split_errors,
                                       with_provenance)
from tests.conftest import rows

PARTS = """<html><body><table id="parts">
<tr class="part" data-sku="K-1"><td><b>Hinge, brass</b></td><td class="eur">4.20</td><td><img src="img/k1.png"><a href="/spec/k1">spec</a></td>
  <td><i>door</i><i>gate</i></td></tr>
<tr class="part" data-sku="K-2"><td><b>Bolt &amp; nut <u>M8</u></b></td><td class="eur"> 0.35 </td><td><a href="spec?id=2">spec</a></td><td></td></tr>
<tr class="part"><td><b></b></td><td>on request</td><td></td><td><i> frame </i></td></tr>
</table><p class="more"><a href="?from=3">further parts</a></p></body></html>"""
TIDES = """<body><section class="tide"><time>04:10</time><em>high</em></section><section class="tide"><time>10:32</time><em>low</em></section>
<section class="tide"><time>16:41</time><a href="//[high">broken address</a></section></body>"""
PART = {"name": "b::text", "price": "td.eur::text", "sku": "::attr(data-sku)"}


def pages(spark, *docs):
    return spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(docs)], "page_id long, url string, html string")


def catalogue(spark):
    return pages(spark, ("https://shop.test/list/", PARTS))


def test_fields_of_each_item_in_order(spark):
    out = rows(extract_items(catalogue(spark), "tr.part", PART).orderBy("item_pos"))
    assert [(r["item_pos"], r["name"], r["price"], r["sku"]) for r in out] == [
        (0, "Hinge, brass", "4.20", "K-1"), (1, "Bolt & nutM8", "0.35", "K-2"), (2, "", None, None)]
    assert all(r["source_url"] == "https://shop.test/list/" and r["_error"] is None for r in out)


def test_addresses_are_made_absolute(spark):
    out = rows(extract_items(catalogue(spark), "tr.part", {"spec": "a::attr(href)", "image": "img::attr(src)"}).orderBy("item_pos"))
    assert [(r["spec"], r["image"]) for r in out] == [
        ("https://shop.test/spec/k1", "https://shop.test/list/img/k1.png"), ("https://shop.test/list/spec?id=2", None), (None, None)]
    own = rows(extract_items(catalogue(spark), "a", {"to": "::attr(href)", "word": "::text"}).orderBy("item_pos"))
    assert [(r["to"], r["word"]) for r in own][1:] == [("https://shop.test/list/spec?id=2", "spec"), ("https://shop.test/list/?from=3", "further parts")]


def test_all_matches_and_plain_selectors(spark):
    out = rows(extract_items(catalogue(spark), "tr.part", {"for": "i", "first": "i", "self": "::text"}, multi=("for",)).orderBy("item_pos"))
    assert [(r["for"], r["first"]) for r in out] == [(["door", "gate"], "door"), ([], None), (["frame"], "frame")]
    assert out[2]["self"] == "on requestframe"


def test_without_items_there_are_no_rows(spark):
    assert extract_items(catalogue(spark), None, PART).count() == 0
    assert extract_items(catalogue(spark), "li.part", PART).count() == 0
    assert extract_items(pages(spark, ("u", None), ("u", "")), "tr.part", PART).count() == 0


def test_provenance(spark):
    good, bad = split_errors(extract_items(catalogue(spark), "tr.part", {**PART, "run_id": "b"}))
    r = rows(with_provenance(good, "run-5", "parts").orderBy("item_pos"))[0]
    assert (r["run_id"], r["target_name"], r["source_url"]) == ("run-5", "parts", "https://shop.test/list/") and r["fetch_time"]
    assert bad.count() == 0


def test_a_failing_item_leaves_the_others_alone(spark):
    good, bad = split_errors(extract_items(pages(spark, ("https://sea.test/", TIDES)), "section.tide", {"at": "time", "link": "a::attr(href)"}))
    assert sorted(r["at"] for r in rows(good)) == ["04:10", "10:32"]
    r, = rows(bad)
    assert r["item_pos"] == 2 and r["at"] is None and r["_error"].startswith("item: ValueError")


def test_next_links(spark):
    pg = pages(spark, ("https://shop.test/list/", PARTS), ("https://sea.test/", TIDES), ("https://x.test/a/b", '<p class="more"><a>c/d</a></p>'))
    assert {r["page_id"]: r["next_url"] for r in rows(next_links(pg, "p.more a::attr(href)"))} == {0: "https://shop.test/list/?from=3", 1: None, 2: None}
    by_text = rows(next_links(pg, "p.more a", base_url="https://mirror.test/m/"))
    assert {r["page_id"]: r["next_url"] for r in by_text} == {0: "https://mirror.test/m/?from=3", 1: None, 2: "https://mirror.test/m/c/d"}


def test_walk_stops_at_its_length_at_loops_and_at_missing_pages(spark):
    at = lambda k: f"https://log.test/{k}"
    link = lambda k: f'<a rel="on" href="/{k}">on</a>'
    pg = pages(spark, *[(at(k), link(k + 1)) for k in range(6)], (at(20), link(21)), (at(21), link(20)), (at(30), link(99)), (at(20), link(21)))
    start = spark.createDataFrame([(at(0),), (at(20),), (at(30),), (at(77),), (at(0),)], "url string")
    walk = lambda n: {r["url"]: r["depth"] for r in rows(pagination_walk(pg, start, "a::attr(href)", max_pages=n))}
    assert walk(1) == {at(0): 0, at(20): 0, at(30): 0}
    assert walk(4) == {**{at(k): k for k in range(4)}, at(20): 0, at(21): 1, at(30): 0}
    assert max(walk(50).values()) == 5


def test_broken_markup(spark):
    html = "<div class=x><p>one<p>two <b>three</div><div class='x'>four<br><i>five</i></div></span><!-- <div class=x>no</div> --><script>'<div class=x>'</script>"
    out = rows(extract_items(pages(spark, ("u", html)), "div.x", {"all": "::text", "b": "b"}).orderBy("item_pos"))
    assert [r["b"] for r in out][:2] == ["three", None] and len(out) == 2 and out[1]["all"] == "fourfive"


def test_targets_share_one_parse(spark):
    pg = pages(spark, ("https://shop.test/", PARTS), ("https://sea.test/", TIDES))
    both = {"parts": {"item_selector": "tr.part", "fields": {"name": "b", "what": "td.eur"}},
            "tides": {"item_selector": "section.tide", "fields": {"what": "em", "link": "a::attr(href)"}}}
    out = rows(extract_targets(pg, both).orderBy("target_name", "item_pos"))
    assert [(r["target_name"], r["page_id"], r["name"], r["what"]) for r in out if not r["_error"]] == [
        ("parts", 0, "Hinge, brass", "4.20"), ("parts", 0, "Bolt & nutM8", "0.35"), ("parts", 0, "", None),
        ("tides", 1, None, "high"), ("tides", 1, None, "low")]
    assert [(r["target_name"], r["item_pos"]) for r in out if r["_error"]] == [("tides", 2)]


def test_a_bad_selector_fails_before_the_job(spark):
    with pytest.raises(ValueError):
        extract_items(catalogue(spark), "tr.part", {"x": "td[class"})


# ---------------------------------------------------------------- runs
def spec(spark, kind="csv", **storage):
    from tessera.session import scratch_path
    return {"name": "parts", "extract": {"item_selector": "tr.part", "fields": {**PART, "link": "a::attr(href)"}},
            "cleaner": {"field_validation": {"price": {"type": "float"}, "sku": {"required": True}}, "remove_duplicates": True, "duplicate_keys": ["sku"]},
            "transformer": {"field_mapping": {"name": "title"}, "type_conversions": {"price": "float"}, "custom_functions": {"cents": "price * 100"}},
            "storage": {"type": kind, "path": scratch_path(spark, "run"), **storage}}


def test_runs_append_and_count(spark):
    from tessera.plans.runner import run_target
    from tessera.sources import read_csv
    broken = PARTS.replace('href="/spec/k1"', 'href="//[k1"').replace("K-2", "K-3")
    pg = pages(spark, ("https://shop.test/", PARTS), ("https://shop.test/again", PARTS), ("https://shop.test/b", broken))
    s = spec(spark, delimiter="|")
    for run in ("first", "second"):
        _, rec = run_target(pg, s, run_id=run)
        assert (rec["status"], rec["scraped_count"], rec["failed_count"], rec["processed_count"], rec["saved_count"]) == ("success", 8, 2, 3, 3), rec
    stored = rows(read_csv(spark, rec["output_path"], delimiter="|"))
    assert sorted((r["run_id"], r["sku"], r["cents"]) for r in stored) == [
        (run, sku, cents) for run in ("first", "second") for sku, cents in (("K-1", "420.0"), ("K-2", "35.0"), ("K-3", "35.0"))]
    _, rec = run_target(pg, {**s, "storage": {**s["storage"], "mode": "overwrite"}}, run_id="third")
    assert {r["run_id"] for r in rows(read_csv(spark, rec["output_path"], delimiter="|"))} == {"third"}


def test_nothing_is_saved_by_noop_and_dry_runs(spark):
    from tessera.plans.runner import run_target
    for record in (run_target(catalogue(spark), spec(spark), dry_run=True)[1],
                   run_target(catalogue(spark), {**spec(spark), "storage": {"type": "noop"}})[1]):
        assert (record["processed_count"], record["saved_count"], record["output_path"], record["status"]) == (2, 0, None, "success")


def test_rejects_and_errors_are_both_kept(spark):
    from tessera.plans.runner import build_plan, failures
    pg = pages(spark, ("https://shop.test/", PARTS.replace('href="/spec/k1"', 'href="//[k1"')))
    result, rejected, errors = build_plan(pg, spec(spark), "r")
    assert [r["sku"] for r in rows(result)] == ["K-2"]
    log = rows(failures(rejected, errors, "parts").orderBy("item_pos"))
    assert [(r["item_pos"], r["stage"], r["reason"].split(":")[0]) for r in log] == [(0, "extract", "item"), (2, "validate", "sku")]


@pytest.mark.parametrize("change, message", [
    ({"storage": {"type": "xml", "path": "p"}}, "Unsupported storage type"), ({"storage": {"type": "csv"}}, "storage.path"),
    ({"cleanser": {}}, "unknown key cleanser"), ({"extract": {"fields": {}}}, "at least one field"), ({"name": ""}, "name is missing"),
    ({"extract": {"item_selector": "tr[", "fields": {"a": "b"}}}, "selector"), ({"cleaner": {"duplicate_keys": ["nope"], "remove_duplicates": True}}, "duplicate key"),
    ({"cleaner": {"handle_missing": {"strategy": "guess"}}}, "unknown strategy"), ({"order_by": ["when"]}, "order_by")])
def test_a_wrong_spec_is_a_failure_record(spark, change, message):
    from tessera.plans.runner import run_target
    _, rec = run_target(catalogue(spark), {**spec(spark), **change}, run_id="x")
    assert rec["status"] == "failed" and message in rec["error"] and rec["saved_count"] == 0


def test_all_targets_one_wrong(spark):
    from tessera.plans.runner import run_all_targets
    pg = pages(spark, ("https://shop.test/", PARTS), ("https://sea.test/", TIDES))
    tides = {"name": "tides", "extract": {"item_selector": "section.tide", "fields": {"what": "em", "link": "a::attr(href)"}}}
    done, log = run_all_targets(pg, [spec(spark), tides, {"name": "torn", "extract": {"fields": {}}}])
    assert {r["target_name"]: r["count"] for r in done.groupBy("target_name").count().collect()} == {"parts": 2, "tides": 2}
    assert sorted((r["target_name"], r["stage"]) for r in rows(log)) == [("parts", "validate"), ("tides", "extract"), ("torn", "spec")]


def test_only_the_driver_has_the_package(tmp_path):
    """HTML steps run where the package is on the driver's path alone."""
    import os
    import pathlib
    import subprocess
    import sys
    root = pathlib.Path(__file__).resolve().parent.parent
    code = (f"import sys; sys.path.insert(0, {str(root)!r})\n"
            "from tessera import get_spark, extract_items\n"
            "s = get_spark('local[1]')\n"
            "df = s.createDataFrame([(1, 'u', '<p>x</p>')], 'page_id long, url string, html string')\n"
            "print('GOT', extract_items(df, 'p', {'t': '::text'}).first().t)\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "GOT x" in out.stdout, out.stderr[-800:]


def test_walks_by_doubling(spark):
    """Chains, cycles, copies that disagree and links out of the table, for any number of pages."""
    nxt = {i: i + 1 for i in range(40)} | {40: 30, 50: 51, 51: 52, 52: 50, 60: 99, 70: 70}
    html = lambda to: f'<a class="n" href="http://t.example/{to}">on</a>'
    pages = [(f"http://t.example/{i}", html(to)) for i, to in nxt.items()] + [("http://t.example/80", ""), ("http://t.example/51", html(53))]
    df = spark.createDataFrame(pages * 2, "url string, html string")
    starts = spark.createDataFrame([(f"http://t.example/{i}",) for i in (0, 25, 51, 60, 70, 80, 99, 0)], "url string")
    for most in (1, 2, 3, 7, 8, 9, 33, 1000):
        want = {}
        for s in (0, 25, 51, 60, 70, 80):
            at, d = s, 0
            while d < most and (at in nxt or at == 80):
                want[at] = min(d, want.get(at, d))
                at, d = nxt.get(at), d + 1
                if d > 200:
                    break
        got = {int(r.url.rsplit("/", 1)[1]): r.depth for r in pagination_walk(df, starts, "a.n::attr(href)", max_pages=most).collect()}
        assert got == want, most
