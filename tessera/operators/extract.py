"""HTML extraction (E1-E10): pages -> item rows.

``extract_items`` is a flat-map from page to rows run with ``mapInPandas``: one
Python pass per page over Arrow batches, selectors compiled once per task, no
shuffle. Provenance columns (E5) are added outside Python as Catalyst expressions.
The pagination walk (E8) runs on Spark joins over an edge table extracted once.
"""

from __future__ import annotations

import re
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.htmltree import compile_selector, parse, select, select_one

_SUFFIX = re.compile(r"^(.*?)(?:::(text|attr\(([\w:-]+)\)))?\s*$", re.S)
# Output rows per yielded pandas frame (memory bound independent of page sizes).
OUTPUT_CHUNK_ROWS = 5000
# Attributes holding URLs, made absolute against the page URL.
URL_ATTRS = {"href", "src"}


def parse_field_selector(sel: str):
    """'css::text' | 'css::attr(name)' | 'css' -> (css, attribute or None)."""
    m = _SUFFIX.match(sel)
    css, kind, attr = m.group(1).strip(), m.group(2), m.group(3)
    return css, (attr if kind and kind.startswith("attr") else None)


def _node_value(n, attr, page_url):
    """An element's text, or its attribute (URLs made absolute, empty ones missing)."""
    if attr is None:
        return n.get_text(strip=True)
    v = n.get(attr, "")
    if not v:
        return None
    return urljoin(page_url or "", v) if attr in URL_ATTRS else v


def _field_value(scope, css_compiled, attr, page_url, multi):
    nodes = select(scope, css_compiled) if multi else [select_one(scope, css_compiled)]
    vals = [_node_value(n, attr, page_url) for n in nodes if n is not None]
    if multi:
        return [v for v in vals if v is not None]
    return vals[0] if vals else None


def _validate(selectors) -> None:
    """Compile every selector once on the driver so a malformed one fails while the
    plan is built, not inside a Python worker."""
    for sel in selectors:
        if sel:
            compile_selector(sel)


def _spark_type(dtype: T.DataType) -> str:
    return dtype.simpleString()


def extract_items(pages: DataFrame, item_selector: str | None, fields: dict[str, str], *,
                  url_col: str = "url", html_col: str = "html", keep: tuple = ("page_id",),
                  multi: tuple = ()) -> DataFrame:
    """One row per element matching ``item_selector`` (in
    document order, ``item_pos`` from 0); per field the first match's text or
    attribute (``multi`` fields: all matches as an array). No item selector -> no
    rows. A failing item or page gives a row with ``_error`` set and null fields."""
    target = {"item_selector": item_selector, "fields": fields, "multi": multi}
    return extract_targets(pages, {"": target}, url_col=url_col, html_col=html_col, keep=keep).drop("target_name")


def extract_targets(pages: DataFrame, targets: dict[str, dict], *, url_col: str = "url",
                    html_col: str = "html", keep: tuple = ("page_id",)) -> DataFrame:
    """E10 in one pass: every page is parsed once and all targets' selectors run on
    the same tree. ``targets`` maps a target name to ``{"item_selector": ...,
    "fields": {...}, "multi": (...)}``; output = ``target_name`` + the columns of
    :func:`extract_items` with the union of all fields (null where a target lacks
    a field)."""
    keep = tuple(keep)
    specs = {}
    field_types: dict[str, str] = {}
    for name, t in targets.items():
        multi = tuple(t.get("multi", ()))
        specs[name] = (t.get("item_selector"), {k: parse_field_selector(v) for k, v in t["fields"].items()}, multi)
        for k in t["fields"]:
            typ = "array<string>" if k in multi else "string"
            if field_types.setdefault(k, typ) != typ:
                raise ValueError(f"field {k!r} is multi-valued in one target and not in another")
    fields = list(field_types)
    _validate([sel for sel, fs, _ in specs.values()] + [css for _, fs, _ in specs.values() for css, _ in fs.values()])
    keep_ddl = [f"`{k}` {_spark_type(pages.schema[k].dataType)}" for k in keep]
    schema = ", ".join(keep_ddl + ["target_name string", "source_url string", "item_pos int"]
                       + [f"`{k}` {t}" for k, t in field_types.items()] + ["_error string"])
    src = pages.select(*keep, F.col(url_col).alias("_url"), F.col(html_col).alias("_html"))
    cols = list(keep) + ["target_name", "source_url", "item_pos"] + fields + ["_error"]

    def emit(rows):
        # every key present (missing fields must be None, not a float NaN column)
        out = pd.DataFrame([{c: r.get(c) for c in cols} for r in rows], columns=cols, dtype=object)
        out["item_pos"] = out["item_pos"].astype("Int32")
        return out

    def item(el, fs, multi, url):
        """The fields of one item. A selector without a path means the item itself."""
        out = {}
        for k, (cs, attr) in fs.items():
            if cs is not None:
                out[k] = _field_value(el, cs, attr, url, k in multi)
                continue
            value = _node_value(el, attr, url)
            out[k] = value if k not in multi else [] if value is None else [value]
        return out

    def run(batches):
        compiled = {name: (compile_selector(sel) if sel else None,
                           {k: (compile_selector(css) if css else None, attr) for k, (css, attr) in fs.items()},
                           multi)
                    for name, (sel, fs, multi) in specs.items() if sel}
        for pdf in batches:
            rows = []
            for rec in pdf.itertuples(index=False):
                base = dict(zip(keep, rec[:len(keep)]))
                url, html = rec[len(keep)], rec[len(keep) + 1]
                root, failed = None, None
                if html is None:
                    continue
                try:
                    root = parse(html)                       # once per page, for all targets
                except Exception as e:
                    failed = e
                for name, (item_sel, fs, multi) in compiled.items():
                    place = {**base, "target_name": name, "source_url": url}
                    try:
                        if failed is not None:
                            raise failed
                        found = select(root, item_sel)
                    except Exception as e:                   # no items of this target: one error row
                        rows.append({**place, "item_pos": None, "_error": f"page: {type(e).__name__}: {e}"})
                        continue
                    for pos, el in enumerate(found):
                        try:
                            rows.append({**place, "item_pos": pos, "_error": None, **item(el, fs, multi, url)})
                        except Exception as e:
                            rows.append({**place, "item_pos": pos, "_error": f"item: {type(e).__name__}: {e}"})
                        if len(rows) >= OUTPUT_CHUNK_ROWS:   # bound the memory of one output batch
                            yield emit(rows)
                            rows = []
            yield emit(rows)

    return src.mapInPandas(run, schema)


def split_errors(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without ``_error``, rejected rows)."""
    return (items.filter(F.col("_error").isNull()).drop("_error"),
            items.filter(F.col("_error").isNotNull()))


def with_provenance(items: DataFrame, run_id: str, target_name: str) -> DataFrame:
    """E5: provenance columns overwrite same-named fields."""
    return items.withColumns({
        "fetch_time": F.current_timestamp(),
        "run_id": F.lit(run_id),
        "target_name": F.lit(target_name),
    })


def next_links(pages: DataFrame, next_selector: str, *, base_url: str | None = None,
               url_col: str = "url", html_col: str = "html", keep: tuple = ("page_id",)) -> DataFrame:
    """First match's href (or its text when there is no href), resolved against
    ``base_url`` (the page URL when none). The selector may carry ``::attr(x)``
    or ``::text`` (D11)."""
    css, attr = parse_field_selector(next_selector)
    _validate([css])
    keep = tuple(keep)
    keep_ddl = [f"`{k}` {_spark_type(pages.schema[k].dataType)}" for k in keep]
    schema = ", ".join(keep_ddl + ["url string", "next_url string"])
    src = pages.select(*keep, F.col(url_col).alias("_url"), F.col(html_col).alias("_html"))

    def run(batches):
        sel = compile_selector(css)
        for pdf in batches:
            rows = []
            for rec in pdf.itertuples(index=False):
                url, html = rec[len(keep)], rec[len(keep) + 1]
                nxt = None
                if html is not None:
                    try:
                        el = select_one(parse(html), sel)
                        if el is not None:
                            if attr is not None:
                                v = el.get(attr) or None
                            else:
                                v = el.get("href") or el.get_text(strip=True)
                            if v:
                                nxt = urljoin(base_url or url, v)
                    except Exception:
                        nxt = None
                rows.append(list(rec[:len(keep)]) + [url, nxt])
            yield pd.DataFrame(rows, columns=list(keep) + ["url", "next_url"])

    return src.mapInPandas(run, schema)


def pagination_walk(pages: DataFrame, start_urls: DataFrame, next_selector: str, max_pages: int,
                    *, base_url: str | None = None, url_col: str = "url",
                    html_col: str = "html") -> DataFrame:
    """E8 over stored pages: (url, depth) of every stored URL that a walk from a start URL
    reaches by next links, a walk having at most ``max_pages`` pages; depth is the least
    number of links. Of copies of a page whose next links disagree the least link counts.

    Path doubling: jumps of 1, 2, 4, ... links are made by joining the last ones with
    themselves, and each lets all URLs reached so far jump once. A path of d links is the
    sum of the jumps in d's binary form, so a walk of any depth (cycles included) takes
    log2(max_pages) rounds of two joins on distinct URLs. Each round's tables are cut from
    their lineage by a reliable checkpoint (shared checkpoint dir)."""
    from tessera.session import checkpoint_dir
    checkpoint_dir(pages.sparkSession)
    # a row for each URL: copies of one page (a hot URL) collapse in the map-side partial
    # aggregation instead of skewing the joins below
    known = (next_links(pages, next_selector, base_url=base_url, url_col=url_col, html_col=html_col, keep=())
             .groupBy("url").agg(F.min("next_url").alias("to")).where("url IS NOT NULL").checkpoint(eager=True))
    stored = known.select("url")
    jumps = known.where("to IS NOT NULL").join(stored.select(F.col("url").alias("to")), "to", "left_semi").select("url", "to")
    reached = (start_urls.select(F.col("url")).distinct().join(stored, "url", "left_semi")
               .withColumn("depth", F.lit(0)).checkpoint(eager=True))
    step = 1
    while step < max_pages:
        jumps = jumps.checkpoint(eager=True)
        landed = (reached.where(F.col("depth") + step < max_pages).join(jumps, "url")
                  .select(F.col("to").alias("url"), (F.col("depth") + step).alias("depth")))
        reached = reached.unionByName(landed).groupBy("url").agg(F.min("depth").alias("depth")).checkpoint(eager=True)
        deepest = reached.agg(F.max("depth")).first()[0]
        if deepest is None or deepest < step:       # depths have no gaps: nothing lies deeper
            break
        step *= 2
        if step >= max_pages:
            break
        on = jumps.select(F.col("url").alias("to"), F.col("to").alias("then"))
        jumps = jumps.join(on, "to").select("url", F.col("then").alias("to"))
    return reached
