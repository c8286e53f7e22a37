"""Declarative run of one target — extract -> clean -> transform -> store.

The whole run is one lazy plan and one action (the sink write, or ``noop`` for a dry
run). Row counts for the run log come from ``DataFrame.observe`` on that same action,
so no extra ``count()`` jobs re-run the plan.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tessera.operators.clean import clean
from tessera.operators.extract import (extract_items, extract_targets, parse_field_selector, split_errors,
                                       with_provenance)
from tessera.operators.htmltree import compile_selector
from tessera.operators.transform import transform
from tessera.operators.validate import ERRORS_COL
from tessera.session import checkpoint_dir
from tessera.sources.batches import BatchStore
from tessera.sources.sinks import SINK_KINDS, write_sink


# The parts of a spec and what they may hold.
SPEC_KEYS = {"name", "extract", "provenance", "order_by", "cleaner", "transformer", "storage"}
EXTRACT_KEYS = {"item_selector", "fields", "keep", "multi"}
CLEANER_KEYS = {"remove_duplicates", "duplicate_keys", "handle_missing", "field_validation", "clean_before_dedupe",
                "drop_empty_rows", "clean_strings"}
TRANSFORMER_KEYS = {"field_mapping", "type_conversions", "row_generators", "custom_functions", "keep_raw"}
STRATEGIES = {"drop", "default", "interpolate"}


def spec_problems(spec: dict) -> list[str]:
    """What is wrong with a spec, before anything runs."""
    out = []

    def known(part: str, keys: set) -> dict:
        value = spec if not part else spec.get(part) or {}
        if not isinstance(value, dict):
            out.append(f"{part} must be a mapping")
            return {}
        out.extend(f"unknown key {part + '.' if part else ''}{k}" for k in value if k not in keys)
        return value

    known("", SPEC_KEYS)
    if not spec.get("name"):
        out.append("name is missing")
    extract = known("extract", EXTRACT_KEYS)
    fields = extract.get("fields")
    if not isinstance(fields, dict) or not fields:
        out.append("extract.fields must name at least one field")
        fields = {}
    for sel in [extract.get("item_selector"), *(parse_field_selector(f)[0] for f in fields.values())]:
        try:
            if sel:
                compile_selector(sel)
        except ValueError as e:
            out.append(f"selector {sel!r}: {e}")
    out.extend(f"extract.multi names no field: {k}" for k in extract.get("multi", ()) if k not in fields)
    cleaner = known("cleaner", CLEANER_KEYS)
    strategy = (cleaner.get("handle_missing") or {}).get("strategy", "default")
    if strategy not in STRATEGIES:
        out.append(f"unknown strategy {strategy!r}")
    known("transformer", TRANSFORMER_KEYS)
    storage = spec.get("storage") or {"type": "noop"}
    if storage.get("type", "noop").lower() not in (*SINK_KINDS, "noop"):
        out.append(f"Unsupported storage type: {storage.get('type')}")
    elif storage.get("type", "noop") != "noop" and not storage.get("path"):
        out.append("storage.path is missing")
    return out


def check_spec(df: DataFrame, spec: dict) -> None:
    """The spec is well formed, and columns that it names exist, before anything runs."""
    out, cols = spec_problems(spec), set(df.columns)
    for what, names in (("duplicate key", (spec.get("cleaner") or {}).get("duplicate_keys") or []),
                        ("order_by column", spec.get("order_by", ["page_id", "item_pos"]))):
        out.extend(f"{what} {k!r} not in {sorted(cols)}" for k in names if k not in cols)
    if out:
        raise ValueError("; ".join(out))


def build_plan(pages: DataFrame, spec: dict, run_id: str,
               observations: dict | None = None, items: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """(result, rejected, errors) DataFrames for one target, all lazy: what passes, the
    rows that validation rejects (None without validation) and the pages and items
    whose extraction failed. With ``observations`` (name -> Observation) the extraction
    and validation steps count their rows inside the same plan ('extract': extracted
    and failed items, 'validate': rejected rows). ``items``: extracted rows at hand."""
    problems = spec_problems(spec)
    if problems:
        raise ValueError("; ".join(problems))
    ex = spec["extract"]
    if items is None:
        items = extract_items(pages, ex.get("item_selector"), ex["fields"],
                              keep=tuple(ex.get("keep", ("page_id",))), multi=tuple(ex.get("multi", ())))
    if observations and "extract" in observations:
        items = items.observe(observations["extract"],
                              F.count_if(F.col("_error").isNull()).alias("scraped"),
                              F.count_if(F.col("_error").isNotNull()).alias("extract_failed"))
    good, errors = split_errors(items)
    if spec.get("provenance", True):
        good = with_provenance(good, run_id, spec["name"])
    check_spec(good, spec)
    order = [F.col(c) for c in spec.get("order_by", ["page_id", "item_pos"])]
    cleaner = spec.get("cleaner") or {}
    on_checked = None
    if observations and "validate" in observations and cleaner.get("field_validation"):
        on_checked = lambda df: df.observe(
            observations["validate"], F.count_if(F.size(ERRORS_COL) > 0).alias("rejected"))
    cleaned, rejected = clean(good, cleaner, order_by=order, on_checked=on_checked)
    result = transform(cleaned, spec.get("transformer") or {})
    return result, rejected, errors


def failures(rejected: DataFrame | None, errors: DataFrame, target_name: str, keep: tuple = ("page_id",)) -> DataFrame:
    """Rejected rows and extraction errors as one log: target_name, ``keep``, source_url,
    item_pos, stage ('extract' or 'validate') and reason."""
    place = [F.lit(target_name).alias("target_name"), *keep, "source_url", "item_pos"]
    out = errors.select(*place, F.lit("extract").alias("stage"), F.col("_error").alias("reason"))
    if rejected is not None:
        out = out.unionByName(rejected.select(*place, F.lit("validate").alias("stage"), F.array_join(ERRORS_COL, ",").alias("reason")))
    return out


def plan_only(pages: DataFrame, spec: dict, run_id: str = "dry-run") -> DataFrame:
    """The result DataFrame of a dry run (nothing written)."""
    return build_plan(pages, spec, run_id)[0]


def run_target(pages: DataFrame, spec: dict, run_id: str | None = None,
               dry_run: bool = False) -> tuple[DataFrame, dict]:
    """Execute one run; returns (result DataFrame, run-log record). One action: the
    sink write (``noop`` for a dry run). Scraped, failed (extraction errors and
    validation rejects, A4) and processed counts are observed during that action.
    ``storage`` takes the sink's own options; CSV and JSONL append to what earlier runs
    have written unless it says ``mode: overwrite``."""
    run_id = run_id or f"run_{uuid.uuid4().hex[:12]}"
    start = time.time()
    obs = {"extract": Observation(f"extract_{run_id}"), "out": Observation(f"out_{run_id}")}
    if (spec.get("cleaner") or {}).get("field_validation"):
        obs["validate"] = Observation(f"validate_{run_id}")
    storage = dict(spec.get("storage") or {"type": "noop"})
    kind = "noop" if dry_run else str(storage.pop("type", "noop")).lower()
    storage.pop("type", None)
    path = storage.pop("path", "")
    if kind in ("csv", "jsonl"):
        storage.setdefault("mode", "append")
    result, status, err = None, "success", None
    try:
        result, _, _ = build_plan(pages, spec, run_id, obs)
        write_sink(result.observe(obs["out"], F.count(F.lit(1)).alias("processed")), kind, path, **({} if kind == "noop" else storage))
    except Exception as e:  # failure record, never re-raised (reference contract)
        status, err = "failed", f"{type(e).__name__}: {e}"
    m = {}
    if status == "success":
        for o in obs.values():
            m.update(o.get)
    processed = int(m.get("processed", 0))
    record = {
        "run_id": run_id, "target_name": spec.get("name"), "status": status,
        "duration_s": round(time.time() - start, 3),
        "scraped_count": int(m.get("scraped", 0)),
        "failed_count": int(m.get("extract_failed", 0)) + int(m.get("rejected", 0)),
        "processed_count": processed,
        "saved_count": 0 if kind == "noop" or status != "success" else processed,
        "output_path": None if kind == "noop" else path, "dry_run": dry_run, "error": err,
    }
    return result, record


RUN_LOG_DDL = ("run_id string, target_name string, status string, duration_s double, scraped_count long, "
               "failed_count long, processed_count long, saved_count long, output_path string, dry_run boolean, "
               "error string, finished_at timestamp")


def append_run_log(spark, records: list[dict], path: str) -> None:
    """One ``run_log`` row per run, appended (the metrics in
    ``tessera.operators.metrics`` aggregate this table)."""
    import datetime as _dt
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    rows = [{**r, "finished_at": r.get("finished_at", now)} for r in records]
    cols = [c.split()[0] for c in RUN_LOG_DDL.split(", ")]
    spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], RUN_LOG_DDL) \
        .write.mode("append").parquet(path)


def _all_items(pages: DataFrame, specs: list[dict], keep: tuple) -> DataFrame:
    """Extracted rows of all targets, errors included; every page is parsed once and the
    rows are materialised once (reliable checkpoint)."""
    checkpoint_dir(pages.sparkSession)
    targets = {s["name"]: {"item_selector": s["extract"].get("item_selector"),
                           "fields": s["extract"]["fields"], "multi": s["extract"].get("multi", ())}
               for s in specs}
    return extract_targets(pages, targets, keep=keep).checkpoint(eager=True)


def run_all_targets(pages: DataFrame, specs: list[dict], run_id: str = "all",
                    keep: tuple = ("page_id",)) -> tuple[DataFrame, DataFrame]:
    """The same run for several targets: (results, failures). Results are
    stacked by name with a ``target_name`` column (missing columns null); failures are
    the log of :func:`failures` for all targets. A target whose spec is wrong doesn't
    stop the others: it has one failure row of stage 'spec'. Per-target statistics are a
    ``groupBy('target_name')`` of either."""
    sound = [s for s in specs if not spec_problems(s)]
    items = _all_items(pages, sound, keep) if sound else None
    out, log = None, None
    log_schema = None
    for spec in sound:
        cols = [*keep, "source_url", "item_pos", *spec["extract"]["fields"], "_error"]
        own = items.filter(F.col("target_name") == spec["name"]).select(*cols)
        part, rejected, errors = build_plan(pages, spec, run_id, items=own)
        failed = failures(rejected, errors, spec["name"], keep)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
        log = failed if log is None else log.unionByName(failed)
        log_schema = log.schema
    wrong = [(s.get("name"), "; ".join(spec_problems(s))) for s in specs if spec_problems(s)]
    if wrong and log is not None:
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in log_schema.fields if f.name not in ("target_name", "stage", "reason")]
        log = log.unionByName(pages.sparkSession.createDataFrame(wrong, "target_name string, reason string").select(
            "target_name", *nothing, F.lit("spec").alias("stage"), "reason"))
    if out is None:
        raise ValueError("; ".join(f"{n}: {r}" for n, r in wrong) or "no targets")
    return out, log


def _log_of_run(run_id: str, specs: list[dict], store: BatchStore, seconds: Callable[[], float]) -> Callable[[dict], DataFrame]:
    """The run log's rows, one for each target, counted from the outputs as they were stored."""
    def made(written: dict[str, DataFrame]) -> DataFrame:
        counted = None
        for name, column in (("extracted", "scraped_count"), ("errors", "failed_count"), ("rejected", "failed_count"), ("results", "processed_count")):
            part = written[name].groupBy("target_name").agg(F.count(F.lit(1)).alias("n")).withColumn("what", F.lit(column))
            counted = part if counted is None else counted.unionByName(part)
        kinds = ("scraped_count", "failed_count", "processed_count")
        wide = counted.groupBy("target_name").agg(*[F.sum(F.when(F.col("what") == k, F.col("n"))).alias(k) for k in kinds])
        known = [(s.get("name"), "; ".join(spec_problems(s)) or None) for s in specs]
        every = written["results"].sparkSession.createDataFrame(known, "target_name string, error string")
        count = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
        return every.join(wide, "target_name", "left").select(
            F.lit(run_id).alias("run_id"), "target_name", F.when(F.col("error").isNull(), "success").otherwise("failed").alias("status"),
            F.lit(round(seconds(), 3)).alias("duration_s"), *[count(k).alias(k) for k in kinds], count("processed_count").alias("saved_count"),
            F.lit(store.path).alias("output_path"), F.lit(False).alias("dry_run"), "error",
            F.current_timestamp().alias("finished_at"))

    return made


def run_outputs(pages: DataFrame, specs: list[dict], store: BatchStore, run_id: str | None = None,
                keep: tuple = ("page_id",), key: str | None = None) -> bool:
    """Run several targets and store all that comes of it as one batch: ``results``
    (stacked by name), ``rejected`` (rows that validation rejects, as JSON text, with the
    reasons), ``errors`` (pages and items whose extraction failed, and targets whose spec is
    wrong) and ``run_log`` (a row for each target, as ``append_run_log`` stores them).

    Pages are parsed once. All four become visible together; a run that fails half-way
    leaves none, and ``key`` (``run_id`` unless given) is stored once however often it is
    given. Returns whether this call stored it."""
    spark, run_id = pages.sparkSession, run_id or f"run_{uuid.uuid4().hex[:12]}"
    key = key or run_id
    if store.manifests.has(key):
        return False
    start = time.time()
    wrong = [(s.get("name"), "; ".join(spec_problems(s))) for s in specs if spec_problems(s)]
    sound = [s for s in specs if not spec_problems(s)]
    if not sound:
        raise ValueError("; ".join(f"{n}: {r}" for n, r in wrong) or "no targets")
    items = _all_items(pages, sound, keep)
    place = [*keep, "source_url", "item_pos"]
    results = rejects = errors = None
    for spec in sound:
        own = items.filter(F.col("target_name") == spec["name"]).select(*place, *spec["extract"]["fields"], "_error")
        good, rejected, failed = build_plan(pages, spec, run_id, items=own)
        failed = failed.select(F.lit(spec["name"]).alias("target_name"), *place, F.col("_error").alias("reason"))
        results = good if results is None else results.unionByName(good, allowMissingColumns=True)
        errors = failed if errors is None else errors.unionByName(failed)
        if rejected is not None:
            row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rejected.columns if c != ERRORS_COL]), {"ignoreNullFields": "false"})
            part = rejected.select(F.lit(spec["name"]).alias("target_name"), *place, F.array_join(ERRORS_COL, ",").alias("reason"), row.alias("data"))
            rejects = part if rejects is None else rejects.unionByName(part)
    nothing = lambda df, own: [F.lit(None).cast(df.schema[c].dataType).alias(c) for c in place if c not in own]
    if rejects is None:
        rejects = errors.where("false").withColumn("data", F.lit(None).cast("string"))
    if wrong:
        errors = errors.unionByName(spark.createDataFrame(wrong, "target_name string, reason string").select(
            "target_name", *nothing(errors, ()), "reason"))
    extracted = items.where("_error IS NULL").select("target_name", *place)
    return store.commit(key, {"extracted": extracted, "results": results, "rejected": rejects, "errors": errors,
                              "run_log": _log_of_run(run_id, specs, store, lambda: time.time() - start)})
