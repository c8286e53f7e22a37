"""Cleaning (C1-C12). Stage order as in the reference: missing values -> keyed
de-duplication -> validation -> string cleaning -> empty-row drop.

``clean(df, spec, order_by)`` returns ``(good, rejected)``; both are lazy plans over
the same input, so the whole cleaning is one projection plus the single shuffle of
the de-duplication.
"""

from __future__ import annotations

import functools
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import clean_string
from tessera.operators.chunk import _TASK_BITS
from tessera.operators.dedupe import dedupe_first
from tessera.operators.validate import validate
from tessera.session import scratch_path

EMPTY_DEFAULT = object()


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _is_missing(c: Column, dtype: T.DataType) -> Column:
    """null, or '' for string columns (a numeric column cannot hold '')."""
    if isinstance(dtype, T.StringType):
        return c.isNull() | (c == "")
    return c.isNull()


def required_fields(rules: dict | None) -> list[str]:
    rules = rules or {}
    return [f for f, r in rules.items() if isinstance(r, dict) and r.get("required")]


def drop_missing(df: DataFrame, required: list[str]) -> DataFrame:
    """Drop rows where any required field is null or ''; absent field -> all dropped."""
    if not required:
        return df
    cond = F.lit(True)
    for f in required:
        if f not in df.columns:
            return df.limit(0)
        cond = cond & ~_is_missing(_q(f), df.schema[f].dataType)
    return df.filter(cond)


def _default_literal(value, dtype: T.DataType | None) -> Column:
    if isinstance(value, list):
        elem = dtype.elementType if isinstance(dtype, T.ArrayType) else T.StringType()
        if not value:
            return F.array().cast(T.ArrayType(elem))
        return F.array(*[F.lit(v) for v in value]).cast(T.ArrayType(elem))
    if isinstance(value, dict):
        return F.from_json(F.lit(json.dumps(value)), "map<string,string>")
    lit = F.lit(value)
    return lit if dtype is None else lit.cast(dtype)


def _fits(value, dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StringType):
        return isinstance(value, str)
    if isinstance(dtype, T.ArrayType):
        return isinstance(value, list)
    if isinstance(dtype, T.BooleanType):
        return isinstance(value, bool)
    if isinstance(dtype, (T.IntegralType,)):
        return isinstance(value, int) and not isinstance(value, bool)
    if isinstance(dtype, (T.FractionalType,)):
        return isinstance(value, (int, float)) and not isinstance(value, bool)
    return False


def fill_missing(df: DataFrame, defaults: dict) -> DataFrame:
    """Null, '' (string columns) or absent column -> default; other falsy values
    (0, False, []) kept. A default of another type turns the column into text."""
    cols = {}
    for field, value in defaults.items():
        if field in df.columns:
            dtype = df.schema[field].dataType
            c = _q(field)
            if _fits(value, dtype):
                cols[field] = F.when(_is_missing(c, dtype), _default_literal(value, dtype)).otherwise(c)
            else:
                text = c.cast("string") if not isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)) else F.to_json(c)
                cols[field] = F.when(_is_missing(c, dtype), F.lit(json.dumps(value) if isinstance(value, (list, dict)) else str(value))).otherwise(text)
        else:
            cols[field] = _default_literal(value, None)
    return df.withColumns(cols) if cols else df


def carry_forward(df: DataFrame, fields: list[str], partition_by: list[str], order_by) -> DataFrame:
    """Nulls of ``fields`` become the last value before them in the same key's ``order_by``
    order, as a segmented scan: rows are range-partitioned on (key, order), so that a key
    with any share of the rows spans tasks; within a task the last value is a window over
    that task's rows of the key; the last values of a key's earlier tasks (one row for
    each key and task) give what goes before. Rows and their numbers are written once, as
    another run of the sort could number ties otherwise."""
    spark, keys = df.sparkSession, list(partition_by)
    order = list(order_by) if isinstance(order_by, (list, tuple)) else [order_by]
    by = [*[_q(k) for k in keys], *[_q(c) if isinstance(c, str) else c for c in order]]
    numbered = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_number", F.monotonically_increasing_id())
    path = scratch_path(spark, "carried")
    numbered.write.parquet(path)
    rows = spark.read.schema(numbered.schema).parquet(path).withColumn("_task", F.shiftright("_number", _TASK_BITS))
    here = Window.partitionBy("_task", *[_q(k) for k in keys]).orderBy("_number").rowsBetween(Window.unboundedPreceding, 0)
    ends = rows.groupBy("_task", *[_q(k) for k in keys]).agg(*[
        F.max_by(_q(f), F.when(_q(f).isNotNull(), F.col("_number"))).alias(f"_end_{i}") for i, f in enumerate(fields)])
    before = Window.partitionBy(*[_q(k) for k in keys]).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select(F.col("_task").alias("_t"), *[_q(k).alias(f"_key_{i}") for i, k in enumerate(keys)],
                         *[F.last(f"_end_{i}", ignorenulls=True).over(before).alias(f"_start_{i}") for i in range(len(fields))])
    same = F.col("_task") == F.col("_t")
    for i, k in enumerate(keys):
        same = same & _q(k).eqNullSafe(F.col(f"_key_{i}"))
    filled = rows.withColumns({f"_here_{i}": F.last(_q(f), ignorenulls=True).over(here) for i, f in enumerate(fields)}).join(starts, same)
    found = {f: F.coalesce(f"_here_{i}", f"_start_{i}") for i, f in enumerate(fields)}
    return filled.select(*[found[c].alias(c) if c in found else _q(c) for c in df.columns])


def interpolate_missing(df: DataFrame, defaults: dict, method: str | None = None,
                        partition_by: list[str] | None = None, order_by=None) -> DataFrame:
    """As in the reference, an alias of :func:`fill_missing`. With
    ``method='ffill'`` (extension) a null takes the last non-null value of the same
    partition in ``order_by`` order (see :func:`carry_forward`) before defaults apply."""
    if method == "ffill":
        if not partition_by or order_by is None:
            raise ValueError("ffill needs partition_by and order_by")
        fields = [f for f in defaults if f in df.columns and f not in partition_by]
        if fields:
            df = carry_forward(df, fields, partition_by, order_by)
    return fill_missing(df, defaults)


def handle_missing(df: DataFrame, missing: dict | None, rules: dict | None = None) -> DataFrame:
    """C4: strategy switch drop/default/interpolate; anything else -> unchanged."""
    if not missing:
        return df
    strategy = missing.get("strategy")
    defaults = missing.get("default_values", {}) or {}
    if strategy == "drop":
        return drop_missing(df, required_fields(rules))
    if strategy == "default":
        return fill_missing(df, defaults)
    if strategy == "interpolate":
        return interpolate_missing(df, defaults, missing.get("method"),
                                   missing.get("partition_by"), missing.get("order_by"))
    return df


def clean_strings(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """C7 on every string column and on the string elements of string arrays;
    other types untouched. One projection."""
    out = {}
    for f in df.schema.fields:
        if columns is not None and f.name not in columns:
            continue
        if isinstance(f.dataType, T.StringType):
            out[f.name] = clean_string(_q(f.name))
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType):
            out[f.name] = F.transform(_q(f.name), lambda x: clean_string(x))
    return df.withColumns(out) if out else df


def drop_empty_rows(df: DataFrame, ignore: list[str] | None = None) -> DataFrame:
    """Drop rows whose every (non-ignored) column is null."""
    cols = [c for c in df.columns if c not in (ignore or [])]
    if not cols:
        return df
    cond = _q(cols[0]).isNotNull()
    for c in cols[1:]:
        cond = cond | _q(c).isNotNull()
    return df.filter(cond)


def clean(df: DataFrame, spec: dict, order_by=None, on_checked=None) -> tuple[DataFrame, DataFrame | None]:
    """C11: the cleaning chain. ``spec`` keys: handle_missing, remove_duplicates,
    duplicate_keys, field_validation, clean_before_dedupe, drop_empty_rows.
    Returns (good, rejected-by-validation or None); ``on_checked`` is passed to
    :func:`validate`."""
    rules = spec.get("field_validation") or {}
    df = handle_missing(df, spec.get("handle_missing"), rules)
    if spec.get("clean_before_dedupe"):
        df = clean_strings(df)
    if spec.get("remove_duplicates") and spec.get("duplicate_keys"):
        if order_by is None:
            raise ValueError("first-wins de-duplication needs an explicit order column")
        df = dedupe_first(df, spec["duplicate_keys"], order_by)
    rejected = None
    if rules:
        df, rejected = validate(df, rules, on_checked)
    if not spec.get("clean_before_dedupe"):
        df = clean_strings(df)
    if spec.get("drop_empty_rows"):
        df = drop_empty_rows(df)
    return df, rejected


def cleaning_stats(df: DataFrame, spec: dict, order_by) -> DataFrame:
    """C12 in one pass over the input. Every row is flagged kept (missing-value
    rule) and valid (validation rule) by the same rules as :func:`clean`; with
    de-duplication the rows are grouped by (keys, kept) and each group reports its
    size and whether its first row (``min_by`` on the order) survives. Grouping is a
    hash aggregate with map-side partial aggregation, so a key holding a third of
    the rows is reduced in every map task before the shuffle."""
    rules = spec.get("field_validation") or {}
    missing = spec.get("handle_missing")
    keep = F.lit(True)
    flagged = df
    if missing and missing.get("strategy") == "drop":
        for f in required_fields(rules):
            keep = F.lit(False) if f not in df.columns else keep & ~_is_missing(_q(f), df.schema[f].dataType)
    else:
        flagged = handle_missing(flagged, missing, rules)
    valid = F.lit(True)
    if rules:
        from tessera.operators.validate import error_column
        valid = F.size(error_column(flagged, rules)) == 0
    if spec.get("clean_before_dedupe"):
        cleaned = clean_strings(flagged)            # validation sees cleaned strings as well
        if rules:
            valid = F.size(error_column(cleaned, rules)) == 0
        flagged = cleaned
    if spec.get("drop_empty_rows"):
        valid = valid & functools.reduce(lambda a, b: a | b, [_q(c).isNotNull() for c in flagged.columns])
    flagged = flagged.withColumns({"_keep": keep, "_valid": valid})
    if spec.get("remove_duplicates") and spec.get("duplicate_keys"):
        order = order_by if isinstance(order_by, (list, tuple)) else [order_by]
        order_key = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
        keys = [_q(k) if k in flagged.columns else F.lit(None).cast("string").alias(k)
                for k in spec["duplicate_keys"]]
        groups = flagged.groupBy(*keys, "_keep").agg(
            F.count(F.lit(1)).alias("_n"),
            F.min_by(F.col("_keep") & F.col("_valid"), order_key).alias("_first_ok"))
        agg = groups.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("original_count"),
                         F.count_if("_first_ok").alias("cleaned_count"))
    else:
        agg = flagged.agg(F.count(F.lit(1)).alias("original_count"),
                          F.count_if(F.col("_keep") & F.col("_valid")).alias("cleaned_count"))
    return agg.select(
        F.col("original_count").cast("long").alias("original_count"),
        F.col("cleaned_count").cast("long").alias("cleaned_count"),
        (F.col("original_count") - F.col("cleaned_count")).cast("long").alias("removed_count"),
        F.when(F.col("original_count") > 0,
               (F.col("original_count") - F.col("cleaned_count")) / F.col("original_count"))
         .otherwise(F.lit(0.0)).alias("removal_rate"))
