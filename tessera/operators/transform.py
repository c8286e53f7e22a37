"""Transformation (T1, T10-T15): rename, lenient conversion, computed columns,
expression evaluation, statistics and the function registry.

Order: map -> convert -> computed columns. Each stage is one projection built on the
driver from the schema, never a chain of ``withColumn`` calls.
"""

from __future__ import annotations

import contextlib
import threading
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.convert import convert
from tessera.operators import computed

RAW_COL = "_raw"
# conversions that cannot fail (str() and truthiness), so no raw value is tracked
NEVER_FAILS = {"string", "bool"}
CONV_ERRORS_COL = "_conv_errors"


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def apply_field_mapping(df: DataFrame, mapping: dict[str, str] | None) -> DataFrame:
    """Mapped fields first in mapping order, then unmapped fields in input order.
    Absent old names are ignored; two old names onto one new name: the last wins;
    a new name equal to an unmapped field: the unmapped value wins."""
    if not mapping:
        return df
    out: dict[str, Column] = {}
    for old, new in mapping.items():
        if old in df.columns:
            out[new] = _q(old)
    for c in df.columns:
        if c not in mapping:
            out[c] = _q(c)
    return df.select(*[c.alias(n) for n, c in out.items()])


def convert_types(df: DataFrame, conversions: dict[str, str] | None,
                  keep_raw: bool | str = True) -> DataFrame:
    """Convert each named column; unknown type names leave it as is.
    A value whose conversion fails becomes null and, with ``keep_raw``, its original
    text is kept in ``_raw[field]`` and the field listed in ``_conv_errors``.
    ``keep_raw='variant'`` instead keeps the value in place: each converted column
    becomes VARIANT holding the converted value, or the original where it failed.

    Two projections: the typed values are computed once (code-generated), the
    bookkeeping columns then only read column references."""
    if not conversions:
        return df
    if keep_raw == "variant":
        cols = {}
        for field, type_name in conversions.items():
            if field not in df.columns:
                continue
            c = _q(field)
            typed = convert(c, type_name, df.schema[field].dataType)
            if typed is not None:
                cols[field] = F.when(c.isNotNull() & typed.isNull(), c.cast("variant")).otherwise(
                    typed.cast("variant"))
        return df.withColumns(cols)
    typed_cols: dict[str, Column] = {}
    tracked: list[tuple[str, str, Column]] = []
    for i, (field, type_name) in enumerate(conversions.items()):
        if field not in df.columns:
            continue
        dtype = df.schema[field].dataType
        c = _q(field)
        typed = convert(c, type_name, dtype)
        if typed is None:
            continue
        if not keep_raw or type_name.lower() in NEVER_FAILS:
            typed_cols[field] = typed
            continue
        tmp = f"__typed_{i}"
        typed_cols[tmp] = typed
        raw = F.to_json(c) if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)) else c.cast("string")
        tracked.append((field, tmp, raw))
    if not tracked:
        return df.withColumns(typed_cols)
    step = df.withColumns(typed_cols)
    bad = {f: _q(f).isNotNull() & F.col(tmp).isNull() for f, tmp, _ in tracked}
    raw_map = F.map_filter(
        F.create_map(*[x for f, _, raw in tracked for x in (F.lit(f), F.when(bad[f], raw))]),
        lambda k, v: v.isNotNull())
    errs = F.array_compact(F.array(*[F.when(bad[f], F.lit(f)) for f, _, _ in tracked]))
    out = step.withColumns({RAW_COL: raw_map, CONV_ERRORS_COL: errs})
    out = out.withColumns({f: F.col(tmp) for f, tmp, _ in tracked})
    return out.drop(*[tmp for _, tmp, _ in tracked])


class FunctionRegistry:
    """Named computed-column functions. A function is a SQL expression string,
    a Column, or a callable ``df -> Column``; opaque Python goes through
    :meth:`register_pandas_udf` so it runs Arrow-batched."""

    def __init__(self, functions: dict | None = None):
        self._fns: dict = dict(functions or {})

    def add(self, name: str, fn) -> None:
        self._fns[name] = fn

    def remove(self, name: str) -> None:
        self._fns.pop(name, None)

    def names(self) -> list[str]:
        return list(self._fns)

    def get(self, name: str):
        return self._fns[name]

    def items(self):
        return self._fns.items()

    @staticmethod
    def register_pandas_udf(spark, name: str, fn: Callable, return_type) -> Callable:
        """``fn`` (pandas Series -> Series) as the SQL function ``name`` of any spec."""
        udf = F.pandas_udf(fn, return_type)
        spark.udf.register(name, udf)
        return udf

    @staticmethod
    def register_generator(spark, name: str, handler: type, return_type) -> None:
        """A row generator: a class whose ``eval`` yields rows, run Arrow-batched as the SQL
        table function ``name``, for ``row_generators`` of any spec."""
        spark.udtf.register(name, F.udtf(handler, returnType=return_type, useArrow=True))

    @staticmethod
    def unregister(spark, name: str) -> None:
        """Forget a registered function or generator; a spec that names it then fails."""
        spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS `{name}`")


def _resolve(df: DataFrame, fn) -> Column:
    if isinstance(fn, Column):
        return fn
    if isinstance(fn, str):
        if fn in computed.BUILDERS:
            return computed.BUILDERS[fn](df=df) if fn != "processed_at" else computed.processed_at()
        return F.expr(fn)
    return fn(df)


_resolving = threading.RLock()


@contextlib.contextmanager
def null_on_error(df: DataFrame):
    """Expressions resolved within give null where they fail (division by zero, a text
    that is no number, an index out of bounds) instead of ending the job: whether an
    operation raises is settled when it is resolved. Whole numbers beyond 64 bits wrap.
    The setting is the session's, so one thread at a time resolves expressions this way."""
    conf, key = df.sparkSession.conf, "spark.sql.ansi.enabled"
    with _resolving:
        before = conf.get(key)
        conf.set(key, "false")
        try:
            yield
        finally:
            conf.set(key, before)


def add_computed_columns(df: DataFrame, functions) -> DataFrame:
    """Every function sees the same input row (not each other's output); a
    result may overwrite an existing column; a failing one is null in that row. One
    projection."""
    if not functions:
        return df
    items = functions.items() if hasattr(functions, "items") else functions
    with null_on_error(df):
        return df.withColumns({name: _resolve(df, fn) for name, fn in items})


def evaluate_expression(df: DataFrame, expr: str, name: str = "result") -> DataFrame:
    """A SQL expression over the row's columns; null where it fails."""
    with null_on_error(df):
        return df.withColumn(name, F.expr(expr))


def generate_rows(df: DataFrame, call: str) -> DataFrame:
    """Each row beside every row that a registered table function yields for it, such as
    ``"lines_of(text)"``; a row without any is dropped."""
    return df.sparkSession.sql(f"SELECT _rows.*, _made.* FROM {{df}} AS _rows, LATERAL {call} AS _made", df=df)


def transform(df: DataFrame, spec: dict, registry: FunctionRegistry | None = None) -> DataFrame:
    """Mapping -> conversion -> row generators -> computed columns (spec
    ``custom_functions`` plus every function in the registry, D5)."""
    df = apply_field_mapping(df, spec.get("field_mapping"))
    df = convert_types(df, spec.get("type_conversions"), spec.get("keep_raw", True))
    for call in spec.get("row_generators") or ():
        df = generate_rows(df, call)
    fns = dict(spec.get("custom_functions") or {})
    if registry is not None:
        fns.update(dict(registry.items()))
    return add_computed_columns(df, fns)


def transform_stats(original: DataFrame, transformed: DataFrame) -> DataFrame:
    """Row counts (one aggregate each, no collect) and field-set algebra on
    the two schemas."""
    of, tf = set(original.columns), set(transformed.columns)
    tagged = (original.select(F.lit(1).alias("_o"), F.lit(0).alias("_t"))
              .unionByName(transformed.select(F.lit(0).alias("_o"), F.lit(1).alias("_t"))))
    arr = lambda xs: F.array(*[F.lit(x) for x in sorted(xs)]).cast("array<string>")
    return tagged.agg(F.sum("_o").alias("o"), F.sum("_t").alias("t")).select(
        F.coalesce(F.col("o"), F.lit(0)).cast("long").alias("original_count"),
        F.coalesce(F.col("t"), F.lit(0)).cast("long").alias("transformed_count"),
        F.lit(len(of)).cast("long").alias("original_field_count"),
        F.lit(len(tf)).cast("long").alias("transformed_field_count"),
        F.array_join(arr(tf - of), ",").alias("added_fields"),
        F.array_join(arr(of - tf), ",").alias("removed_fields"),
        F.array_join(arr(of & tf), ",").alias("common_fields"))


def variant_stats(original: DataFrame, transformed: DataFrame, column: str = "value") -> DataFrame:
    """T13 for records without a schema (one VARIANT column): fields are the union over the
    rows, as rows may hold different ones. Keys are aggregated on the map side, one row for
    each field leaves a task; rows that are no objects have no fields."""
    def fields(df: DataFrame, mark: str) -> DataFrame:
        keys = F.map_keys(F.try_variant_get(column, "$", "map<string,variant>"))
        return df.select(F.explode(keys).alias("field")).distinct().select("field", *[F.lit(mark == m).alias(m) for m in ("_o", "_t")])

    def count(df: DataFrame, mark: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(*[(F.col("n") if mark == m else F.lit(None).cast("long")).alias(f"n{m}") for m in ("_o", "_t")])

    both = fields(original, "_o").unionByName(fields(transformed, "_t")).groupBy("field").agg(F.max("_o").alias("_o"), F.max("_t").alias("_t"))
    every = (both.unionByName(count(original, "_o"), allowMissingColumns=True).unionByName(count(transformed, "_t"), allowMissingColumns=True))
    names = lambda cond: F.array_join(F.array_sort(F.collect_list(F.when(cond, F.col("field")))), ",")
    o, t = F.coalesce("_o", F.lit(False)), F.coalesce("_t", F.lit(False))
    return every.agg(
        F.max("n_o").alias("original_count"), F.max("n_t").alias("transformed_count"),
        F.count_if(o).cast("long").alias("original_field_count"), F.count_if(t).cast("long").alias("transformed_field_count"),
        names(t & ~o).alias("added_fields"), names(o & ~t).alias("removed_fields"), names(o & t).alias("common_fields"))
