"""Python-style JSON text of Spark values (``json.dumps`` with its default
separators ', ' and ': ' and ``ensure_ascii=False``), built from Catalyst
expressions so CSV cells match the reference's text exactly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.convert import py_double


def _quote(s: Column) -> Column:
    # to_json of a one-element array gives the JSON string literal between brackets
    j = F.to_json(F.array(s))
    return j.substr(F.lit(2), F.length(j) - 2)


def py_json(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        body = _quote(c)
    elif isinstance(dtype, T.BooleanType):
        body = F.when(c, "true").otherwise("false")
    elif isinstance(dtype, (T.IntegralType, T.DecimalType)):
        body = c.cast("string")
    elif isinstance(dtype, T.FractionalType):
        body = F.when(F.isnan(c), "NaN").when(c == float("inf"), "Infinity").when(
            c == float("-inf"), "-Infinity").otherwise(py_double(c.cast("string").cast("double")))
    elif isinstance(dtype, T.ArrayType):
        inner = F.array_join(F.transform(c, lambda x: F.coalesce(py_json(x, dtype.elementType), F.lit("null"))), ", ")
        body = F.concat(F.lit("["), inner, F.lit("]"))
    elif isinstance(dtype, T.MapType):
        entries = F.transform(F.map_entries(c), lambda e: F.concat(
            _quote(e["key"].cast("string")), F.lit(": "),
            F.coalesce(py_json(e["value"], dtype.valueType), F.lit("null"))))
        body = F.concat(F.lit("{"), F.array_join(entries, ", "), F.lit("}"))
    elif isinstance(dtype, T.StructType):
        parts = []
        for i, f in enumerate(dtype.fields):
            if i:
                parts.append(F.lit(", "))
            parts += [F.lit(f'"{f.name}": '), F.coalesce(py_json(c[f.name], f.dataType), F.lit("null"))]
        body = F.concat(F.lit("{"), *parts, F.lit("}")) if parts else F.lit("{}")
    else:
        body = _quote(c.cast("string"))
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(body)
