"""Map/struct builders: U11 merge_maps, U14 redact (columns and map values)."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions._util import col

# Key fragments whose values are redacted (case-insensitive substring
# match), and the replacement text.
SENSITIVE_KEYS = ["password", "token", "secret", "key", "auth", "bot_token", "smtp_password"]
REDACTED = "***REDACTED***"
SENSITIVE_RE = "(?i)(" + "|".join(SENSITIVE_KEYS) + ")"


def is_sensitive(name: str) -> bool:
    return re.search(SENSITIVE_RE, name) is not None


def merge_maps(a, b) -> Column:
    """U11 for two flat maps: keys of both, the later (``b``) value wins."""
    return F.map_zip_with(col(a), col(b), lambda k, x, y: F.coalesce(y, x))


def redact_map(c) -> Column:
    """U14 on a MAP<STRING, *>: values under sensitive keys replaced."""
    return F.transform_values(
        col(c), lambda k, v: F.when(k.rlike(SENSITIVE_RE), F.lit(REDACTED)).otherwise(v.cast("string")))


_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\]:,]|[^\s{}\[\]:,"]+', re.S)


def redacted_json(text: str | None) -> str | None:
    """``text`` with the values under sensitive keys replaced, at every depth and in lists;
    everything else (white space, numbers, escapes, order) stays as it is written. One
    walk over the text's tokens; a text that is no JSON stays whole."""
    if text is None:
        return None
    try:
        json.loads(text)
    except RecursionError:          # JSON too deep for that parser; the walk needs no depth
        pass
    except ValueError:
        return text
    out, at, holders, key, skip = [], 0, [], None, None     # skip: (where the value begins, open brackets in it)
    for m in _TOKEN.finditer(text):
        token = m[0]
        if skip is not None:
            start, depth = skip
            depth += (token in ("{", "[")) - (token in ("}", "]"))
            if depth:
                skip = start, depth
                continue
            out += [text[at:start], json.dumps(REDACTED)]
            at, skip = m.end(), None
        elif token in ("{", "["):
            if key is not None and is_sensitive(key):
                skip = m.start(), 1
            else:
                holders.append(token)
            key = None
        elif token in ("}", "]"):
            holders.pop()
            key = None
        elif token == ":":
            pass
        elif token == ",":
            key = None
        elif holders and holders[-1] == "{" and key is None:
            key = json.loads(token)
        else:
            if key is not None and is_sensitive(key):
                out += [text[at:m.start()], json.dumps(REDACTED)]
                at = m.end()
            key = None
    return "".join(out) + text[at:]


def redact_json(c) -> Column:
    """U14 on a column of JSON text (Arrow batches): see :func:`redacted_json`."""
    def batch(s: pd.Series) -> pd.Series:
        return s.map(redacted_json, na_action="ignore")

    return F.pandas_udf(batch, "string")(col(c).cast("string"))


def _masked(c: Column, dtype: T.DataType) -> Column:
    """A value under a sensitive key, in its own type: texts replaced, all else null."""
    if isinstance(dtype, T.StringType):
        return F.lit(REDACTED)
    if isinstance(dtype, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[_masked(c.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]))
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda x: _masked(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.transform_values(c, lambda k, v: _masked(v, dtype.valueType))
    return F.lit(None).cast(dtype)


_NESTED = (T.StructType, T.ArrayType, T.MapType)


def _redact_value(c: Column, dtype) -> tuple[Column, T.DataType]:
    """A value without its secrets, and the type that it then has."""
    if isinstance(dtype, T.StructType):
        fields, kinds = [], []
        for f in dtype.fields:
            v, kind = (F.lit(REDACTED), T.StringType()) if is_sensitive(f.name) else _redact_value(c.getField(f.name), f.dataType)
            fields.append(v.alias(f.name))
            kinds.append(T.StructField(f.name, kind))
        return F.when(c.isNotNull(), F.struct(*fields)), T.StructType(kinds)
    if isinstance(dtype, T.MapType) and isinstance(dtype.keyType, T.StringType):
        if isinstance(dtype.valueType, _NESTED):        # the values keep their type
            inner = lambda v: _redact_value(v, dtype.valueType)
            kind = inner(c)[1]
            return F.transform_values(c, lambda k, v: F.when(k.rlike(SENSITIVE_RE), _masked(inner(v)[0], kind)).otherwise(inner(v)[0])), T.MapType(
                T.StringType(), kind)
        return redact_map(c), T.MapType(T.StringType(), T.StringType())
    if isinstance(dtype, T.ArrayType):
        kind = _redact_value(c, dtype.elementType)[1] if isinstance(dtype.elementType, _NESTED) else dtype.elementType
        return F.transform(c, lambda x: _redact_value(x, dtype.elementType)[0]), T.ArrayType(kind)
    if isinstance(dtype, T.VariantType):
        return F.parse_json(redact_json(F.to_json(c))), dtype
    return c, dtype


def redact(df: DataFrame, json_cols: tuple[str, ...] = ()) -> DataFrame:
    """U14 on a DataFrame: every column or nested field whose name contains a
    sensitive fragment becomes the redaction text, at every depth, inside arrays, maps and
    VARIANT values; ``json_cols`` names columns that hold JSON text. In a map of structs,
    lists or maps the values keep their type: texts under a sensitive key are replaced, other
    values there become null."""
    out = []
    for f in df.schema.fields:
        if is_sensitive(f.name):
            out.append(F.lit(REDACTED).alias(f.name))
        elif f.name in json_cols:
            out.append(redact_json(F.col(f"`{f.name}`")).alias(f.name))
        else:
            out.append(_redact_value(F.col(f"`{f.name}`"), f.dataType)[0].alias(f.name))
    return df.select(*out)
