"""Lenient type conversion (T2-T9): one builder per target type name.

Each builder returns a typed Column that is null where the reference's conversion
raises; ``tessera.operators.transform.convert_types`` keeps the original text of
such values (T10).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions._util import col
from tessera.functions.dates import to_datetime
from tessera.functions.text import WS, strip_ws

# Python float() syntax for finite numbers (digits may be grouped by '_'); Java-only
# forms such as "1.0d" or "0x1p3" fail it. FLOAT_RE allows surrounding whitespace
# (used by the oracle); the Spark side strips first and matches FLOAT_CORE.
_DIGITS = r"[0-9]+(?:_[0-9]+)*"
FLOAT_CORE = rf"[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
FLOAT_RE = rf"\A[{WS}]*{FLOAT_CORE}[{WS}]*\z"
# Python float() also accepts these words (any case, optional sign).
NONFINITE_RE = rf"(?i)\A[{WS}]*([+-]?)(inf|infinity|nan)[{WS}]*\z"
NONFINITE_WORDS = [s + w for s in ("", "+", "-") for w in ("inf", "infinity", "nan")]

# Strings that convert to True (compared after lower-casing).
TRUE_WORDS = ["true", "1", "yes", "on"]


def py_double(c) -> Column:
    """A double as Python's ``str`` prints it: plain digits from 1e-4 up to 1e16,
    otherwise an exponent of at least two digits; nan, inf, -inf."""
    v = col(c).cast("double")
    s = v.cast("string")
    sign = F.when(s.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    shape = r"^-?([0-9])\.([0-9]+)E(-?[0-9]+)$"
    digits = F.concat(F.regexp_extract(s, shape, 1), F.regexp_replace(F.regexp_extract(s, shape, 2), "^0$", ""))
    exp = F.regexp_extract(s, shape, 3).try_cast("int")
    whole = F.rpad(digits, exp + 1, "0")
    part = F.substring(digits, exp + 2, F.lit(20))
    plain = F.concat(sign, whole, F.lit("."), F.when(part == "", "0").otherwise(part))
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -exp - 1), digits)
    rest = F.substring(digits, 2, 20)
    sci = F.concat(sign, F.substring(digits, 1, 1), F.when(rest == "", "").otherwise(F.concat(F.lit("."), rest)), F.lit("e"),
                   F.when(exp < 0, "-").otherwise("+"), F.lpad(F.abs(exp).cast("string"), F.greatest(F.lit(2), F.length(F.abs(exp).cast("string"))), "0"))
    return (F.when(v.isNull(), F.lit(None).cast("string")).when(F.isnan(v), "nan")
            .when(F.abs(v) == float("inf"), F.concat(sign, F.lit("inf")))
            .when(~F.contains(s, F.lit("E")), s).when(exp.between(0, 15), plain).when(exp.between(-4, -1), small).otherwise(sci))


def _one_json(v: Column) -> Column:
    """The whole text is one JSON value. Parsers stop after the first one and pass over
    what follows, so the text is put into an array with one more element: only a single
    value makes it an array of two."""
    return F.coalesce(F.json_array_length(F.concat(F.lit("["), v, F.lit(",1]"))) == 2, F.lit(False))


def _is_string(dtype) -> bool:
    return isinstance(dtype, T.StringType)


def is_float_text(v: Column) -> Column:
    """Would Python's float() accept the string (finite or inf/nan words)?"""
    t = strip_ws(v)
    return t.rlike(f"^{FLOAT_CORE}$") | F.lower(t).isin(*NONFINITE_WORDS)


def _str_to_double(v: Column) -> Column:
    t = strip_ws(v)
    word = F.lower(t)
    special = (F.when(F.contains(word, F.lit("nan")), F.lit(float("nan")))
               .when(t.startswith("-"), F.lit(float("-inf")))
               .otherwise(F.lit(float("inf"))))
    finite = F.regexp_replace(t, "_", "").try_cast("double")
    return (F.when(t.rlike(f"^{FLOAT_CORE}$"), finite)
             .when(word.isin(*NONFINITE_WORDS), special))


def to_string(c, dtype=None) -> Column:
    """``str(v)``. Booleans print as True/False; complex values as JSON."""
    v = col(c)
    if isinstance(dtype, T.BooleanType):
        return F.when(v.isNull(), F.lit(None).cast("string")).when(v, "True").otherwise("False")
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(v)
    if isinstance(dtype, T.DoubleType):
        return py_double(v)
    return v.cast("string")


def to_int(c, dtype=None) -> Column:
    """Strings through float then truncation toward zero; numbers truncated."""
    v = col(c)
    if dtype is None or _is_string(dtype):
        t = strip_ws(v)
        d = F.when(t.rlike(f"^{FLOAT_CORE}$"), F.regexp_replace(t, "_", "").try_cast("double"))
        return d.try_cast("long")
    if isinstance(dtype, T.BooleanType):
        return v.cast("long")
    return v.try_cast("long")


def to_float(c, dtype=None) -> Column:
    """T4: ``float(v)``; inf/nan words accepted as Python does."""
    v = col(c)
    if dtype is None or _is_string(dtype):
        return _str_to_double(v)
    return v.cast("double")


def to_bool(c, dtype=None) -> Column:
    """T5: strings are true iff lower-case in TRUE_WORDS (never an error, no trim);
    numbers by non-zero, arrays/maps by non-empty."""
    v = col(c)
    if dtype is None or _is_string(dtype):
        return F.lower(v).isin(*TRUE_WORDS)
    if isinstance(dtype, T.BooleanType):
        return v
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return F.size(v) > 0
    return v != 0


def to_array(c, dtype=None) -> Column:
    """A JSON list string -> its elements; any other string -> split on ',' with
    each piece stripped; arrays stay; other scalars -> one-element array."""
    v = col(c)
    if dtype is None or _is_string(dtype):
        t = strip_ws(v)
        looks_list = t.startswith("[") & t.endswith("]")
        parsed = F.when(looks_list & _one_json(v), F.from_json(v, "array<string>"))
        pieces = F.transform(F.split(v, ",", -1), lambda x: strip_ws(x))
        return F.when(v.isNull(), F.lit(None).cast("array<string>")).otherwise(
            F.coalesce(parsed, pieces))
    if isinstance(dtype, T.ArrayType):
        return v
    return F.when(v.isNull(), F.lit(None)).otherwise(F.array(v.cast("string")))


def to_dict(c, dtype=None) -> Column:
    """A JSON object string -> MAP<STRING,STRING>; other strings fail (null);
    maps stay; other scalars -> {'value': v}."""
    v = col(c)
    if dtype is None or _is_string(dtype):
        t = strip_ws(v)
        return F.when(t.startswith("{") & t.endswith("}") & _one_json(v),
                      F.from_json(v, "map<string,string>"))
    if isinstance(dtype, T.MapType):
        return v
    if isinstance(dtype, T.StructType):
        return F.from_json(F.to_json(v), "map<string,string>")
    return F.when(v.isNull(), F.lit(None)).otherwise(
        F.create_map(F.lit("value"), v.cast("string")))


def to_datetime_value(c, dtype=None) -> Column:
    """Strings parsed by the five conversion formats; other types unchanged."""
    v = col(c)
    if dtype is None or _is_string(dtype):
        return to_datetime(v)
    return v


CONVERTERS = {
    "string": to_string,
    "int": to_int,
    "float": to_float,
    "bool": to_bool,
    "array": to_array,
    "dict": to_dict,
    "datetime": to_datetime_value,
}


def convert(c, type_name: str, dtype=None) -> Column | None:
    """Dispatch by (case-insensitive) type name; unknown names -> None (T9: leave as is)."""
    fn = CONVERTERS.get(type_name.lower())
    return None if fn is None else fn(c, dtype)
