"""C6 field validation (intended behaviour: bad rows are rejected, good rows kept
with every column, including undeclared ones) and A13 failure counting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.convert import is_float_text
from tessera.functions.text import WS, strip_ws

ERRORS_COL = "_errors"

INT_CORE = r"[+-]?[0-9]+(?:_[0-9]+)*"
INT_RE = rf"\A[{WS}]*{INT_CORE}[{WS}]*\z"
# Strings the validator accepts as booleans (any case).
BOOL_WORDS = ["0", "off", "f", "false", "n", "no", "1", "on", "t", "true", "y", "yes"]
ISO_DATETIME_RE = (r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?"
                   r"(Z|[+-][0-9]{2}:?[0-9]{2})?)?\z")


def _coercible(c: Column, dtype: T.DataType, type_name: str) -> Column:
    """True when the value can be coerced to the declared type (null -> True)."""
    t = type_name.lower()
    is_str = isinstance(dtype, T.StringType)
    if t == "int":
        if is_str:
            return strip_ws(c).rlike(f"^{INT_CORE}$")
        return F.lit(isinstance(dtype, (T.NumericType, T.BooleanType)))
    if t == "float":
        if is_str:
            return is_float_text(c)
        return F.lit(isinstance(dtype, (T.NumericType, T.BooleanType)))
    if t == "bool":
        if is_str:
            return F.lower(c).isin(*BOOL_WORDS)
        if isinstance(dtype, T.BooleanType):
            return F.lit(True)
        if isinstance(dtype, T.NumericType):
            return c.isin(0, 1)
        return F.lit(False)
    if t == "array":
        return F.lit(isinstance(dtype, T.ArrayType))
    if t == "dict":
        return F.lit(isinstance(dtype, (T.MapType, T.StructType)))
    if t == "datetime":
        if is_str:
            return c.rlike(ISO_DATETIME_RE)
        return F.lit(isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType, T.NumericType)))
    # "string" and unknown names (validated as str)
    return F.lit(isinstance(dtype, (T.StringType, T.NumericType)))


def error_column(df: DataFrame, rules: dict) -> Column:
    """ARRAY<STRING> of 'field:reason' for every failed rule of the row."""
    checks = []
    for field, rule in rules.items():
        rule = rule if isinstance(rule, dict) else {"type": rule}
        type_name = rule.get("type", "string")
        required = rule.get("required", False)
        if field not in df.columns:
            if required:
                checks.append(F.lit(f"{field}:missing"))
            continue
        c = F.col(f"`{field}`")
        dtype = df.schema[field].dataType
        if required:
            checks.append(F.when(c.isNull(), F.lit(f"{field}:missing")))
        checks.append(F.when(c.isNotNull() & ~_coercible(c, dtype, type_name),
                             F.lit(f"{field}:type_{type_name.lower()}")))
    if not checks:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*checks))


def with_errors(df: DataFrame, rules: dict) -> DataFrame:
    return df.withColumn(ERRORS_COL, error_column(df, rules))


def validate(df: DataFrame, rules: dict, on_checked=None) -> tuple[DataFrame, DataFrame]:
    """(valid rows without the error column, rejected rows with it).
    ``on_checked`` may wrap the checked rows before the split (e.g. an ``observe``
    counting rejects in the same pass as the write of the valid rows)."""
    checked = with_errors(df, rules)
    if on_checked is not None:
        checked = on_checked(checked)
    valid = checked.filter(F.size(ERRORS_COL) == 0).drop(ERRORS_COL)
    rejected = checked.filter(F.size(ERRORS_COL) > 0)
    return valid, rejected


def error_counts(df: DataFrame, rules: dict) -> DataFrame:
    """Failures per (field, reason), plus the number of rejected rows under
    field '*' — one pass, partial aggregation before the shuffle."""
    checked = with_errors(df, rules).select(ERRORS_COL).filter(F.size(ERRORS_COL) > 0)
    tagged = F.concat(F.col(ERRORS_COL), F.array(F.lit("*:rejected_rows")))
    return (checked.select(F.explode(tagged).alias("e"))
            .select(F.split_part("e", F.lit(":"), F.lit(1)).alias("field"),
                    F.split_part("e", F.lit(":"), F.lit(2)).alias("reason"))
            .groupBy("field", "reason").agg(F.count(F.lit(1)).alias("failures")))
