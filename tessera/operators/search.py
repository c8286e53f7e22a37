"""Query operators over stored items (Q1-Q5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cond(df: DataFrame, query: dict) -> Column:
    cond = F.lit(True)
    for k, v in query.items():
        if k not in df.columns:
            return F.lit(False)           # the field must exist
        c = F.col(f"`{k}`")
        cond = cond & (c.isNull() if v is None else c.eqNullSafe(F.lit(v)))
    return cond


def search(df: DataFrame, query: dict, limit: int | None = None, order_by=None) -> DataFrame:
    """Q1: conjunctive equality (None matches an explicit null); optional limit.
    Filters on real columns reach the parquet scan as pushed filters."""
    out = df.filter(_cond(df, query))
    if order_by is not None:
        out = out.orderBy(*([order_by] if not isinstance(order_by, (list, tuple)) else order_by))
    return apply_limit(out, limit)


def filter_by_field(df: DataFrame, field: str, value, limit: int | None = None) -> DataFrame:
    """Q2: Q1 with one key."""
    return search(df, {field: value}, limit)


def apply_limit(df: DataFrame, limit: int | None) -> DataFrame:
    """Q3: a falsy limit (0/None) means all rows."""
    return df.limit(limit) if limit else df


def newest_first(df: DataFrame, ts: str = "created_at", tie: str | None = "id",
                 limit: int | None = None) -> DataFrame:
    """Q4: newest first with a tie-break (D25); with a limit Spark plans a
    TakeOrderedAndProject (per-task top-k, then a k-row merge)."""
    keys = [F.col(ts).desc()] + ([F.col(tie).desc()] if tie else [])
    return apply_limit(df.orderBy(*keys), limit)


def target_filter(df: DataFrame, target: str | None, column: str = "target_name") -> DataFrame:
    """Q5: equality on the target; on a table partitioned by it this prunes folders."""
    return df if target is None else df.filter(F.col(column) == F.lit(target))


def search_json(df: DataFrame, variant_col: str, query: dict, limit: int | None = None) -> DataFrame:
    """Q1 on schema-less rows (one VARIANT column, e.g. from ``read_jsonl`` without a
    schema): every key must exist in the object; ``None`` matches an explicit JSON
    null; other values compare as text."""
    v = F.col(variant_col)
    cond = F.lit(True)
    for k, val in query.items():
        path = "$." + k
        node = F.try_variant_get(v, path, "variant")
        exists = node.isNotNull()
        if val is None:
            cond = cond & exists & F.is_variant_null(node)
        else:
            lit = "true" if val is True else "false" if val is False else str(val)
            cond = cond & exists & (F.try_variant_get(v, path, "string") == F.lit(lit))
    return apply_limit(df.filter(cond), limit)
