"""U6 format_file_size."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions._util import col

# Unit names in 1024 steps.
UNITS = ["B", "KB", "MB", "GB", "TB"]


def format_file_size(c) -> Column:
    """0 -> '0B'; otherwise divide by 1024 while >= 1024 (up to TB) and print one
    decimal, half to even as Python's float formatting does."""
    n = col(c).cast("long")
    div, unit = F.lit(1), F.lit(UNITS[0])
    for i in range(1, len(UNITS)):
        div = F.when(n >= F.lit(1024 ** i), F.lit(1024 ** i)).otherwise(div)
        unit = F.when(n >= F.lit(1024 ** i), F.lit(UNITS[i])).otherwise(unit)
    text = F.concat(F.format_string("%.1f", F.bround(n / div, 1)), unit)
    return F.when(n.isNull(), F.lit(None).cast("string")).when(n == 0, F.lit("0B")).otherwise(text)
