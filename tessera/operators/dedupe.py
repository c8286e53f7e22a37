"""C5 keyed de-duplication, first row in input order wins.

Plan: one shuffle on the keys. ``row_number() ... = 1`` is planned with a partial
``WindowGroupLimit`` before the exchange, so every map task forwards at most one row
per key: a key holding a third of all rows still sends only one row per map task
across the network, and the final per-key sort sees at most #map-tasks rows for it.
Long text keys are led by a 64-bit hash so the sort compares a fixed-width prefix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORDER_COL = "_row_order"


def with_input_order(df: DataFrame, name: str = ORDER_COL) -> DataFrame:
    """Attach an input-order column. Only meaningful right after a scan: the id is
    (partition, position) which follows file order for a parquet/CSV/JSON read."""
    return df.withColumn(name, F.monotonically_increasing_id())


def _order_cols(order_by) -> list[Column]:
    if isinstance(order_by, (str, Column)):
        order_by = [order_by]
    return [F.col(o) if isinstance(o, str) else o for o in order_by]


def dedupe_first(df: DataFrame, keys: list[str], order_by) -> DataFrame:
    """Keep, for each distinct key tuple (null equals null, an absent key is null),
    the first row by ``order_by``; other columns untouched."""
    present = set(df.columns)
    key_cols = [F.col(k) if k in present else F.lit(None).cast("string") for k in keys]
    long_keys = [F.col(k) for k in keys if k in present
                 and isinstance(df.schema[k].dataType, (T.StringType, T.BinaryType))]
    part = ([F.xxhash64(*long_keys)] if long_keys else []) + key_cols
    w = Window.partitionBy(*part).orderBy(*_order_cols(order_by))
    return (df.withColumn("_dedupe_rn", F.row_number().over(w))
              .filter(F.col("_dedupe_rn") == 1)
              .drop("_dedupe_rn"))
