"""U12 chunk assignment: consecutive groups of ``n`` rows in an explicit order,
restarting per partition key.

A plain ``row_number() OVER (PARTITION BY key ORDER BY ...)`` puts a whole key in one
task, so a key with a third of the rows would be one task. Here the rows are
range-partitioned on (key, order) — a hot key spans many tasks — and sorted there, so
that a row's number within its task is all it needs: its position in its key is that
number, less where the key begins in the task, plus the rows of the key in earlier
tasks. These two come from a table of one row for each key and task that holds it,
which is joined back; no window runs over the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import scratch_path

_TASK_BITS = 33         # monotonically_increasing_id: the task's number above, the row's below


def assign_chunks(df: DataFrame, n: int, order_by: list[str], partition_by: list[str] | None = None,
                  num_partitions: int | None = None, name: str = "chunk_id") -> DataFrame:
    """``df`` plus ``name`` and ``chunk_pos``. The number of tasks follows the data's size
    unless ``num_partitions`` sets it. Rows and their numbers are written once (Parquet,
    shared scratch folder), as another run of the sort could number ties otherwise."""
    if n <= 0:
        raise ValueError("Chunk size must be positive")
    spark, keys, order = df.sparkSession, list(partition_by or []), list(order_by)
    by = [F.col(c) for c in keys + order]
    ranged = df.repartitionByRange(num_partitions, *by) if num_partitions else df.repartitionByRange(*by)
    numbered = ranged.sortWithinPartitions(*by).withColumn("_number", F.monotonically_increasing_id())
    path = scratch_path(spark, "chunks")
    numbered.write.parquet(path)
    rows = spark.read.schema(numbered.schema).parquet(path).withColumn("_task", F.shiftright("_number", _TASK_BITS))
    held = rows.groupBy("_task", *keys).agg(F.count(F.lit(1)).alias("_rows"), F.min("_number").alias("_first"))
    before = Window.partitionBy(*keys).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    # null keys are keys like any other
    starts = starts.select(F.col("_task").alias("_t"), "_first", "_before", *[F.col(k).alias(f"_key_{k}") for k in keys])
    same = F.col("_task") == F.col("_t")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    placed = rows.join(starts, same).withColumn("_pos", F.col("_before") + F.col("_number") - F.col("_first"))
    return (placed.withColumn(name, F.floor(F.col("_pos") / F.lit(n)).cast("long"))
                  .withColumn("chunk_pos", (F.col("_pos") % F.lit(n)).cast("long"))
                  .drop("_number", "_task", "_t", "_first", "_before", "_pos", *[f"_key_{k}" for k in keys]))
