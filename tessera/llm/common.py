"""Shared helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.session import scratch_path

#: Bytes of text that one Python step holds beside its results.
SLICE_BYTES = 4 << 20


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation, and values
    such as monotonically_increasing_id() stay what they were.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._written_to = path
    return back


def discard(*frames: DataFrame) -> None:
    """Delete what ``written`` has stored, once nothing is computed from it any more, and
    let go of shuffle files that finished steps have left."""
    for df in frames:
        remove(df.sparkSession, df._written_to)
    release(frames[0].sparkSession)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder in whatever file system holds it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def bucket_count(spark: SparkSession, buckets: int | None) -> int:
    """Buckets of a new table: as many as shuffles have partitions, unless given, so that
    each task of a shuffle by the bucket column writes one."""
    return int(buckets or spark.conf.get("spark.sql.shuffle.partitions"))


def new_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def make_folder(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)


def slices(batch: pa.RecordBatch, sizes: list[int], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(start, stop) row ranges of about ``limit`` bytes, one row at least."""
    start = held = 0
    for i, n in enumerate(sizes):
        if i > start and held + n > limit:
            yield start, i
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield start, batch.num_rows


def text_bytes(batch: pa.RecordBatch, name: str) -> list[int]:
    """Bytes of every row's text (UTF-8) or list of 32-bit numbers, nulls as none."""
    import pyarrow.compute as pc
    values = batch.column(name)
    if pa.types.is_list(values.type):
        return pc.multiply(pc.fill_null(pc.list_value_length(values), 0), 4).to_pylist()
    return pc.fill_null(pc.binary_length(values), 0).to_pylist()


def with_python_columns(df: DataFrame, column: str, make: Callable[[], Callable[[pa.Array], list[pa.Array]]],
                        fields: StructType, limit: int = SLICE_BYTES) -> DataFrame:
    """``df`` plus ``fields``, computed from ``column`` by Arrow batches.

    Columns of ``df`` with the names of ``fields`` give way to them.

    ``make()`` runs once in each task and returns the function that turns an array of
    values into one array per field. Large batches are cut by bytes, so a task
    holds a few MB of values and results at a time whatever the batch size is.
    """
    df = df.drop(*(f for f in fields.names if f != column))
    out = StructType([*df.schema.fields, *fields.fields])

    def run(batches):
        work = make()
        for batch in batches:
            for a, b in slices(batch, text_bytes(batch, column), limit):
                part = batch.slice(a, b - a)
                arrays = work(part.column(column))
                yield pa.RecordBatch.from_arrays([*part.columns, *arrays],
                                                 names=[*part.schema.names, *fields.names])

    return df.mapInArrow(run, out)


def kept_rows(docs: DataFrame, keep: DataFrame, id_col: str, tag: Column) -> DataFrame:
    """Rows of ``docs`` named by ``keep`` (columns _id, _tag), one for each pair.

    ``tag`` is computed from a row of ``docs`` (such as a digest of its text). Joined by
    id, so that a large group of equal texts is spread; columns of ``docs`` may have any
    names.
    """
    from pyspark.sql import Window
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       F.col(f"`{id_col}`").alias("_doc"), tag.alias("_has"))
    met = rows.join(keep, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_has") == F.col("_tag")))
    one = met.withColumn("_n", F.row_number().over(Window.partitionBy("_doc", "_has").orderBy(F.lit(1))))
    return one.where("_n = 1").select("_row.*")


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps whose results are written.

    It does so when the driver's memory is collected, by itself only every half hour
    (spark.cleaner.periodicGC.interval), which can be later than the disk is full.
    """
    import gc
    gc.collect()
    spark._jvm.System.gc()


def drawn(rows: DataFrame, by: list[str], about: int, total: int) -> list:
    """About ``about`` of ``rows`` (``total`` in number; all, if no more), chosen and ordered by a hash of
    the columns ``by``: the same ones each time. Every task sends its share alone, where the
    first rows of an order would be sent by each."""
    h = F.pmod(F.xxhash64(*by, F.lit("draw")), F.lit(1 << 40))
    some = rows.withColumn("_draw", h)
    if total > about:
        some = some.where(F.col("_draw") < int((1 << 40) * about / total))
    return sorted(some.collect(), key=lambda r: r["_draw"])
