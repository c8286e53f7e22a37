"""W1 repeated incremental runs and W2 streaming keyed de-duplication.

The reference re-runs its batch pipeline on a timer and appends the output. Here the
same stateless ``clean``/``transform`` functions run on a file-source stream; each
trigger processes only new files, the checkpoint records progress, and the sink
appends. ``availableNow`` processes everything present and stops (one external
trigger); ``processing_time='30 minutes'`` is the interval job.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def read_file_stream(spark: SparkSession, source_dir: str, schema, fmt: str = "parquet",
                     glob: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """New files at ``source_dir``: a folder, or a single file (then its folder is
    watched for files of that name, as a stream's source must be a folder)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(source_dir)
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isFile():
        source_dir, glob = p.getParent().toString(), p.getName()
    r = spark.readStream.schema(schema).format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(source_dir)


def incremental_run(stream: DataFrame, fn: Callable[[DataFrame], DataFrame], sink_path: str,
                    checkpoint: str, *, sink: str = "parquet", processing_time: str | None = None,
                    wait: bool = True) -> StreamingQuery:
    """``fn`` (the same DataFrame function used in batch) applied to every
    micro-batch; parquet sink = exactly-once file sink, csv/jsonl/table via
    ``foreachBatch``: csv/jsonl write one folder per batch id (a retried batch
    overwrites its own folder), the table sink skips batch keys it already stored —
    replays do not duplicate rows."""
    out = fn(stream)
    if sink == "parquet":
        w = out.writeStream.format("parquet").option("path", sink_path)
    else:
        from tessera.sources.sinks import write_sink

        def per_batch(batch: DataFrame, batch_id: int) -> None:
            target = f"{sink_path.rstrip('/')}/batch_id={batch_id}"
            if sink == "table":
                write_sink(batch, sink, sink_path, batch_key=f"{checkpoint}#{batch_id}")
            else:
                write_sink(batch, sink, target, mode="overwrite")

        w = out.writeStream.foreachBatch(per_batch)
    w = w.option("checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)
    q = w.start()
    if wait and not processing_time:
        q.awaitTermination()
    return q


def incremental_outputs(stream: DataFrame, specs: list[dict], store_path: str, checkpoint: str, *, run: str = "run",
                        keep: tuple = ("page_id",), processing_time: str | None = None, wait: bool = True) -> StreamingQuery:
    """W1 for whole runs: every micro-batch of pages is a run of all targets, whose results,
    rejects, errors and log rows are stored together (see ``run_outputs``); a batch that
    is replayed after a failure is stored once."""
    from tessera.plans.runner import run_outputs
    from tessera.sources.batches import BatchStore

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        run_outputs(batch, specs, BatchStore(batch.sparkSession, store_path), f"{run}-{batch_id}", keep, f"{checkpoint}#{batch_id}")

    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)
    q = w.start()
    if wait and not processing_time:
        q.awaitTermination()
    return q


def dedupe_run(stream: DataFrame, keys: list[str], order_by: list[str], sink_path: str, checkpoint: str,
               *, processing_time: str | None = None, wait: bool = True) -> StreamingQuery:
    """C5 across micro-batches. The first row of a key stays for ever, however late
    the next one comes: rows of an earlier batch win, within a batch the first in
    ``order_by``. Keys may be null.

    Known keys are the query's state, kept by Spark's state store beside the checkpoint: a
    batch looks up its own keys and no others, so its cost is that of its rows, however
    many batches came before (RocksDB keeps the state on disk, see ``get_spark``). Rows are
    reduced to one for each key in the map tasks. A key's row carries the time of its
    batch, which a replayed batch gets again from the log: a key that has one time only is
    new in this batch. The sink holds one folder for each batch; a replayed batch finds
    the state as it was and overwrites its own."""
    row = F.struct(*[F.col(f"`{c}`") for c in stream.columns])
    seen = (stream.withColumn("_arrived", F.current_timestamp()).groupBy(*[F.col(f"`{k}`").alias(f"_key_{k}") for k in keys]).agg(
        F.min_by(row, F.struct("_arrived", *order_by)).alias("_row"),
        F.min("_arrived").alias("_first"), F.max("_arrived").alias("_last")))

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        new = batch.where(F.col("_first") == F.col("_last")).select("_row.*")
        new.write.mode("overwrite").parquet(f"{sink_path.rstrip('/')}/batch_id={batch_id}")

    w = seen.writeStream.outputMode("update").foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)
    q = w.start()
    if wait and not processing_time:
        q.awaitTermination()
    return q
