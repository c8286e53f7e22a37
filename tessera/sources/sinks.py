"""Sink factory, backup/conversion, export, naming and storage info
(S15-S20)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.csv import csv_folders, write_csv
from tessera.sources.doctable import DocumentTable
from tessera.sources.jsonl import write_jsonl

# Sink kinds accepted by the factory (the reference's 'sqlite' maps to
# the parquet document table).
SINK_KINDS = ("csv", "jsonl", "table", "sqlite")


def write_sink(df: DataFrame, kind: str, path: str, **opts) -> str:
    """Write ``df`` with the sink named ``kind``; unknown kinds raise."""
    kind = kind.lower()
    if kind == "csv":
        return write_csv(df, path, **opts)
    if kind == "jsonl":
        return write_jsonl(df, path, **opts)
    if kind in ("table", "sqlite"):
        return DocumentTable(df.sparkSession, path).save(df, **opts)
    if kind == "noop":  # S20 dry run: run the plan, write nothing
        df.write.format("noop").mode("overwrite").save()
        return ""
    raise ValueError(f"Unsupported storage type: {kind}")


def backup(df: DataFrame, path: str) -> str:
    """Write to CSV or JSONL picked by the extension of ``path``."""
    if path.endswith(".csv"):
        return write_csv(df, path)
    if path.endswith(".jsonl"):
        return write_jsonl(df, path)
    raise ValueError(f"Unsupported backup format: {path}")


def export(spark: SparkSession, table_path: str, fmt: str, out_path: str, schema=None,
           target: str | None = None) -> str:
    """Read the document table, keep one target (partition pruning, D20: the
    source is never the destination), write csv/jsonl/table."""
    src = DocumentTable(spark, table_path)
    df = src.load(schema=schema, target_name=target)
    if fmt == "table":
        return DocumentTable(spark, out_path).save(df.drop("_id", "created_at"))
    return write_sink(df, fmt, out_path)


def output_path(base: str, target_name: str, extension: str, when: _dt.datetime | None = None,
                run_id: str | None = None) -> str:
    """``{target_name}_{%Y%m%d_%H%M%S}.{ext}`` under ``base``; with a run id the
    run gets its own directory."""
    ts = (when or _dt.datetime.now(_dt.timezone.utc)).strftime("%Y%m%d_%H%M%S")
    name = f"{target_name}_{ts}.{extension}"
    return f"{base.rstrip('/')}/{name}" if run_id is None else \
        f"{base.rstrip('/')}/target_name={target_name}/run_id={run_id}/{name}"


def storage_info(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """Existence, file count, bytes and last modification of everything under
    ``path`` (file listing only: the content column is pruned), as one row."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    exists = p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
    label = F.lit(name or path)
    if not exists:
        return spark.range(1).select(label.alias("storage"), F.lit(False).alias("exists"),
                                     F.lit(0).cast("long").alias("files"),
                                     F.lit(0).cast("long").alias("size_bytes"),
                                     F.lit(None).cast("timestamp").alias("modified"))
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([f for f, _ in csv_folders(spark, path)])
             .filter(~F.regexp_like(F.col("path"), F.lit(r"/[_.][^/]*$")))
             .select("length", "modificationTime"))
    return files.agg(F.count(F.lit(1)).cast("long").alias("files"),
                     F.coalesce(F.sum("length"), F.lit(0)).cast("long").alias("size_bytes"),
                     F.max("modificationTime").alias("modified")).select(
        label.alias("storage"), F.lit(True).alias("exists"), "files", "size_bytes", "modified")


def clear(spark: SparkSession, path: str, kind: str, schema) -> None:
    """S13 for CSV/JSONL/table: replace the contents by an empty data set."""
    empty = spark.createDataFrame([], schema)
    kind = kind.lower()
    if kind == "csv":
        write_csv(empty, path, mode="overwrite")
    elif kind == "jsonl":
        write_jsonl(empty, path, mode="overwrite")
    elif kind in ("table", "sqlite"):
        DocumentTable(spark, path).clear()
    else:
        raise ValueError(f"Unsupported storage type: {kind}")


def table_info(df: DataFrame, name: str) -> DataFrame:
    """S19 (table variant): column names and row count as one row."""
    cols = ",".join(df.columns)
    return df.agg(F.count(F.lit(1)).cast("long").alias("row_count")).select(
        F.lit(name).alias("table"), F.lit(cols).alias("columns"), "row_count")
