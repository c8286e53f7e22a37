"""Document table (S9-S13): rows stored as JSON text beside copied hot columns, in one
folder for each batch, within it partitioned by ``target_name`` so that target filters
prune folders (Q5, S16)."""

from __future__ import annotations

import datetime as dt
import itertools
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources.batches import Manifests, file_name

DOC_FIELDS = [
    T.StructField("seq", T.LongType()),
    T.StructField("data", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("run_id", T.StringType()),
]
PARTITIONS = [T.StructField("batch", T.StringType()), T.StructField("target_name", T.StringType())]
_BAD = "_bad_json"


class DocumentTable:
    """Append-only table of batches (see ``tessera.sources.batches``). ``hot`` declares item
    fields that are stored beside the JSON with their types; a file's rows are sorted by
    them, and each has a Bloom filter, so that a search for a value skips the pages, row
    groups and files that don't hold it."""

    def __init__(self, spark: SparkSession, path: str, hot: T.StructType | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self.hot = list(hot.fields) if hot else []
        self.manifests = Manifests(spark, path)
        self.schema = T.StructType([*DOC_FIELDS, *[T.StructField(f"hot_{f.name}", f.dataType) for f in self.hot], *PARTITIONS])

    def _fs(self, path: str):
        return self.manifests.fs(path)

    def exists(self) -> bool:
        fs, p = self._fs(self.path)
        return fs.exists(p)

    def create_if_absent(self) -> None:
        """An empty table."""
        fs, p = self._fs(self.path)
        fs.mkdirs(p)

    def save(self, df: DataFrame, run_id: str | None = None, target_name: str | None = None,
             batch_key: str | None = None) -> str:
        """Each row -> JSON text in ``data``; ``run_id``/``target_name`` copied
        from the row (or the arguments), ``created_at`` = write time; appended.

        A batch is there as a whole or not at all: readers see the folders that manifests
        name. A ``batch_key`` (such as that of a streaming micro-batch) that is already
        stored is skipped, so a replayed batch does not add its rows twice."""
        cols = [F.col(f"`{c}`") for c in df.columns]
        run = F.col("run_id") if "run_id" in df.columns else F.lit(run_id)
        target = F.col("target_name") if "target_name" in df.columns else F.lit(target_name)
        hot = [(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f"hot_{f.name}")
               for f in self.hot]
        created = dt.datetime.now(dt.timezone.utc)
        return self.restore(df.select(
            F.monotonically_increasing_id().alias("seq"),
            F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("data"),
            F.lit(created.isoformat()).cast("timestamp").alias("created_at"),
            run.cast("string").alias("run_id"), *hot,
            target.cast("string").alias("target_name")), batch_key, created)

    def restore(self, rows: DataFrame, batch_key: str | None = None, created: dt.datetime | None = None) -> str:
        """Store rows as ``table`` gives them, unchanged, as one batch."""
        key = batch_key or uuid.uuid4().hex
        if self.manifests.has(key):
            return self.path
        folder = f"{file_name(key)}-{uuid.uuid4().hex[:12]}"
        names = [f"hot_{f.name}" for f in self.hot]
        n = Observation(f"rows_{uuid.uuid4().hex}")
        # few files for each target, a large target split among tasks
        out = rows.drop("batch").hint("rebalance", "target_name").sortWithinPartitions("target_name", *names)
        w = out.observe(n, F.count(F.lit(1)).alias("rows")).write.partitionBy("target_name")
        for c in names:
            w = w.option(f"parquet.bloom.filter.enabled#{c}", "true").option(f"parquet.bloom.filter.adaptive.enabled#{c}", "true")
        w.parquet(f"{self.path}/batch={folder}")
        self.manifests.add(key, {"folder": folder, "created_at": (created or dt.datetime.now(dt.timezone.utc)).isoformat(),
                                 "rows": n.get.get("rows", 0)})
        return self.path

    def table(self, newest: int | None = None) -> DataFrame:
        """All rows, or those of the newest batches that hold ``newest`` rows together."""
        batches = self.manifests.all()[::-1]
        if newest is not None:
            held = [0, *itertools.accumulate(m["rows"] for m in batches)]
            batches = [m for m, before in zip(batches, held) if before < newest]
        folders = [f"{self.path}/batch={m['folder']}" for m in batches]
        # a batch without rows has a folder without files
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*folders)

    def load(self, schema=None, limit: int | None = None, target_name: str | None = None,
             ordered: bool = False, where: dict | None = None) -> DataFrame:
        """Newest first (``_id``, the batch and the row's number in it, breaks ties,
        D25); rows whose JSON does not parse are skipped. With ``schema`` the JSON
        becomes typed columns, the item's own ``id`` among them, else one VARIANT.
        ``where`` (field -> value) compares hot columns. A limit opens the newest batches
        that hold so many rows and no others, and takes the newest rows (per-task top-k,
        no full sort); without one the rows come unordered unless ``ordered=True`` asks
        for the global sort."""
        t = self.table(limit if limit and target_name is None and not where else None)
        if target_name is not None:
            t = t.filter(F.col("target_name") == target_name)
        for name, value in (where or {}).items():
            t = t.filter(F.col(f"hot_{name}") == value)
        if limit or ordered:
            t = t.orderBy(F.col("created_at").desc(), F.col("batch").desc(), F.col("seq").desc())
        if limit:
            t = t.limit(limit)
        t = t.withColumn("_id", F.concat_ws("-", "batch", F.col("seq").cast("string"))).drop("batch", "seq", *[f"hot_{f.name}" for f in self.hot])
        if schema is None:
            parsed = t.withColumn("value", F.try_parse_json("data")).filter(F.col("value").isNotNull())
            return parsed.drop("data")
        full = T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())])
        parsed = t.withColumn("_doc", F.from_json("data", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}))
        parsed = parsed.filter(F.col("_doc").isNotNull() & F.col(f"_doc.{_BAD}").isNull())
        fields = [F.col("_doc").getField(f.name).alias(f.name) for f in schema.fields]
        own = {f.name for f in schema.fields}
        return parsed.select(*fields, *[c for c in ("_id", "created_at", "run_id", "target_name") if c not in own])

    def count(self) -> int:
        """S12."""
        return self.table().count()

    def clear(self) -> None:
        """Truncate to the empty table."""
        fs, p = self._fs(self.path)
        fs.delete(p, True)
        fs.mkdirs(p)
