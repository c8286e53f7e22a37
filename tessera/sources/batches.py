"""Batches of several outputs that become visible together.

An attempt writes every output of a batch to a folder of its own; then one small file, the
batch's manifest, names that folder. Readers see what manifests name and nothing else, so a
batch is there as a whole or not at all, on object stores (where no rename is atomic) as
well. A batch whose manifest is there is never written again: given once more after a
failure, or by a replayed stream, it is skipped.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def file_name(key: str) -> str:
    """A batch key as the name of a file."""
    return "".join(c if c.isalnum() else f"~{ord(c):x}" for c in key)


class Manifests:
    """The manifests of the batches under ``path``, oldest first."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.at = spark, path.rstrip("/"), f"{path.rstrip('/')}/_manifests"

    def fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def has(self, key: str) -> bool:
        fs, p = self.fs(f"{self.at}/{file_name(key)}.json")
        return fs.exists(p)

    def all(self) -> list[dict]:
        """A driver-side list: one entry for each batch, read by one job."""
        fs, p = self.fs(self.at)
        if not fs.exists(p):
            return []
        found = self.spark.read.text(self.at, wholetext=True).collect()
        return sorted((json.loads(r.value) for r in found), key=lambda m: (m["created_at"], m["folder"]))

    def add(self, key: str, entry: dict) -> bool:
        """False if another attempt of the batch was first."""
        fs, p = self.fs(f"{self.at}/{file_name(key)}.json")
        if fs.exists(p):
            return False
        try:
            out = fs.create(p, False)
        except Exception as e:              # made since: whoever made it has committed the batch
            if fs.exists(p):
                return False
            raise e
        out.write(bytearray(json.dumps({"key": key, **entry}).encode()))
        out.close()
        return True


class BatchStore:
    """Named outputs, stored batch by batch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.manifests = Manifests(spark, path)

    def commit(self, key: str, outputs: dict[str, DataFrame | Callable[[dict[str, DataFrame]], DataFrame]]) -> bool:
        """Write all ``outputs`` of the batch ``key``; False if it was there already.

        They are written one after the other; a function is given the tables written so far,
        and its result is written too: it can count them without running their plans again.
        What an attempt has left that failed half-way is never read.
        """
        if self.manifests.has(key):
            return False
        folder = f"{file_name(key)}-{uuid.uuid4().hex[:12]}"
        created = dt.datetime.now(dt.timezone.utc).isoformat()
        written: dict[str, DataFrame] = {}
        entry: dict = {}
        for name, df in outputs.items():
            if callable(df):
                df = df(written)
            n = Observation(f"rows_{uuid.uuid4().hex}")
            to = f"{self.path}/{folder}/{name}"
            df.observe(n, F.count(F.lit(1)).alias("rows")).write.parquet(to)
            written[name] = self.spark.read.schema(df.schema).parquet(to)
            entry[name] = {"rows": n.get.get("rows", 0), "schema": df.schema.json()}
        return self.manifests.add(key, {"folder": folder, "created_at": created, "outputs": entry})

    def read(self, name: str, key: str | None = None) -> DataFrame:
        """Rows of one output of all batches, or of one; batches may have other columns (null where one lacks them)."""
        out = None
        by_schema: dict[str, list[str]] = {}
        for m in self.manifests.all():
            if name in m["outputs"] and key in (None, m["key"]):
                by_schema.setdefault(m["outputs"][name]["schema"], []).append(f"{self.path}/{m['folder']}/{name}")
        for schema, folders in by_schema.items():
            part = self.spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(*folders)
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
        if out is None:
            raise FileNotFoundError(f"{self.path} has no batch with {name!r}")
        return out

    def rows(self, name: str) -> int:
        """Rows of one output, from the manifests alone."""
        return sum(m["outputs"][name]["rows"] for m in self.manifests.all() if name in m["outputs"])
