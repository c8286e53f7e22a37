"""Session construction and the shared scratch folder.

On a cluster the scratch folder is whatever ``spark.checkpoint.dir`` names (a shared,
fault-tolerant file system). Only when nothing is configured, as in local tests, a
folder under the system temp directory is created and registered.
"""

from __future__ import annotations

import atexit
import os
import pathlib
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "tessera",
              shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with AQE on, UTC time zone and the UI off."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # streaming state on local disk and in the checkpoint, not in the executors' memory
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        # HTML pages can be large: keep one Arrow batch into the Python workers small
        "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ship_package(spark)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder. Only in local mode, and only when
    nothing is configured (as in tests), a temp folder is created and registered."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:          # sessions without a SparkContext handle (e.g. Connect)
        sc = None
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d:
        master = (sc.master if sc is not None else spark.conf.get("spark.master", "")) or ""
        if not master.startswith("local"):
            # executors on other machines cannot see a local temp folder
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) "
                               "for checkpoints and scratch tables on a cluster")
        d = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    # Dataset.checkpoint() needs the context-level setting as well
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


_scratch: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder, in a folder of this
    application that is removed when its Python process ends. What must last longer
    belongs at a path of the caller's own."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/tessera/{spark.sparkContext.applicationId}"
    if base not in _scratch:
        _scratch.add(base)
        atexit.register(_remove, spark, base)
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def _remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system holds it, if the JVM is still there."""
    try:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jvm.org.apache.hadoop.conf.Configuration()).delete(p, True)
    except Exception:       # the gateway has gone first; the folder is the cluster's to clear
        pass


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once for an application, so that Python
    steps run where it isn't installed (as ``spark.submit.pyFiles`` would)."""
    try:
        sc = spark.sparkContext
    except Exception:       # sessions without a SparkContext handle: install the wheel there
        return
    if sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    root = pathlib.Path(__file__).resolve().parent
    path = pathlib.Path(tempfile.mkdtemp(prefix="tessera-package-")) / "tessera.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(path))


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str):
    ship_package(spark)
    return spark.read.parquet(table_path(sf_dir, name))
