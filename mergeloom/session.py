"""Spark session helpers: session defaults, shared scratch folder, input spreading."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Defaults that matter for correctness of results across engines.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "mergeloom", extra: dict | None = None) -> SparkSession:
    """Get or create a session with the library's defaults (local use and tests)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_SHIPPED: set[str] = set()
_ZIP: list[str] = []


def ship_package(spark: SparkSession) -> None:
    """Make ``mergeloom`` importable on the executors (once per application).

    Python UDFs refer to functions of this package, so the workers must import
    it: a zip of the package is added with ``addPyFile`` and Spark distributes
    it to every executor.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    if not _ZIP:
        pkg = os.path.dirname(os.path.abspath(__file__))
        out = os.path.join(tempfile.mkdtemp(prefix="mergeloom-pkg-"), "mergeloom.zip")
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for root, _, files in os.walk(pkg):
                for f in files:
                    if f.endswith(".py"):
                        full = os.path.join(root, f)
                        z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
        _ZIP.append(out)
        atexit.register(shutil.rmtree, os.path.dirname(out), True)
    sc.addPyFile(_ZIP[0])
    _SHIPPED.add(app)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, reading the cluster's setting first.

    Where neither the context nor ``spark.checkpoint.dir`` names one, a private folder
    is made for a local master (tests); a cluster has to name a shared one.
    """
    ship_package(spark)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="mergeloom-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


_SCRATCH: set[str] = set()
SCRATCH_PATHS: list[str] = []  # in the order of their making


def _forget(spark: SparkSession, root: str) -> None:
    """At the end of the driver: the application's scratch tables go."""
    if spark.sparkContext._jsc is not None:
        delete_path(spark, root)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table inside the shared checkpoint folder, kept until the application ends."""
    root = os.path.join(ensure_checkpoint_dir(spark), "tables")
    if root not in _SCRATCH:
        _SCRATCH.add(root)
        atexit.register(_forget, spark, root)
    SCRATCH_PATHS.append(os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}"))
    return SCRATCH_PATHS[-1]


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files behind when it is done."""
    held = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(DROP_SHUFFLES) if held is None else spark.conf.set(DROP_SHUFFLES, held)


# Broadcast guard: tables of a vocabulary's size.
MAX_BROADCAST_IDS = 1 << 20


def small(df: DataFrame, limit: int = MAX_BROADCAST_IDS) -> DataFrame:
    """``df`` marked for broadcasting if it has at most ``limit`` rows, else as it is (a shuffled join)."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def default_parallelism(spark: SparkSession) -> int:
    return max(1, spark.sparkContext.defaultParallelism)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a scan that arrives in one split, as the single-file test tables do.

    Anything that Spark could split itself is left as it is, so no table of more than
    one split (``spark.sql.files.maxPartitionBytes``) is ever shuffled here.
    """
    want = min_partitions or default_parallelism(df.sparkSession)
    if want > 1 and df.rdd.getNumPartitions() == 1:
        return df.repartition(want)
    return df
