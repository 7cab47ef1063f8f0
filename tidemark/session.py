"""Session settings the operators rely on.

Every operator is a pure DataFrame -> DataFrame function and works with any
session; ``configure`` only pins what results depend on (UTC clock, ANSI casts)
and what scale depends on (AQE with skew-join splitting, coalescing).
"""

from __future__ import annotations

import contextlib
import os
import tempfile
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Settings results depend on.  A timestamp rendered to text (surrogate keys)
# must not move with the machine's zone, and bad casts must raise.
RESULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Settings scale depends on.  AQE re-plans joins from runtime sizes, splits
# skewed shuffle partitions of sort-merge joins and coalesces small ones.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply RESULT_CONF and SCALE_CONF to a running session."""
    for key, value in {**RESULT_CONF, **SCALE_CONF}.items():
        spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def build_session(master: str | None = "local[*]", shuffle_partitions: int | None = 8,
                  app_name: str = "tidemark") -> SparkSession:
    """A session with the settings above.  ``master=None`` keeps the master chosen by
    ``spark-submit`` or the cluster's defaults; ``shuffle_partitions=None`` keeps the
    configured shuffle width (AQE coalesces it)."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master is not None:
        builder = builder.master(master)
    builder = builder.config("spark.scheduler.mode", "FAIR")     # independent steps of a job run side by side
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**RESULT_CONF, **SCALE_CONF}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the session's checkpoint folder; create a local one only for a local master.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is used as
    is; without it this raises, as executors could not read each other's files.
    Only a local session (a test) gets a fresh temp folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


@contextlib.contextmanager
def shuffle_files_freed(spark: SparkSession) -> Iterator[None]:
    """Within the block the shuffle files of a query go when it ends, not when the driver happens to collect its
    garbage; for work that runs each DataFrame once (one that runs again computes its shuffles again)."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _scratch_root(spark: SparkSession) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), "tidemark", spark.sparkContext.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for intermediate tables."""
    return os.path.join(_scratch_root(spark), f"{name}-{next(_SEQ)}")


def clean_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables (call it once nothing reads them any more)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _counter():
    n = 0
    while True:
        n += 1
        yield n


_SEQ = _counter()
