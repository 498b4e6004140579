"""Spark session settings shared by jobs, tests and the bench.

On a cluster the session is normally created by the launcher; ``configure``
then sets the runtime SQL options that results and plans rely on (AQE, skew
handling, UTC) and leaves the rest to the cluster (checkpoint folder, partition
counts, memory).
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL options every job relies on.
RUNTIME_CONF = {
    # AQE re-plans at stage boundaries: coalesces small shuffle partitions,
    # turns sort-merge joins into broadcast joins when a side proves small at
    # run time, and splits skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Day boundaries are computed in UTC everywhere (oracle compares too).
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL options. The checkpoint folder is resolved only by
    the operators that checkpoint (``ensure_checkpoint_dir``)."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def get_session(master: str | None = None, app_name: str = "wrenchcast",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session. ``master`` is only given for local runs."""
    # Checkpoint files written for lineage cuts are removed once the
    # DataFrame that owns them is garbage-collected.
    builder = (SparkSession.builder.appName(app_name)
               .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    if master:
        builder = builder.master(master)
        # Local runs: one JVM, memory is the driver's. No web UI server.
        builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        builder = builder.config("spark.driver.memory", os.environ.get("WRENCHCAST_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def write_table(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder, which cuts its
    lineage: later readers prune its columns, lost executors read it again, and it
    is removed when the application ends."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the cluster.

    The cluster names it in ``spark.checkpoint.dir``; we only pick our own
    folder when nothing is set (local tests), never on a cluster.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not (sc.master == "local" or sc.master.startswith("local[")):  # local-cluster has executors of its own
        raise RuntimeError("spark.checkpoint.dir is not set on this cluster; "
                           "set it to a shared folder before running jobs")
    local_dir = tempfile.mkdtemp(prefix="wrenchcast-ckpt-")
    atexit.register(shutil.rmtree, local_dir, ignore_errors=True)
    sc.setCheckpointDir(local_dir)
    return sc.getCheckpointDir()
