"""Session construction and the shared checkpoint location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of this package relies on: UTC timestamps, AQE, dynamic partition overwrite, and a store's directories
# listed by some tasks and not by one each.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "128",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.python.unix.domain.socket.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "acoustispark", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    On a cluster ``master`` stays None and the launcher's settings win; tests pass ``local[*]``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    for k, v in DEFAULT_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on an already running session
            pass
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineage and intermediate tables: ``spark.checkpoint.dir`` of the session (a cluster
    names a shared, fault-tolerant folder there). Only on a local master, where driver and tasks share one disk, a
    private folder stands in when it is unset; anywhere else that is an error."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="acoustispark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new sub-folder of the checkpoint dir for a written table."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
