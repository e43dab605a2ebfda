"""Session settings shared by every job in the package.

All time logic works on event time in UTC, so the session zone is pinned.
Shared output (stream checkpoints, named data sets, round-trip files) goes to
the folder the cluster names in ``spark.checkpoint.dir``; a private folder is
created only when that setting is absent (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings this package relies on (fixed values).
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "vitalis",
    extra: dict | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    Master and shuffle partitions are those of spark-submit unless given here.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def cluster_settings(total_cores: int, input_bytes: int | None = None) -> dict[str, str]:
    """Starting settings for a large cluster (pass to ``build_session(extra=...)``).

    Shuffle partitions start at 3x the cores, or one per 128 MiB of input when
    that is larger, and AQE coalesces them to ~128 MiB at run time and splits
    skewed ones.  Streaming state goes to RocksDB.
    """
    parts = 3 * total_cores
    if input_bytes:
        parts = max(parts, input_bytes // (128 << 20))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings every query here assumes (UTC event time)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    Only when the session names none (local tests) a private folder is made
    and registered as the checkpoint directory.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="vitalis-")
        spark.conf.set("spark.checkpoint.dir", configured)
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh, unique sub-path of the shared folder for one job's output, under the application's own folder."""
    return os.path.join(_own_dir(spark), kind, uuid.uuid4().hex)


def _own_dir(spark: SparkSession) -> str:
    return os.path.join(shared_dir(spark), "vitalis", spark.sparkContext.applicationId)


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote under :func:`scratch_path`; call it when no result of a
    round trip, stream or operator is read any more (by any file system that Spark reaches)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_own_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
