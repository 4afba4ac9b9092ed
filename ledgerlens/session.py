"""SparkSession construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every ledgerlens job relies on.  AQE re-plans joins (broadcast
# only when the runtime size is under the threshold), coalesces small
# shuffle partitions and splits skewed join partitions.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "ledgerlens", extra: dict | None = None) -> SparkSession:
    """Local/test session.  On a cluster, use the session the platform gives
    and call :func:`ensure_checkpoint_dir` instead."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(ENGINE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the shared checkpoint directory.

    The cluster names it in ``spark.checkpoint.dir``; we only invent one
    (a fresh temp folder) when nothing is configured, as in local tests.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns the setting
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="ledgerlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for materialized intermediates under the shared checkpoint dir."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), "ledgerlens-scratch", name)


def cluster_settings(input_bytes: int, target_partition_bytes: int = 256 << 20,
                     max_partitions: int = 100_000) -> dict:
    """Suggested settings for a run reading ``input_bytes``.

    Shuffle partitions are sized so one partition is ~``target_partition_bytes``
    before AQE coalesces small ones (advisory size) and splits skewed ones,
    which keeps a task's shuffle read within executor memory instead of
    spilling.  Scan splits match the same size.
    """
    parts = max(200, min(max_partitions, -(-input_bytes // target_partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.session.timeZone": "UTC",
    }
