"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# What the pipeline relies on. AQE splits skewed join and rebalance partitions. No join is
# planned as a broadcast from an estimate: AQE turns one into it after it has measured the side.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.scheduler.mode": "FAIR",
    # Streaming state grows with the keys, so it is kept on disk and not in the heap.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str, master: str | None = None, **extra: str) -> SparkSession:
    """A session with the pipeline's settings, and `extra` ones over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    A temporary folder stands in only on a single-process session, where driver and
    executors share one disk.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder all executors can reach")
    root = tempfile.mkdtemp(prefix="skyledger-")
    spark.conf.set(CHECKPOINT_KEY, root)
    return root


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder under the shared root."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"
