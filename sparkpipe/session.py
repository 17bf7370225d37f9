"""SparkSession factory and shared-folder helpers.

Everything runs in UTC, with adaptive query execution on (runtime
coalescing, skew-join splitting, runtime broadcast conversion) and the
Spark UI off.  Intermediate tables and streaming checkpoints live under
the folder the cluster names in ``spark.checkpoint.dir``; only when that
is unset (tests, local runs) do we create one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "sparkpipe", extra: dict | None = None) -> SparkSession:
    """Return (or create) the session with the library defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the library relies on to an existing session."""
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
              "spark.sql.sources.partitionOverwriteMode",
              "spark.sql.streaming.stateStore.providerClass"):
        spark.conf.set(k, DEFAULT_CONF[k])
    ensure_checkpoint_dir(spark)
    return spark


def shuffle_partitions_for(input_bytes: int, target_partition_bytes: int = 256 * 1024 * 1024,
                           minimum: int = 200) -> int:
    """Initial shuffle partition count for an input size (AQE coalesces small ones later).

    At 100 TB and 256 MB per partition this is ~400k: each reducer's share fits executor
    memory and spills sort/aggregate buffers gracefully.
    """
    return max(minimum, -(-input_bytes // target_partition_bytes))


def cluster_conf(input_bytes: int) -> dict:
    """Settings for a large run: partition sizes tied to the input, AQE skew splitting."""
    n = shuffle_partitions_for(input_bytes)
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: the cluster's setting, else a fresh local one."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="sparkpipe-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")
