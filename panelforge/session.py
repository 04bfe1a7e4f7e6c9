"""Session helpers: a configured SparkSession and the shared working folder.

Operators never create sessions themselves; they take DataFrames.  These
helpers are for tests, the bench and the query entry points.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "panelforge") -> SparkSession:
    """Session with AQE on, UTC time and the UI off (no server is opened)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("PANELFORGE_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_root(spark)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is the shared store the cluster configures, and it is
    an error if none is: executors don't see each other's or the driver's
    local folders.  Only a local session gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root:
        return root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="panelforge-ckpt-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared folder for written tables."""
    root = shared_root(spark).rstrip("/")
    return f"{root}/panelforge/{name}-{uuid.uuid4().hex[:12]}"


def scale_conf(input_bytes: int, cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Spill-aware SQL settings for a run reading ``input_bytes`` on ``cores``
    task slots: scan splits of ~256 MB, shuffle partitions sized so each holds
    ~256 MB of the (pre-aggregation) input and at least 3 waves of tasks, AQE
    coalescing toward the same advisory size and skew splitting above 4x the
    median.  All are runtime SQL settings (``spark.conf.set``)."""
    by_size = -(-input_bytes // target_partition_bytes)
    shuffle = max(3 * cores, min(by_size, 200_000))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes * 2),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }


def apply_scale_conf(spark: SparkSession, input_bytes: int, cores: int | None = None) -> dict[str, str]:
    conf = scale_conf(input_bytes, cores or spark.sparkContext.defaultParallelism)
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf
