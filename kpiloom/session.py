"""Session helpers: a local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "kpiloom") -> SparkSession:
    """A local session configured like the cluster one (AQE on, UTC, no UI)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def cluster_conf(largest_shuffle_bytes: float, target_partition_bytes: int = 256 * 1024 ** 2,
                 executor_cores: int = 8000) -> dict[str, str]:
    """Session settings for a cluster run, sized from the largest expected shuffle.

    ``largest_shuffle_bytes`` is the biggest exchange of the run. With the derived metric sheet that
    is the per-order line-item pre-aggregate (about 40 bytes per order, ~6 TB for a 100 TB raw
    order history). Shuffle partitions are set so each holds about ``target_partition_bytes``
    (never fewer than 2x the cores); AQE coalesces the small exchanges of the later, aggregated
    stages and splits skewed join partitions; broadcasts stay below 64 MB.
    """
    parts = max(2 * executor_cores, int(largest_shuffle_bytes // target_partition_bytes) + 1)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes * 2),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
        "spark.sql.session.timeZone": "UTC",
    }


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster it must be set (a distributed file system path). Only a local session without it,
    as in unit tests, gets a folder of this machine.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="kpiloom-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)        # DataFrame.checkpoint() needs it registered on the context
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint folder for one write."""
    return f"{checkpoint_root(spark)}/kpiloom/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in whatever file system it names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
