"""Session helpers: recommended settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a load job wants regardless of cluster size.  AQE re-plans joins
# from runtime sizes (broadcast only when the measured side is under
# spark.sql.autoBroadcastJoinThreshold), coalesces small shuffle partitions
# and splits skewed join partitions.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def scale_settings(input_bytes: int, partition_bytes: int = 256 << 20) -> dict:
    """Starting settings for a job that reads about ``input_bytes``.

    Shuffle partitions are sized so one holds about ``partition_bytes``
    (AQE coalesces the small ones at run time and splits skewed join
    partitions); scans split files at 512 MB; broadcasts stay under 64 MB,
    checked by Spark against measured sizes.
    """
    parts = 1 + int(input_bytes // partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(512 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }


def build_session(master: str | None = "local[*]", shuffle_partitions: int | None = 8, app: str = "curata",
                  extra: dict | None = None) -> SparkSession:
    """A session with the recommended settings.  ``master=None`` and
    ``shuffle_partitions=None`` leave both to the submitted configuration."""
    b = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master is not None:
        b = b.master(master)
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**RECOMMENDED, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _spark_context(spark: SparkSession):
    try:
        return spark.sparkContext          # absent on Spark Connect sessions
    except Exception:  # noqa: BLE001
        return None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir.

    On a cluster this must be set by the deployment (a shared file system):
    without it this fails, because a folder of one machine would lose data.
    Only a local run or test gets a folder created here, registered so that
    later checkpoint() calls and written snapshots agree.
    """
    sc = _spark_context(spark)
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root and (sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="curata-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", root)
        except Exception:  # noqa: BLE001 -- some deployments refuse core confs at runtime
            pass
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    if root.startswith("file:"):
        root = root[len("file:"):]
    return os.path.join(root, "curata", f"{name}-{uuid.uuid4().hex[:12]}")
