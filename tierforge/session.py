"""Session construction and the shared scratch location.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names;
a local scratch folder is created only when the session has none (tests,
local runs).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Test-sized data: AQE would coalesce a whole shuffle into one partition
    # and run the fact's fan-out join (x6 rows) in one task. Small advisory
    # partitions keep every local core busy; the cluster profile uses 256 MB.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(4 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",     # split chained lookups on one hot key too
}


# Settings for a large cluster run (~100 TB of feeds, ~1000 executors). AQE
# coalesces the generous initial shuffle width down to ~256 MB partitions and
# splits skewed join partitions; scans are split at 512 MB so a task's input
# fits comfortably in executor memory; a join side is broadcast automatically
# only when its *measured* size is small.
CLUSTER_DEFAULTS = {
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": str(512 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, app: str = "tierforge", shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None, profile: str = "local") -> SparkSession:
    """A session with the settings the library expects (AQE on, UTC).

    ``profile="cluster"`` applies ``CLUSTER_DEFAULTS`` (sizing for a large
    cluster); ``"local"`` keeps Spark's defaults plus AQE, UTC and no UI.
    """
    if profile not in ("local", "cluster"):
        raise ValueError("profile must be 'local' or 'cluster'")
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(LOCAL_DEFAULTS if profile == "local" else CLUSTER_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's shared checkpoint folder; a temporary one only for a local master without any."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not configured:
        configured = tempfile.mkdtemp(prefix="tierforge-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused directory under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), "scratch", f"{label}-{uuid.uuid4().hex[:12]}")
