"""Session defaults and the shared scratch location.

Every job in this package runs on a caller-supplied SparkSession. The helpers
here only fill in settings that are unset, so a cluster's own configuration
always wins.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on for results that agree with the SQL oracle:
# UTC timestamps and runtime re-planning. Applied only when the session has no
# value of its own.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(app_name: str = "tidemark", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local-mode session for tests and benchmarks (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
    )
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Pin UTC and AQE on a session that has not configured them itself."""
    for key, value in SESSION_DEFAULTS.items():
        if key == "spark.sql.session.timeZone":
            # The oracle compares wall-clock values, so the zone is always pinned.
            spark.conf.set(key, value)
        elif spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must name shared storage (HDFS, object store);
    executors and the driver all write below it. Only a local-mode session
    without the setting gets a private temporary folder, as in tests.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        # The setting is static: it cannot be set on a running session, so a
        # local session without it keeps the folder on its context instead.
        current = spark.sparkContext.getCheckpointDir()
        root = os.path.dirname(current.rstrip("/")) if current else tempfile.mkdtemp(prefix="tidemark-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder below the shared checkpoint root."""
    root = checkpoint_root(spark)
    return f"{root}/tidemark/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its (shared) file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


# Settings for a large cluster (100 TB input, ~1000 executors). Applied by
# the deployment, not by the library; listed here so the sizing is explicit.
CLUSTER_SETTINGS = {
    # Scan splits of 256 MiB: ~400 000 scan tasks over 100 TB.
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    # AQE re-plans at run time: coalesces small shuffle partitions toward the
    # advisory size, splits skewed ones, and converts joins to broadcast when
    # a measured side is small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    # Parquet pushdown and vectorised reads (defaults, stated for clarity).
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.enableVectorizedReader": "true",
    "spark.sql.session.timeZone": "UTC",
}


def shuffle_partitions_for(shuffled_bytes: int, target_bytes: int = 256 * 1024 * 1024, minimum: int = 200) -> int:
    """Initial shuffle partition count so each partition holds about ``target_bytes``.

    AQE coalesces downward at run time, so this is an upper bound sized for the
    largest shuffle (e.g. raw rows of a sort-merge join); aggregated shuffles
    end up far smaller and are coalesced.
    """
    return max(minimum, -(-int(shuffled_bytes) // int(target_bytes)))
