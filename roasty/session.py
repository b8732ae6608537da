"""Session settings and the shared scratch location."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings a job of this library expects. AQE re-plans joins and coalesces
# shuffle partitions at run time; the session time zone is pinned so DATE()
# of a zoned timestamp means the same on every cluster.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # The driver keeps job, stage and SQL execution records for the status
    # tracker even with the UI off; long-running drivers need few of them.
    "spark.ui.retainedJobs": "200",
    "spark.ui.retainedStages": "200",
    "spark.ui.retainedTasks": "20000",
    "spark.sql.ui.retainedExecutions": "100",
}


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the runtime-modifiable settings of ``DEFAULT_CONF`` on an
    existing session (a cluster's); static ones (UI and status retention)
    are left to the launcher."""
    for k, v in DEFAULT_CONF.items():
        if spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "roasty") -> SparkSession:
    """A local session for tests and the benchmark."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("ROASTY_DRIVER_MEMORY", "8g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; a local folder is only
    made when a local-mode session has none (tests). On a cluster without
    one the job fails rather than write to one machine's disk."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a folder on shared storage for checkpoints "
                "and intermediate tables"
            )
        conf = tempfile.mkdtemp(prefix="roasty-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for a written intermediate."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 split_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a large run, sized from the bytes a job scans.

    Scans are split in ``split_bytes`` pieces. Every shuffle of this library
    moves pre-aggregated rows (panel groups, daily counts) or a bounded
    window, so the initial shuffle width is set from the slots, not the
    input, and AQE coalesces it to ``advisoryPartitionSizeInBytes`` at run
    time; skewed partitions are split by AQE as well."""
    slots = executors * cores_per_executor
    scan_tasks = max(1, input_bytes // split_bytes)
    return {
        **DEFAULT_CONF,
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(max(2 * slots, min(scan_tasks, 4 * slots))),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.sources.parallelPartitionDiscovery.threshold": "32",
    }
