"""Session helpers: one place for the settings every job relies on.

Library functions never create sessions; they take DataFrames. These helpers are
for tests, the benchmark and scripts, plus ``scratch_path`` which finds the shared
folder for lineage cuts and intermediate tables.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at any scale: adaptive execution (coalesce small shuffle
# partitions, split skewed join partitions, turn small joins into broadcasts at
# runtime from *measured* sizes), UTC for every time computation, no UI server.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Recommended settings for the 100 TB target (not applied by tests): large scan splits
# (fewer, fuller tasks), shuffle partitions sized so a reducer handles ~128 MB of the
# biggest exchange (AQE coalesces small ones and splits skewed join partitions), a
# conservative static broadcast threshold (broadcasts are also row/byte checked in
# code), and cleaned-up checkpoint files.
CLUSTER_CONF = {
    **DEFAULT_CONF,
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.shuffle.partitions": "120000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",   # honour the advisory size
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def shuffle_partitions_for(shuffle_bytes: int, target_bytes: int = 128 * 1024 * 1024) -> int:
    """Shuffle partition count so each reducer gets about ``target_bytes`` of the
    largest exchange (AQE then coalesces downwards where data is smaller)."""
    return max(1, -(-shuffle_bytes // target_bytes))


def build_session(master: str = "local[8]", app: str = "keelson",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, configuring Spark to use it.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder (HDFS, object
    store); it is read from the session and used as is. Only a local-mode session
    without that setting (tests, the local check) gets a fresh folder under /tmp.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
    path = tempfile.mkdtemp(prefix="keelson-ckpt-", dir="/tmp")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the file system has ``path``. Anything but a clear answer is raised: a table that
    cannot be read must never be taken for one that is not there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder this library has written, if it is there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def default_parallelism(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def env_cpus(default: int = 8) -> int:
    return int(os.environ.get("BENCH_CPUS", default))
