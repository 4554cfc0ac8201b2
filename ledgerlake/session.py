"""Session construction for tests and the bench, and the shared checkpoint folder.

Library functions never create a session; they take DataFrames. On a cluster the
session comes from the platform, and only unset settings are filled in here.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the engine relies on; applied only where the session leaves them unset.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "ledgerlake") -> SparkSession:
    """A local session for tests and benchmarks (never used by library code).

    Each session gets a fresh warehouse folder, so managed tables of one run never
    collide with another's."""
    warehouse = tempfile.mkdtemp(prefix="ledgerlake-wh-", dir=os.environ.get("TMPDIR", "/tmp"))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Noting the call site of every Column call takes longer than most plans.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.warehouse.dir", warehouse)
    )
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    _ensure_checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Fill in engine defaults on an existing (cluster) session without overriding it."""
    for k, v in DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder named by `spark.checkpoint.dir`, if the cluster sets one (read
    from the session conf first, so it also works where no SparkContext is exposed)."""
    try:
        configured = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # noqa: BLE001 - some session kinds refuse core confs
        configured = None
    if configured:
        return configured
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no SparkContext behind this session
        return None
    return sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()


def _ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's checkpoint folder; create a scratch one only for a local session
    without any. Reliable checkpoints survive executor loss, unlike local ones."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    current = checkpoint_dir(spark)
    if not current and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    path = current or tempfile.mkdtemp(prefix="ledgerlake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path


def size_shuffles(spark: SparkSession, input_bytes: int,
                  target_partition_bytes: int = 128 * 1024 * 1024) -> int:
    """Size shuffles for an input of `input_bytes` (e.g. 100 TB): start with one shuffle
    partition per `target_partition_bytes` of input, so no reducer has to spill more than
    about that much, and let AQE coalesce the small ones and split skewed ones. Settings
    the session already has are left alone. Returns the partition count used."""
    n = max(1, -(-input_bytes // target_partition_bytes))
    wanted = {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
    }
    for k, v in wanted.items():
        if spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)
    return int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n)))


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Total size of the files below the paths, from the file system's own summary; a path
    that does not exist counts as nothing."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    total = 0
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            total += fs.getContentSummary(p).getLength()
    return total
