"""Session helpers.

The library never creates its own cluster settings inside operators; these
helpers are for tests, the bench and command-line use.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "shelfwise", extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Local session with AQE, skew-join splitting and the UI off."""
    master = master or os.environ.get("SHELFWISE_MASTER", "local[8]")
    parts = shuffle_partitions or int(os.environ.get("SHELFWISE_SHUFFLE_PARTITIONS", "8"))
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SHELFWISE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the cluster.

    Reads ``spark.checkpoint.dir`` from the session.  Where it is unset, a
    local master (one machine) gets a fresh scratch folder; on a cluster that
    is an error, for executors would write to their own disks.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:   # Spark Connect: no SparkContext on the client
        sc = None
    if not current and sc is not None:
        current = sc.getCheckpointDir()
    if current:
        if sc is not None:
            sc.setCheckpointDir(current)
        return current
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    scratch = tempfile.mkdtemp(prefix="shelfwise-ckpt-")
    spark.conf.set("spark.checkpoint.dir", scratch)
    if sc is not None:
        sc.setCheckpointDir(scratch)
    return scratch


def staging_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint dir for staged tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/stage/{name}"


def cluster_conf(input_bytes: int, total_cores: int, partition_bytes: int = 256 * 1024 ** 2,
                 broadcast_bytes: int = 64 * 1024 ** 2) -> dict[str, str]:
    """Settings for a run over ``input_bytes`` of Parquet on ``total_cores``.

    Shuffle partitions are sized so a partition of the largest shuffle (taken
    as the input size, the worst case of the full-row shuffles in the
    surrogate id and de-duplication) holds about ``partition_bytes``, and
    never fewer than two per core; AQE then coalesces small partitions and
    splits skewed ones.  Scan splits use the same target size.  Example:
    100 TB on 8,000 cores -> 409,600 shuffle partitions of 256 MB.
    """
    shuffle = max(2 * total_cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(broadcast_bytes),
    }


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a staged table (recursively) through the cluster's Hadoop
    file system, e.g. the shared checkpoint folder."""
    try:
        jvm = spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return bool(fs.delete(hpath, True))
    except Exception:   # best effort: a left-over staged copy is only disk
        return False
