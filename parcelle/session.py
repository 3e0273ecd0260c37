"""Session construction and the shared checkpoint folder.

The cluster names a shared folder in ``spark.checkpoint.dir``; every job that
cuts lineage (kNN rounds, forests, boosting rounds) writes there.  Only when
the setting is absent *and* Spark runs in local mode (tests, bench) do we make
our own folder.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


MiB = 1024 * 1024


def sized_conf(input_bytes: int, target_partition_bytes: int = 256 * MiB,
               min_partitions: int = 200, max_partitions: int | None = None) -> dict:
    """Partition sizing for an input of ``input_bytes`` (compressed on disk).

    Scan splits and shuffle partitions both aim at ``target_partition_bytes``
    so one task's share fits in executor memory without spilling; the shuffle
    starts at one partition per target size of input (at least
    ``min_partitions``) and AQE merges the small ones and splits skewed ones
    at run time.  A caller may cap the count (map tasks × reduce partitions
    shuffle blocks grow quadratically); by default it follows the input."""
    n = max(min_partitions, -(-int(input_bytes) // target_partition_bytes))
    n = min(n, max_partitions or n)
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }


def get_spark(master: str | None = None, app: str = "parcelle",
              shuffle_partitions: int | None = None,
              extra: dict | None = None, input_bytes: int | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if input_bytes:
        conf.update(sized_conf(input_bytes))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder for the cluster")
    local = tempfile.mkdtemp(prefix="parcelle-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    import uuid
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"
