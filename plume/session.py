"""SparkSession construction and cluster-safe scratch locations.

Every job in the library runs on whatever session the caller hands in; this
module only supplies a sensible builder for scripts and tests, plus the one
place that decides where lineage-cutting checkpoints live.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings a cluster run should have.  AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Additional settings for a large cluster (100 TB inputs).  Shuffles start
# wide and AQE coalesces them to ~256 MB partitions after measuring map
# output, so one setting serves both the day-sized and the line-item-sized
# stages; skewed join partitions above 5x the median (and 512 MB) are split.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.sortBeforeRepartition": "true",
}


def build_session(master: str | None = None, app: str = "plume",
                  shuffle_partitions: int | None = None,
                  conf: dict | None = None, cluster: bool = False) -> SparkSession:
    """Return a session with the library defaults (scripts and tests).

    ``cluster=True`` adds ``CLUSTER_CONF``.  Library functions never depend
    on these settings; they only size the work.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if cluster:
        settings.update(CLUSTER_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; invent one only when unset.

    On a cluster the setting names a shared folder every executor can reach,
    and its absence is an error.  Only a session whose master is one local
    process gets a private scratch folder.
    """
    conf_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        try:
            conf_dir = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            conf_dir = None
    master = spark.sparkContext.master
    one_process = master == "local" or master.startswith("local[")
    if not conf_dir and not one_process:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not conf_dir:
        conf_dir = tempfile.mkdtemp(prefix="plume-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir
