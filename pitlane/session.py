"""Session settings and the shared staging folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators rely on; every one is a plain Spark option.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # 20-digit race ids must stay strings when a partitioned output is read back
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "pitlane", **conf) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in {**SESSION_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions), **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    It is read from the session.  When nothing is configured, a local master
    gets a fresh folder of its own; on a cluster that is an error, since
    executors would each write to their own disks.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share (master {master})")
        configured = tempfile.mkdtemp(prefix="pitlane-ckpt-")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir()


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for a written intermediate table."""
    return os.path.join(ensure_checkpoint_dir(spark), "pitlane", f"{name}-{uuid.uuid4().hex}")


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is on."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(conf).delete(p, True)
