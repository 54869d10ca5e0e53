"""Session helpers: build a session for tests/bench, resolve the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "veilspark") -> SparkSession:
    """Local/test session. On a cluster the platform's session is used as is."""
    master = master or os.environ.get("VEILSPARK_MASTER", "local[*]")
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("VEILSPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only a local-mode session (tests) with nothing set
    gets a scratch folder of our own. On a cluster an unset folder is an error.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if conf_dir:
        spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir
    sc_dir = spark.sparkContext.getCheckpointDir()
    if sc_dir:
        return sc_dir
    if not spark.sparkContext.master.startswith("local"):
        # a machine-local folder would not survive the loss of an executor
        raise ValueError("spark.checkpoint.dir is not set: point it at a shared folder (HDFS, object store)")
    local = tempfile.mkdtemp(prefix="veilspark-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def cluster_settings(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 * 1024 ** 2) -> dict:
    """Starting points for a large run (set them on the cluster's session).

    * shuffle partitions: enough that each holds ~target bytes of the input
      (a generous upper bound on shuffled data), at least 2 per core; AQE then
      coalesces small ones and splits skewed ones at runtime.
    * input splits: 256 MB, so a 100 TB scan is ~400k tasks of bounded memory.
    """
    parts = max(2 * total_cores, -(-int(input_bytes) // int(target_partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
        "spark.sql.session.timeZone": "UTC",
    }
