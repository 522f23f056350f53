"""Local session for tests and benchmarks (clusters bring their own)."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


# Settings the plans are designed for (a cluster sets them in its own session):
# AQE with skew-join splitting, and broadcasts decided only from sizes measured
# at runtime (a finished shuffle stage), never from file-size estimates, which
# understate in-memory size by the compression ratio.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
}


def cluster_conf(input_bytes: int, executor_cores: int, split_bytes: int = 512 << 20,
                 shuffled_share: float = 0.1, partition_bytes: int = 512 << 20) -> dict:
    """Partition sizing for a run over ``input_bytes`` of source data.

    * Scans: file splits of ``split_bytes``.
    * Shuffles: sized by what is shuffled, not by what is read.  Scans are pruned to
      a few columns and aggregates combine before they shuffle, so a stage carries
      about ``shuffled_share`` of the input; at ``partition_bytes`` each that gives
      the number of partitions, at least one for every core.  Every map task writes
      an index entry for every partition, so their product has to stay small: 100 TB
      on 8,000 cores is 200,000 map tasks by 20,480 partitions, some 33 GB of index,
      where a partition for each 256 MB of input would need over 1 TB.
    * AQE merges small partitions up to ``partition_bytes`` and splits skewed ones
      above 4 times the median and twice that size.
    """
    partitions = max(executor_cores, -(-int(input_bytes * shuffled_share) // partition_bytes))
    return {
        **RECOMMENDED_CONF,
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * partition_bytes),
    }


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables that the cluster names in
    ``spark.checkpoint.dir`` (or the session's checkpoint folder).

    Only a local session that names none (a test) gets one under the temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="kpiloom-"))
        base = spark.sparkContext.getCheckpointDir()
    return base.rstrip("/")


def local_session(cpus: int = 8, shuffle_partitions: int = 8,
                  app: str = "kpiloom") -> SparkSession:
    """A ``local[cpus]`` session with AQE on and the UI off.

    ``spark.checkpoint.dir`` is left alone when the environment already names
    one; otherwise a temporary folder is used (local sessions only).
    """
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.host", "127.0.0.1")
             .config("spark.driver.bindAddress", "127.0.0.1")
             .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "8g"))
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        ckpt = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="kpiloom-")
        spark.sparkContext.setCheckpointDir(ckpt)
    return spark
