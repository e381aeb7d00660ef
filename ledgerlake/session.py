"""Session settings the jobs expect. A cluster sets its own master, memory and shared folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that change results or plans, whatever the cluster.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # INT96 timestamps carry no statistics, so files could not be skipped on them.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.parquet.compression.codec": "zstd",
    # Parquet files are several times smaller than their rows; size bounds should mean rows.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    # Recording the call site of every column expression costs more than building the plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(data_bytes: int, cores: int, partition_bytes: int = 200 * 1024 * 1024) -> dict[str, str]:
    """Settings for a cluster job over so much data: shuffles start with partitions that fit a task,
    and adaptive execution merges those that turn out small and splits those that turn out large."""
    partitions = max(2 * cores, -(-data_bytes // partition_bytes))
    return {
        **BASE_CONF,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * partition_bytes),
    }


def local_session(name: str = "ledgerlake", cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in BASE_CONF.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(partitions))
        # The test tables are files of one row group, which one task reads: a broadcast join would
        # leave the rest of the stage to that task, a shuffle join spreads it over the cores.
        .config("spark.sql.autoBroadcastJoinThreshold", "1m")
        .config("spark.driver.memory", os.environ.get("LEDGERLAKE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for written intermediates and checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without that setting
    gets a folder of its own; a cluster without it is an error, because a machine-local folder
    would not be visible to the executors.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = folder.get() if folder.isDefined() else None
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="ledgerlake-", dir="/tmp")
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")
