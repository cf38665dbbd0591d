"""Spark session settings and the shared folder used for materialised tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every plan of this library relies on.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session (all are runtime-settable)."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-JVM session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sessionloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, prefix: str = "sessionloom") -> str:
    """A fresh folder name under the shared checkpoint directory.

    The directory comes from ``spark.checkpoint.dir``. Where that is unset, a
    local-mode session gets a temporary folder; on a cluster it is an error,
    because executors could not read each other's files there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="sessionloom-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{prefix}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give iterative fits a shared folder for their periodic checkpoints."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark, "checkpoint"))


def materialised(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage, survives lost executors, and later readers get column pruning and
    filter pushdown.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Spread a source that has fewer input splits than the session has cores; others stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
