"""Session defaults and the shared folder for checkpoints and scratch tables."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime options every plan of this library is written for. A hot join key is split by
# AQE even when the split costs another shuffle, which a single huge task would exceed.
RUNTIME_OPTIONS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app: str = "tallyline", cpus: str = "*", shuffle_partitions: int = 8, shared: str | None = None) -> SparkSession:
    """A local session for tests and the bench; on a cluster the launcher supplies one. shared: its checkpoint folder."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # Wide reports build thousands of column objects; recording a call site for each takes longer than planning.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    for key, value in RUNTIME_OPTIONS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """A folder all executors can reach: spark.checkpoint.dir, or the warehouse where that is not set.

    The warehouse is by default a folder of the driver's machine, which the executors of a cluster can't see: that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    folder = spark.conf.get("spark.sql.warehouse.dir")
    if folder.startswith("file:") and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{folder.rstrip('/')}/scratch"


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared folder, never reused between runs."""
    return f"{shared_folder(spark).rstrip('/')}/tallyline-{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """The table written once as Parquet and read back: later uses see the same rows, and a lost executor loses nothing."""
    path = scratch_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
