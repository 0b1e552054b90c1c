"""Session helpers: a tuned local session and lineage cuts in shared storage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, shuffle_partitions: int | None = None, memory: str = "8g") -> SparkSession:
    """Session for tests and benchmarks. On a cluster, pass your own session to the operators."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tradeflow")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # Windows cost far more CPU per byte than the default merge size of small partitions assumes.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def is_local(master: str) -> bool:
    """Whether driver and executors are one process."""
    return master == "local" or master.startswith("local[")


def one_machine(master: str) -> bool:
    """Whether all executors run on the driver's machine."""
    return is_local(master) or master.startswith("local-cluster[")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: what ``spark.checkpoint.dir`` names.

    Only a local session without that setting and without a checkpoint folder (a test) gets a fresh
    temporary folder; on a cluster, where each machine would write to its own disk, that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not is_local(spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tradeflow-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so later reads neither recompute it nor lose it with an executor."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: later readers take only the columns they need."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
