"""Session set-up and the one place that decides where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(
    app_name: str = "tidemark", master: str | None = None, initial_partitions: int | None = None, **conf: str
) -> SparkSession:
    """A session with the settings the operators assume: UTC and adaptive execution.

    A shuffle starts with ``initial_partitions`` (``spark.sql.shuffle.partitions`` if not given),
    which adaptive execution coalesces or splits by observed bytes. Give about the largest
    shuffle in bytes over 128 MB.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if initial_partitions:
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", initial_partitions)
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: the session's own setting, or (local runs only) a new one."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="tidemark-checkpoint-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder for intermediate data of this session, below the shared checkpoint folder."""
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str = "settled") -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and read it from there.

    Later reads take the columns and filters they need, and a lost executor costs a read. The
    session that made such tables removes them with ``clear_scratch``.
    """
    folder = scratch_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def clear_scratch(spark: SparkSession) -> None:
    """Remove all intermediate data of this session. DataFrames that read it end with it."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)


def _scratch_root(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidemark-{spark.sparkContext.applicationId}"
