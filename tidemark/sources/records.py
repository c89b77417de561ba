"""Record-log and table scans, streaming and batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark import schemas


def kafka_records(
    spark: SparkSession, bootstrap: str, topic: str, starting_offsets: str = "earliest", **options: str
) -> DataFrame:
    """A topic as a stream. Needs Spark's Kafka connector on the classpath."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    return reader.options(**options).load()


def file_records(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The same record schema read as a stream from Parquet files dropped into ``path``."""
    return stream_table(spark, path, schemas.KAFKA_RECORD, max_files_per_trigger)


def stream_table(
    spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int | None = None
) -> DataFrame:
    """New rows of an append-only Parquet table, as a stream."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def stream_lake_table(spark: SparkSession, name: str) -> DataFrame:
    """New rows of an Iceberg table, as a stream. Needs the Iceberg runtime and a catalog."""
    return spark.readStream.format("iceberg").load(name)


def batch_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def relational_table(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    lower: int,
    upper: int,
    partitions: int,
    **options: str,
) -> DataFrame:
    """A JDBC table read in ``partitions`` key ranges. Needs the driver jar.

    The bounds only shape the ranges; rows outside them are still read.
    """
    return (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("partitionColumn", key)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", partitions)
        .options(**options)
        .load()
    )
