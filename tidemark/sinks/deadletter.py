"""Dead-letter table, partitioned by the day a letter was taken in."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.schemas import DAY


def write_dead_letters(letters: DataFrame, path: str, run: str, batch_id: int) -> None:
    """Write one batch's letters below their days; a batch without letters leaves no folder.

    A retried batch replaces what its first attempt left, on whatever day that was, so nothing
    is listed twice. ``run`` tells apart batch numbers of different checkpoints.
    """
    root = path.rstrip("/")
    _remove(letters.sparkSession, f"{root}/{DAY}=*/run={run}/batch={batch_id}")
    placed = letters.select(*schemas.DEAD_LETTER.names).withColumns(
        {DAY: F.to_date("ingested_at"), "run": F.lit(run), "batch": F.lit(batch_id)}
    )
    # letters are few and scattered: rebalancing packs them into few files
    placed.hint("rebalance", DAY).write.mode("append").partitionBy(DAY, "run", "batch").parquet(root)


def read_dead_letters(spark: SparkSession, path: str, keep_day: bool = False) -> DataFrame:
    """All letters; none before the first batch. Filters on the day prune folders."""
    schema = schemas.with_day(schemas.DEAD_LETTER)
    columns = [*schemas.DEAD_LETTER.names, *([DAY] if keep_day else [])]
    try:
        return spark.read.schema(schema).parquet(path).select(*columns)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema).select(*columns)


def _remove(spark: SparkSession, pattern: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for found in files.globStatus(path) or ():
        files.delete(found.getPath(), True)
