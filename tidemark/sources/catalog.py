"""Table and column metadata as DataFrames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

_COLUMNS = "table_name STRING, column_name STRING, ordinal INT"


def columns_of(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row per column of each frame, with its position."""
    spark = next(iter(frames.values())).sparkSession
    rows = [
        (table, column, position)
        for table, frame in frames.items()
        for position, column in enumerate(frame.columns, start=1)
    ]
    return spark.createDataFrame(rows, _COLUMNS)


def catalog_columns(spark: SparkSession, *tables: str) -> DataFrame:
    """The same for tables registered in the session catalog."""
    return columns_of({table: spark.table(table).limit(0) for table in tables})


def visible_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    """Names of the tables a reader of ``database`` can see."""
    return sorted(t.name for t in spark.catalog.listTables(database))
