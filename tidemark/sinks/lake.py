"""Row-level changes for catalogs whose table format supports MERGE and DELETE.

Needs such a format's runtime on the classpath (for instance Iceberg). It is not part of
stock Spark, so the tests only check that Spark parses the statements.
``streaming.jobs.run_lake_layers`` is the path that uses them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_SOURCE = "_tidemark_source"


def create_statement(name: str, schema: T.StructType, day_source: str) -> str:
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    return f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING iceberg PARTITIONED BY (days({day_source}))"


def changes_statement(name: str, key: str, columns: Sequence[str]) -> str:
    """Upserts and deletes of one batch in a single commit, told apart by ``_deleted``."""
    assignments = ", ".join(f"held.{c} = fresh.{c}" for c in columns)
    values = ", ".join(f"fresh.{c}" for c in columns)
    return (
        f"MERGE INTO {name} AS held USING {_SOURCE} AS fresh ON held.{key} = fresh.{key} "
        "WHEN MATCHED AND fresh._deleted THEN DELETE "
        f"WHEN MATCHED THEN UPDATE SET {assignments} "
        f"WHEN NOT MATCHED AND NOT fresh._deleted THEN INSERT ({', '.join(columns)}) VALUES ({values})"
    )


def delete_statement(name: str, key: str) -> str:
    return f"DELETE FROM {name} WHERE {key} IN (SELECT {key} FROM {_SOURCE})"


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, day_source: str) -> None:
    database = name.rpartition(".")[0]
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(create_statement(name, schema, day_source))


def _with_source(source: DataFrame, statement: str) -> None:
    source.createOrReplaceTempView(_SOURCE)
    source.sparkSession.sql(statement)


def merge_changes(name: str, resolved: DataFrame, key: str, columns: Sequence[str]) -> None:
    _with_source(resolved, changes_statement(name, key, columns))


def delete_from(name: str, gone: DataFrame, key: str) -> None:
    _with_source(gone, delete_statement(name, key))


def append_to(name: str, rows: DataFrame) -> None:
    rows.writeTo(name).append()
