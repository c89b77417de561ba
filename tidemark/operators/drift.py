"""Column contracts: which source columns nobody has decided about."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.fixed_values import CONTRACTS
from tidemark.sources.catalog import columns_of

Contracts = Mapping[str, tuple[Iterable[str], Iterable[str]]]


class SchemaDriftError(ValueError):
    """At least one table has undecided columns; ``drift`` maps table to columns."""

    def __init__(self, drift: Mapping[str, list[str]]):
        lines = "; ".join(f"{table}: {columns}" for table, columns in drift.items())
        super().__init__(f"schema drift in {len(drift)} table(s): {lines}")
        self.drift = dict(drift)


def contract_table(spark: SparkSession, contracts: Contracts = CONTRACTS) -> DataFrame:
    rows = [
        (table, column, disposition)
        for table, (mapped, excluded) in contracts.items()
        for disposition, columns in (("mapped", mapped), ("excluded", excluded))
        for column in columns
    ]
    return spark.createDataFrame(rows, "table_name STRING, column_name STRING, disposition STRING")


def schema_drift(columns: DataFrame, contract: DataFrame) -> DataFrame:
    """Columns present in the source and absent from the contract. Removed ones are no drift."""
    return (
        columns.join(contract, ["table_name", "column_name"], "left_anti")
        .select("table_name", "column_name")
        .orderBy("table_name", "column_name")
    )


def check_drift(columns: DataFrame, contract: DataFrame) -> None:
    """Raise once, naming every drifted table. The rows are column names, not data."""
    drift: dict[str, list[str]] = {}
    for row in schema_drift(columns, contract).collect():
        drift.setdefault(row.table_name, []).append(row.column_name)
    if drift:
        raise SchemaDriftError(drift)


def drifted_fill(df: DataFrame, table: str, contracts: Contracts) -> DataFrame:
    """For each undecided column of ``df``: how many rows already carry a value in it.

    The undecided columns are those that ``schema_drift`` finds: the frame's columns against
    the contract table. Their names reach the driver, and only they are read, in one pass.
    """
    spark = df.sparkSession
    drifted = schema_drift(columns_of({table: df}), contract_table(spark, {table: contracts[table]}))
    loose = [row.column_name for row in drifted.collect()]
    if not loose:
        return drifted.withColumn("filled_rows", F.lit(0).cast("bigint"))
    counted = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in loose])
    filled = counted.unpivot([], loose, "column_name", "filled_rows")
    return drifted.join(filled, "column_name").select("table_name", "column_name", "filled_rows").orderBy("column_name")


def payload_drift(raw_log: DataFrame, known: Iterable[str], section: str = "after") -> DataFrame:
    """Payload keys that occur in the log and are not ``known``, with their record counts.

    Keys are counted before the shuffle, so it carries one row per distinct key and task.
    """
    image = F.from_json("kafka_value", f"{section} MAP<STRING, STRING>")[section]
    keys = raw_log.select(F.explode(F.array_distinct(F.map_keys(image))).alias("column_name"))
    return (
        keys.where(~F.col("column_name").isin(*known))
        .groupBy("column_name")
        .agg(F.count("*").alias("records"))
    )


#: Kinds of JSON values, by the type that a variant has.
KINDS = {
    "BIGINT": "number", "DECIMAL": "number", "DOUBLE": "number", "FLOAT": "number", "STRING": "text",
    "BOOLEAN": "boolean", "VOID": "null", "OBJECT": "object", "ARRAY": "array",
}


def _kind(value: Column) -> Column:
    name = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    return F.element_at(F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair]), name)


def _inside(node: Column) -> Column:
    """Fields of an object and elements of an array as ``(path, value)``; of anything else, none."""
    fields = F.map_entries(F.try_variant_get(node["value"], "$", "map<string,variant>"))
    elements = F.try_variant_get(node["value"], "$", "array<variant>")
    below = F.when(node["path"] == "", "").otherwise(F.concat(node["path"], F.lit(".")))
    none = F.expr("CAST(array() AS array<struct<path: string, value: variant>>)")
    return F.coalesce(
        F.transform(fields, lambda e: F.struct(F.concat(below, e["key"]).alias("path"), e["value"].alias("value"))),
        F.transform(elements, lambda e: F.struct(F.concat(node["path"], F.lit("[]")).alias("path"), e.alias("value"))),
        none,
    )


def _told(node: Column) -> Column:
    return F.struct(node["path"].alias("path"), _kind(node["value"]).alias("kind"))


def _told_last(node: Column) -> Column:
    kind = _kind(node["value"])
    unread = F.when(F.size(_inside(node)) > 0, F.concat(F.lit("unread "), kind)).otherwise(kind)
    return F.struct(node["path"].alias("path"), unread.alias("kind"))


def payload_kinds(raw_log: DataFrame, depth: int = 5, value: str = "kafka_value") -> DataFrame:
    """``(path, kind, records)``: which kinds of values each field has, at any level, in how many records.

    Paths are dotted, the elements of an array are ``name[]``. One pass, one parse per record; paths are
    counted before the shuffle, so it carries one row per path, kind and task. A field at level ``depth`` that
    still holds something is told as ``unread object`` or ``unread array``. Text that is not JSON is left out.
    """
    root = F.struct(F.lit("").alias("path"), F.try_parse_json(value).alias("value"))
    level, found = _inside(root), []
    for step in range(depth):
        raw_log = raw_log.withColumn(f"_{step}", level)
        found.append(F.transform(f"_{step}", _told if step < depth - 1 else _told_last))
        level = F.flatten(F.transform(f"_{step}", _inside))
    kinds = raw_log.select(F.explode(F.array_distinct(F.concat(*found))).alias("k")).select("k.path", "k.kind")
    return kinds.groupBy("path", "kind").agg(F.count("*").alias("records"))


def type_drift(raw_log: DataFrame, contract: Mapping[str, str], depth: int = 5) -> DataFrame:
    """``(path, kind, expected, records)``: fields whose kind is not that of the contract.

    ``expected`` is NULL for a field the contract does not name. JSON null has every kind.
    """
    spark = raw_log.sparkSession
    agreed = spark.createDataFrame(list(contract.items()), "path STRING, expected STRING")
    met = payload_kinds(raw_log, depth).where(F.col("kind") != "null").join(agreed, "path", "left")
    return met.where(~F.col("kind").eqNullSafe(F.col("expected"))).select("path", "kind", "expected", "records")
