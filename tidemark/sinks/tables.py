"""Named Parquet tables of the session catalog, changed by rewriting whole partitions.

Stock Spark only: ``CREATE TABLE .. USING parquet PARTITIONED BY``, and inserts that overwrite just the partitions
they hold rows for. What is written must be stored elsewhere first; Spark refuses to overwrite a table it
still reads. Tables are managed, so dropping a partition that lost its last row deletes its files.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The partition of rows without a time.
NO_DAY = "1000-01-01"
PARTS_PER_STATEMENT = 200
#: Up to so many keys are looked up by the Parquet Bloom filters, one by one.
MAX_LOOKUPS = 500
#: Share of row groups that a key which is not there makes Spark read in vain.
FALSE_HITS = "0.0001"


def day_of(moment: Column | str) -> Column:
    """The day of a timestamp as a partition value, never NULL."""
    return F.coalesce(F.to_date(moment), F.lit(NO_DAY).cast("date"))


def create_statement(
    name: str, schema: T.StructType, parts: Sequence[str] = (), lookups: Sequence[str] = (), defaults: Mapping[str, str] | None = None
) -> str:
    """``lookups``: columns with a Bloom filter per row group; ``defaults``: SQL of values an insert may leave out."""
    defaults = defaults or {}
    columns = ", ".join(
        f"{f.name} {f.dataType.simpleString()}" + (f" DEFAULT {defaults[f.name]}" if f.name in defaults else "") for f in schema.fields
    )
    options = {"parquet.bloom.filter.adaptive.enabled": "true"} if lookups else {}
    for column in lookups:
        options |= {f"parquet.bloom.filter.enabled#{column}": "true", f"parquet.bloom.filter.fpp#{column}": FALSE_HITS}
    stated = ", ".join(f"'{k}' = '{v}'" for k, v in options.items())
    return (
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"
        + (f" OPTIONS ({stated})" if options else "")
        + (f" PARTITIONED BY ({', '.join(parts)})" if parts else "")
    )


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for the time of a statement."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def partitions_of(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def overwrite_parts(name: str, rows: DataFrame, sort: Sequence[str] = ()) -> None:
    """Replace the partitions that ``rows`` has rows for; all others keep their files.

    Partitions are packed into files by size, so one large partition is written by many tasks.
    """
    spark = rows.sparkSession
    parts = partitions_of(spark, name)
    packed = rows.select(*spark.table(name).columns).hint("rebalance", *parts)
    if sort:
        packed = packed.sortWithinPartitions(*parts, *sort)
    # an option of the writer would be ignored here and the whole table replaced
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        packed.write.insertInto(name, overwrite=True)


def drop_parts(spark: SparkSession, name: str, parts: Sequence[Mapping[str, object]]) -> None:
    """Empty the listed partitions, many in one statement."""

    def stated(part: Mapping[str, object]) -> str:
        return f"PARTITION ({', '.join(f"{c} = '{v}'" for c, v in part.items())})"

    for start in range(0, len(parts), PARTS_PER_STATEMENT):
        listed = ", ".join(map(stated, parts[start : start + PARTS_PER_STATEMENT]))
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {listed}")


def in_parts(table: DataFrame, parts: DataFrame, least: Column | None = None) -> DataFrame:
    """The rows of the partitions listed in ``parts``; other partitions are not read.

    The list is joined, and prunes the scan at run time: its rows number at most the
    partitions of the table. Spark prunes only by a side that is itself filtered, hence the
    bound on the first column, which all its values meet: ``least``, or the least day.
    """
    first = parts.columns[0]
    listed = parts.where(F.col(first) >= (F.lit(NO_DAY).cast("date") if least is None else least))
    return table.join(F.broadcast(listed), parts.columns, "left_semi")


def replace_parts(name: str, touched: DataFrame, after: DataFrame, sort: Sequence[str] = ()) -> None:
    """Make the partitions listed in ``touched`` hold ``after``, which is stored; one without a row is dropped.

    Partitions are published one by one: after a failure the same call, from the same stored rows, completes it.
    """
    spark, parts = after.sparkSession, touched.columns
    emptied = touched.join(after.select(*parts).distinct(), parts, "left_anti").collect()
    overwrite_parts(name, after, sort)
    drop_parts(spark, name, [row.asDict() for row in emptied])


def with_keys(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``table`` that may hold one of ``keys`` (few enough: none other), by what the Parquet files tell.

    Few keys are looked up in the Bloom filter of each row group. Many are left to the statistics of
    the key range. Either way the caller joins afterwards, so this decides what is read, not the result.
    """
    few = [row[0] for row in keys.select(key).limit(MAX_LOOKUPS + 1).collect()]
    if len(few) <= MAX_LOOKUPS:
        return table.where(F.col(key).isin(few))
    low, high = keys.agg(F.min(key), F.max(key)).first()
    return table.where(F.col(key).between(low, high))


def lookups(spark: SparkSession):
    """Within it, a list of keys reaches the scan as so many equalities, which Bloom filters can answer."""
    return setting(spark, "spark.sql.parquet.pushdown.inFilterThreshold", str(MAX_LOOKUPS))
