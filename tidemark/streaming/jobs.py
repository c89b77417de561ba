"""Bronze, silver and gold as incremental Structured Streaming jobs over named tables.

Silver and gold are stock Parquet tables of the session catalog. A silver batch first stores its
*change rows* (what it found under each key and what it leaves there), then rewrites the partitions they touch. The
change rows make a failed batch repeatable, let gold follow silver without reading it, and lead back to earlier states.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemark import schemas
from tidemark.operators import changes, metrics, quality, series
from tidemark.plans import layers
from tidemark.schemas import BUCKET, DAY
from tidemark.session import settle
from tidemark.sinks import lake, tables
from tidemark.sinks.deadletter import write_dead_letters
from tidemark.sources.records import stream_lake_table, stream_table

PART = [DAY, BUCKET]
STEP, RUN = "_step", "_run"


def silver_schema(mode: str) -> T.StructType:
    return schemas.SILVER_VERSIONED if mode == changes.ORDERED else schemas.SILVER


@dataclass(frozen=True)
class Layout:
    """One deployment. ``root`` and ``checkpoints`` are folders on shared storage.

    Tables live in ``database``, made below ``root`` if it does not exist; without a name one is derived from
    ``root``. ``buckets``: how many parts by key a day of silver has; fixed once the table is made. Choose
    it so that a part is a few hundred MB, for a small batch rewrites whole parts.
    """

    root: str
    checkpoints: str
    buckets: int = 4
    database: str | None = None

    @property
    def bronze(self) -> str:
        return f"{self.root}/payments_bronze"

    @property
    def dead_letters(self) -> str:
        return f"{self.root}/payments_silver_dlq"

    @property
    def namespace(self) -> str:
        return self.database or f"tidemark_{hashlib.sha256(self.root.encode()).hexdigest()[:12]}"

    @property
    def folder(self) -> str:
        return f"{self.root}/catalog"

    def table(self, name: str) -> str:
        return f"{self.namespace}.{name}"

    @property
    def silver(self) -> str:
        return self.table("payments_silver")

    @property
    def change_log(self) -> str:
        return self.table("payments_silver_changes")

    @property
    def batches(self) -> str:
        return self.table("batches")

    @property
    def cells(self) -> str:
        """Gold as sums, kept by adding what silver changed."""
        return self.table("payment_metrics_cells")

    @property
    def gold(self) -> str:
        """Gold recomputed by the hour."""
        return self.table("payment_metrics_gold")

    def checkpoint(self, job: str) -> str:
        return f"{self.checkpoints}/{job}"

    def ensure(self, spark: SparkSession, mode: str = changes.REFERENCE) -> None:
        """Make the tables that do not exist yet."""
        if spark.catalog.tableExists(self.gold):
            return
        held, key = silver_schema(mode), changes.KEY
        part = {DAY: T.DateType(), BUCKET: T.IntegerType()}
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.namespace} LOCATION '{self.folder}'")
        for statement in (
            tables.create_statement(self.silver, schemas.extend(held, **part), PART, lookups=[key], defaults={"ingested_at": "current_timestamp()"}),
            tables.create_statement(self.change_log, schemas.change_rows(held), ["run", "batch"]),
            tables.create_statement(self.batches, schemas.BATCHES, ["run"], defaults={"taken_at": "current_timestamp()"}),
            tables.create_statement(self.cells, schemas.extend(schemas.CELLS, **{RUN: T.StringType(), STEP: T.LongType(), DAY: T.DateType()}), [DAY]),
            tables.create_statement(self.gold, schemas.with_day(schemas.GOLD), [DAY]),
        ):
            spark.sql(statement)

    def refresh(self, spark: SparkSession) -> None:
        """Let a session see what another one, as that of a stream, has written."""
        for name in (self.silver, self.change_log, self.batches, self.cells, self.gold):
            spark.catalog.refreshTable(name)

    # --- reading ---

    def read_silver(self, spark: SparkSession, mode: str = changes.REFERENCE) -> DataFrame:
        """The current rows."""
        rows = spark.table(self.silver).select(*silver_schema(mode).names)
        return changes.current_rows(rows) if mode == changes.ORDERED else rows

    def read_gold(self, spark: SparkSession) -> DataFrame:
        """Metrics of the cells that follow silver's changes."""
        return metrics.gold_of_cells(spark.table(self.cells)).select(*schemas.GOLD.names)

    def read_gold_by_hour(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.gold).select(*schemas.GOLD.names)


def silver_as_of(spark: SparkSession, layout: Layout, run: str, batch_id: int, mode: str = changes.REFERENCE) -> DataFrame:
    """The current rows as they were after a batch: later change rows taken back, earliest first."""
    key, held = changes.KEY, silver_schema(mode)
    later = spark.table(layout.change_log).where((F.col("run") == run) & (F.col("batch") > batch_id))
    found = later.groupBy(key).agg(F.min_by("before", "batch").alias("before"))
    kept = spark.table(layout.silver).select(*held.names).join(found.select(key), key, "left_anti")
    rows = kept.unionByName(found.where(F.col("before").isNotNull()).select("before.*"))
    return changes.current_rows(rows) if mode == changes.ORDERED else rows


def _drain(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    query = writer.trigger(availableNow=True).option("checkpointLocation", checkpoint).start()
    query.awaitTermination()
    return query


#: What tells one record from another. Offsets start anew when a topic is made again, times do not.
RECORD_ID = ["topic", "partition", "offset", "timestamp"]


def once(records: DataFrame, within: str) -> DataFrame:
    """A stream of records without those delivered before, as long as the first one is ``within`` past.

    The past is counted from arrival and not from the time of the record, so no late record is taken for an
    old one. What has been seen is kept in the state store, survives a restart, and is dropped behind the watermark.
    """
    arrived = records.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", within)
    return arrived.dropDuplicatesWithinWatermark(RECORD_ID).drop("_arrived")


def run_bronze(records: DataFrame, layout: Layout, redelivered_within: str | None = None) -> StreamingQuery:
    """Append new records, masked, to the raw log, partitioned by record day; the finished run.

    ``redelivered_within``: take a record that comes again within so long only once.
    """
    if redelivered_within:
        records = once(records, redelivered_within)
    rows = layers.stored_bronze(records).withColumn(DAY, F.to_date("kafka_timestamp"))
    writer = rows.writeStream.format("parquet").outputMode("append").partitionBy(DAY)
    return _drain(writer.option("path", layout.bronze), layout.checkpoint("bronze"))


def bronze_stream(spark: SparkSession, layout: Layout, max_files_per_trigger: int | None = None) -> DataFrame:
    rows = stream_table(spark, layout.bronze, schemas.with_day(schemas.BRONZE_STORED), max_files_per_trigger)
    return rows.select(*schemas.BRONZE_STORED.names)


def apply_batch(
    batch: DataFrame,
    batch_id: int,
    layout: Layout,
    mode: str = changes.REFERENCE,
    run: str = "manual",
    drop_tombstones: bool = False,
) -> int:
    """One raw-log batch into the silver table and the dead letters; the number of changed keys.

    Payloads are parsed once; dead letters are told by the stored route alone. The quality rules are
    counted while the outcomes are stored, and nothing is published unless all pass. A batch of this run that
    silver has taken changes nothing. Publishing is two steps: the change rows of the batch, then the parts they touch,
    which depend on the stored change rows and the untouched rest alone. So a batch that failed
    between or within them is completed by its retry, whatever it left behind.
    """
    spark = batch.sparkSession
    layout.ensure(spark, mode)
    this = (F.col("run") == run) & (F.col("batch") == batch_id)
    if not spark.table(layout.batches).where(this).isEmpty():
        return 0
    letters = changes.dead_letters(batch, batch_id, drop_tombstones=drop_tombstones)
    write_dead_letters(letters, layout.dead_letters, run, batch_id)
    images = spark.table(layout.change_log).where(this)
    changed = images.count()
    if not changed:
        outcomes = _checked_outcomes(batch, mode)
        with tables.lookups(spark):
            fresh = _change_rows(outcomes, layout, mode)
            tables.overwrite_parts(layout.change_log, fresh.withColumns({"run": F.lit(run), "batch": F.lit(batch_id).cast("long")}))
        images = spark.table(layout.change_log).where(this)
        changed = images.count()
    if changed:
        _rewrite_parts(images, layout, mode)
    spark.sql(f"INSERT INTO {layout.batches} (run, batch) VALUES (:run, :batch)", args={"run": run, "batch": batch_id})
    return changed


def _counters() -> list[Column]:
    """Rows that break each quality rule. Keys are unique after resolution, so no rule on repeats is needed."""
    return [F.count_if(F.col("_upserted") & bad).alias(name) for name, bad in quality.payment_rules().items()]


def _checked_outcomes(batch: DataFrame, mode: str) -> DataFrame:
    """The stored outcomes of a batch; the rules are counted by the job that stores them."""
    counted = Observation()
    outcomes = settle(changes.resolve(changes.decode(batch), mode).observe(counted, *_counters()), "outcomes")
    quality.raise_on_failures(counted.get)
    return outcomes


def _change_rows(outcomes: DataFrame, layout: Layout, mode: str) -> DataFrame:
    """``(payment_id, before, after)`` of the keys that a batch changes.

    Silver is read by the keys: few of them are looked up in the Bloom filters of its files, many
    are left to the join, which adaptive execution sizes.
    """
    spark, key, held = outcomes.sparkSession, changes.KEY, silver_schema(mode)
    found = tables.with_keys(spark.table(layout.silver), outcomes, key).select(key, F.struct(*held.names).alias("before"))
    outcomes = outcomes.withColumn("ingested_at", F.current_timestamp())
    if mode == changes.ORDERED:
        # a tombstone stays in the day of the row it replaces
        was = F.col("before.created_at")
        created = F.when(F.col("_deleted"), F.coalesce(was, "created_at")).otherwise(F.col("created_at"))
        after = F.struct(*[created.alias(c) if c == "created_at" else F.col(c) for c in held.names])
        wanted = F.col("before").isNull() | (F.col("before._version") < F.col("_version"))
    else:
        after = F.when(~F.col("_deleted"), F.struct(*held.names))
        wanted = F.col("before").isNotNull() | ~F.col("_deleted")
    met = outcomes.join(found, key, "left").where(wanted)
    return met.select(key, "before", after.alias("after"))


def _with_part(rows: DataFrame, layout: Layout, moment: str = "created_at", key: str = changes.KEY) -> DataFrame:
    bucket = F.pmod(F.xxhash64(key), F.lit(layout.buckets)).cast("int")
    return rows.withColumns({DAY: tables.day_of(moment), BUCKET: bucket})


def _rewrite_parts(images: DataFrame, layout: Layout, mode: str) -> None:
    """Silver with the change rows carried out, part by touched part."""
    spark, key = images.sparkSession, changes.KEY
    ends = images.select(key, F.explode(F.array("before", "after")).alias("row")).where(F.col("row").isNotNull())
    touched = _with_part(ends.select("row.*"), layout).select(*PART).distinct()
    touched = settle(touched, "touched")
    base = tables.in_parts(spark.table(layout.silver), touched)
    new = _with_part(images.where(F.col("after").isNotNull()).select("after.*"), layout)
    after = base.join(images.select(key), key, "left_anti").unionByName(new)
    tables.replace_parts(layout.silver, touched, settle(after, "after"), [key])


def apply_batch_to_lake(batch: DataFrame, batch_id: int, silver: str, dead_letters: str) -> None:
    """``apply_batch`` for named tables of a format with MERGE: one commit per table."""
    resolved = changes.resolve(changes.decode(batch)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        quality.raise_on_failures(resolved.agg(*_counters()).first().asDict())
        stamped = resolved.withColumn("ingested_at", F.current_timestamp())
        lake.merge_changes(silver, stamped, changes.KEY, schemas.SILVER.names)
        # last, so that a batch that fails its rules and is retried adds no letters
        lake.append_to(dead_letters, changes.dead_letters(batch, batch_id))
    finally:
        resolved.unpersist()


def run_silver(
    spark: SparkSession,
    layout: Layout,
    mode: str = changes.REFERENCE,
    max_files_per_trigger: int | None = None,
    drop_tombstones: bool = False,
) -> str:
    """Fold new raw-log rows into the current-state table, batch by batch; the name of the run."""
    layout.ensure(spark, mode)
    run = run_name(spark, layout.checkpoint("silver"))
    writer = bronze_stream(spark, layout, max_files_per_trigger).writeStream.foreachBatch(
        lambda batch, batch_id: apply_batch(batch, batch_id, layout, mode, run, drop_tombstones)
    )
    _drain(writer, layout.checkpoint("silver"))
    layout.refresh(spark)
    return run


def run_name(spark: SparkSession, checkpoint: str) -> str:
    """A name that lasts as long as the checkpoint, so a retried batch finds its own folder."""
    path = f"{checkpoint}-run"
    file = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(file):
        return spark.read.text(path).first().value
    name = uuid.uuid4().hex
    spark.createDataFrame([(name,)], "value STRING").coalesce(1).write.text(path)
    return name


def change_stream(spark: SparkSession, layout: Layout, mode: str = changes.REFERENCE) -> DataFrame:
    """Silver's change rows as they are stored, batch after batch."""
    path = f"{layout.folder}/{layout.change_log.rpartition('.')[2]}"
    return stream_table(spark, path, schemas.change_rows(silver_schema(mode)))


def apply_deltas(images: DataFrame, batch_id: int, layout: Layout, run: str = "manual") -> None:
    """Take old images from, and add new images to, the metric cells; silver is not read.

    Only the days of the images are read and rewritten. Every row of a day names the step that wrote it
    last, and cells that net to nothing stay as zeros: so a retried step leaves out the days it had finished.
    """
    spark = images.sparkSession
    deltas = metrics.hourly_cells(metrics.signed_payments(images)).withColumn(DAY, tables.day_of("payment_hour"))
    deltas = settle(deltas, "deltas")
    days = deltas.select(DAY).distinct()
    held = tables.in_parts(spark.table(layout.cells), days)
    this = (F.col(RUN) == run) & (F.col(STEP) >= batch_id)
    done = held.where(this).select(DAY).distinct()
    cells = metrics.add_cells(held.join(done, DAY, "left_anti"), deltas.join(done, DAY, "left_anti"))
    marked = cells.withColumns({RUN: F.lit(run), STEP: F.lit(batch_id).cast("long"), DAY: tables.day_of("payment_hour")})
    after = settle(marked, "cells")
    if not after.isEmpty():
        tables.overwrite_parts(layout.cells, after)


def run_gold(spark: SparkSession, layout: Layout, mode: str = changes.REFERENCE) -> None:
    """Bring the metric cells up to date with the change rows silver has stored since."""
    layout.ensure(spark, mode)
    run = run_name(spark, layout.checkpoint("gold"))
    if not spark.table(layout.cells).where(F.col(RUN) != run).isEmpty():
        # cells of a lost checkpoint: this run starts from the first change again
        spark.sql(f"TRUNCATE TABLE {layout.cells}")
    writer = change_stream(spark, layout, mode).writeStream.foreachBatch(
        lambda images, step: apply_deltas(images, step, layout, run)
    )
    _drain(writer, layout.checkpoint("gold"))
    layout.refresh(spark)


def refresh_hours(hours: DataFrame, layout: Layout, mode: str = changes.REFERENCE) -> None:
    """Recompute the listed hours from silver; other hours of their days are kept.

    The days prune both tables at run time, as partition filters.
    """
    spark = hours.sparkSession
    hours = settle(hours.select("payment_hour").distinct(), "hours")
    days = hours.select(tables.day_of("payment_hour").alias(DAY)).distinct()
    rows = tables.in_parts(spark.table(layout.silver), days).drop(*PART)
    live = changes.current_rows(rows) if mode == changes.ORDERED else rows
    named = hours.select(F.col("payment_hour").alias("_hour"))
    same = F.col("payment_hour").eqNullSafe(F.col("_hour"))
    cells = metrics.hourly_metrics(live).join(named, same, "left_semi").select(*schemas.GOLD.names)
    kept = tables.in_parts(spark.table(layout.gold), days).drop(DAY).join(named, same, "left_anti")
    after = settle(kept.unionByName(cells).withColumn(DAY, tables.day_of("payment_hour")), "hours-after")
    tables.replace_parts(layout.gold, settle(days, "days"), after, ["payment_hour"])


def apply_gold_batch(batch: DataFrame, layout: Layout, mode: str = changes.REFERENCE, both_images: bool = True) -> None:
    """Recompute the hours that a raw-log batch names."""
    refresh_hours(metrics.affected_hours(changes.creation_times(batch), both_images), layout, mode)


def run_gold_from_events(
    spark: SparkSession,
    layout: Layout,
    mode: str = changes.REFERENCE,
    both_images: bool = True,
    max_files_per_trigger: int | None = None,
) -> None:
    """``apply_gold_batch`` over new raw-log rows; run it after silver has taken them in."""
    layout.ensure(spark, mode)
    writer = bronze_stream(spark, layout, max_files_per_trigger).writeStream.foreachBatch(
        lambda batch, _: apply_gold_batch(batch, layout, mode, both_images)
    )
    _drain(writer, layout.checkpoint("gold-events"))
    layout.refresh(spark)


def run_gold_from_changes(spark: SparkSession, layout: Layout, mode: str = changes.REFERENCE) -> None:
    """Recompute every hour that silver's change rows name: also of deletes that log only a key."""
    layout.ensure(spark, mode)

    def refresh(images: DataFrame, _: int) -> None:
        hour = F.date_trunc("hour", "created_at").alias("payment_hour")
        refresh_hours(metrics.signed_payments(images).select(hour), layout, mode)

    _drain(change_stream(spark, layout, mode).writeStream.foreachBatch(refresh), layout.checkpoint("gold-changes"))
    layout.refresh(spark)


def run_layers(
    records: DataFrame,
    layout: Layout,
    mode: str = changes.REFERENCE,
    max_files_per_trigger: int | None = None,
    drop_tombstones: bool = False,
) -> None:
    """Bronze, silver and gold in order over what has arrived.

    ``max_files_per_trigger`` bounds a silver batch. It is the caller's to set: in ``reference``
    mode the outcome of a key depends on where its events are cut into batches.
    """
    spark = records.sparkSession
    run_bronze(records, layout)
    run_silver(spark, layout, mode, max_files_per_trigger, drop_tombstones)
    run_gold(spark, layout, mode)


def run_last_values(
    samples: DataFrame, layout: Layout, name: str, keys: Sequence[str], value: str, order: Sequence[str]
) -> None:
    """Keep the newest non-NULL value of every series in the table ``name``; late samples change nothing.

    The newest value is a running aggregate, one row of state per series. A batch gives out the series it
    has moved, whole, so they are put into the table by key and a repeated batch leaves it as it is. Only the parts of
    these series are read and rewritten. A NULL in ``keys`` is a value like others.
    """
    spark, table = samples.sparkSession, layout.table(name)
    newest = series.last_value(samples, keys, value, order)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layout.namespace} LOCATION '{layout.folder}'")
    spark.sql(tables.create_statement(table, schemas.extend(newest.schema, **{BUCKET: T.IntegerType()}), [BUCKET]))

    def put(moved: DataFrame, _: int) -> None:
        bucket = F.pmod(F.xxhash64(*keys), F.lit(layout.buckets)).cast("int")
        moved = settle(moved.withColumn(BUCKET, bucket), "moved")
        held = tables.in_parts(moved.sparkSession.table(table), moved.select(BUCKET).distinct(), F.lit(0))
        named = moved.select(*[F.col(k).alias(f"_{k}") for k in keys])
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
        after = settle(held.join(named, same, "left_anti").unionByName(moved), "last-values")
        if not moved.isEmpty():
            tables.overwrite_parts(table, after)

    _drain(newest.writeStream.outputMode("update").foreachBatch(put), layout.checkpoint(name))
    spark.catalog.refreshTable(table)


def run_orphans(orphans: DataFrame, layout: Layout, name: str) -> str:
    """Append what ``quality.orphans_in_motion`` gives out to a folder of Parquet files; its path."""
    path = f"{layout.root}/{name}"
    _drain(orphans.writeStream.format("parquet").outputMode("append").option("path", path), layout.checkpoint(name))
    return path


@dataclass(frozen=True)
class LakeLayout:
    """Table names of a deployment on a catalog whose format supports MERGE."""

    bronze: str
    silver: str
    gold: str
    dead_letters: str
    checkpoints: str


def run_lake_layers(records: DataFrame, layout: LakeLayout) -> None:
    """The three layers over named tables, which are made if they do not exist."""
    spark = records.sparkSession
    for name, schema, day_source in (
        (layout.bronze, schemas.BRONZE_STORED, "kafka_timestamp"),
        (layout.silver, schemas.SILVER, "created_at"),
        (layout.gold, schemas.GOLD, "payment_hour"),
        (layout.dead_letters, schemas.DEAD_LETTER, "ingested_at"),
    ):
        lake.ensure_table(spark, name, schema, day_source)
    raw = layers.stored_bronze(records).writeStream.format("iceberg").outputMode("append")
    raw.trigger(availableNow=True).option("checkpointLocation", f"{layout.checkpoints}/bronze").toTable(layout.bronze).awaitTermination()
    for job, apply in (
        ("silver", lambda batch, number: apply_batch_to_lake(batch, number, layout.silver, layout.dead_letters)),
        ("gold", lambda batch, _: apply_gold_batch_to_lake(batch, layout.silver, layout.gold)),
    ):
        writer = stream_lake_table(spark, layout.bronze).writeStream.foreachBatch(apply)
        _drain(writer, f"{layout.checkpoints}/{job}")


def apply_gold_batch_to_lake(batch: DataFrame, silver: str, gold: str) -> None:
    """Replace the hours a batch names: deleted first, so an hour without rows is emptied too."""
    hours = metrics.affected_hours(changes.creation_times(batch), both_images=True).persist()
    try:
        lake.delete_from(gold, hours, "payment_hour")
        cells = metrics.hourly_metrics(metrics.in_hours(batch.sparkSession.table(silver), hours))
        lake.append_to(gold, cells.select(*schemas.GOLD.names))
    finally:
        hours.unpersist()
