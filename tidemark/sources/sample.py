"""Change log, payments and refunds derived from the ``events`` test table.

Each view is a plain projection of ``events`` (no shuffle, no window), so a query plan
shows only the operator under test and its work grows with the table. The record log and
the raw log are written once per session and then scanned, as a stored log would be. What is
dealt to tasks evenly are the narrow events; the wide records made of them are never shuffled.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.plans import layers
from tidemark.session import scratch_folder
from tidemark.sinks.tables import setting

TOPIC = "cdc.public.payments"
UTC_NAMES = ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")
#: When the topic was made again: offsets before it are higher than those after it.
RESTART, OLD_TOPIC = datetime(2024, 1, 20), 1_300_000_000
#: Shuffled bytes of events per task and file; a record is many times wider than its event.
EVENTS_PER_FILE = "4m"

_stored: dict[tuple[str, str, str], str] = {}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in UTC_NAMES:
        raise ValueError(f"the session's time zone is {zone}; the test tables are in UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _store_once(spark: SparkSession, sf_dir: str, name: str, build) -> str:
    """Folder holding ``build()`` for this session, in the shared checkpoint folder."""
    slot = (spark.sparkContext.applicationId, sf_dir, name)
    if slot not in _stored:
        folder = scratch_folder(spark, f"sample-{name}")
        with setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", EVENTS_PER_FILE):
            build().write.parquet(folder)
        _stored[slot] = folder
    return _stored[slot]


def record_folder(spark: SparkSession, sf_dir: str) -> str:
    # dealt by a column: a round robin would first sort every row
    build = lambda: change_records(load(spark, sf_dir, "events").drop("props").hint("rebalance", "event_id"))
    return _store_once(spark, sf_dir, "records", build)


def record_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary message-log records."""
    return spark.read.schema(schemas.KAFKA_RECORD).parquet(record_folder(spark, sf_dir))


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored raw log: masked, with the route of each event beside it."""
    build = lambda: layers.stored_bronze(record_log(spark, sf_dir))
    folder = _store_once(spark, sf_dir, "bronze", build)
    return spark.read.schema(schemas.BRONZE_STORED).parquet(folder)


def _pick(selector: Column, *values: str | None) -> Column:
    """``values[selector]`` as a CASE, the last value being the default."""
    chosen = F.when(selector == 0, F.lit(values[0]))
    for position, value in enumerate(values[1:-1], start=1):
        chosen = chosen.when(selector == position, F.lit(value))
    return chosen.otherwise(F.lit(values[-1]))


def change_rows(events: DataFrame) -> DataFrame:
    """One structured change per event, before it is wrapped in JSON."""
    event_id, user_id = F.col("event_id"), F.col("user_id")
    at = F.col("ts").cast("timestamp")
    payment_id = user_id * 10 + event_id % 10
    # creation: fixed per payment, 2023-12-01 plus a quarter second and up to 29 days
    created = F.timestamp_micros(
        F.lit(1_701_388_800_250_000) + (payment_id * 37) % 41_760 * 60_000_000
    )
    moved = F.when(event_id % 53 == 0, created + F.expr("INTERVAL 3 HOURS")).otherwise(created)
    updated = (
        F.when(event_id % 29 == 3, at - F.expr("INTERVAL 2 HOURS"))
        .when(event_id % 31 == 1, F.date_trunc("day", at))
        .otherwise(at)
    )
    op = (
        F.when(event_id % 97 == 5, F.lit(None))
        .when(event_id % 89 == 7, F.lit("t"))
        .when(F.col("event_type") == "error", F.lit("d"))
        .when(F.col("event_type") == "signup", F.lit("c"))
        .when(event_id % 11 == 0, F.lit("r"))
        .otherwise(F.lit("u"))
    )
    return events.select(
        payment_id.alias("payment_id"),
        (user_id % 10 + 1).alias("merchant_id"),
        user_id.alias("shopper_id"),
        F.col("value").cast("decimal(12,2)").alias("amount"),
        _pick(event_id % 3, "EUR", " usd", "Gbp ").alias("currency"),
        _pick(
            event_id % 7,
            "card", " PayPal", "Apple  Pay", "Bank Transfer ", "google_pay", "CARD", "Google Pay",
        ).alias("payment_method"),
        _pick(
            event_id % 6,
            "Authorized", "failed", "REFUNDED", "pending", " authorized", "chargeback",
        ).alias("payment_status"),
        _pick(user_id % 8, " nl", "US", "de", "BE ", "FR", "gb", "CA", "ES").alias("country_code"),
        op.alias("op"),
        moved.alias("created_at"),
        created.alias("first_created_at"),
        updated.alias("updated_at"),
        (payment_id % 3).cast("int").alias("kafka_partition"),
        F.when(at < F.lit(RESTART), event_id + OLD_TOPIC).otherwise(event_id).alias("kafka_offset"),
        at.alias("kafka_timestamp"),
    )


def change_records(events: DataFrame) -> DataFrame:
    """``change_rows`` as binary message-log records holding JSON envelopes."""
    rows = change_rows(events)
    op = F.col("op")

    def image(created: Column, full: Column) -> Column:
        def unless_key_only(c: Column) -> Column:
            return F.when(full, c)

        return F.struct(
            F.col("payment_id"),
            F.col("merchant_id"),
            F.col("shopper_id"),
            F.col("amount").cast("string").alias("amount"),
            F.col("currency"),
            F.col("payment_method"),
            F.col("payment_status"),
            F.col("country_code"),
            unless_key_only(F.unix_micros(created)).alias("created_at"),
            unless_key_only(F.unix_micros(F.col("updated_at"))).alias("updated_at"),
        )

    # one delete in thirteen carries no timestamps, as when only the key is logged
    before = F.when(
        op.isin("u", "d"),
        image(F.col("first_created_at"), ~((op == "d") & (F.col("kafka_offset") % 13 == 0))),
    )
    after = F.when(op != "d", image(F.col("created_at"), F.lit(True)))
    envelope = F.to_json(
        F.struct(before.alias("before"), after.alias("after"), op.alias("op")),
        {"ignoreNullFields": "false"},
    )
    value = F.when(op.isNotNull(), envelope).when(F.col("kafka_offset") % 2 == 0, F.lit("not-json"))
    return rows.select(
        F.to_json(F.struct("payment_id")).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("kafka_timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def payments(events: DataFrame) -> DataFrame:
    """Clean payments, one per event."""
    event_id, user_id = F.col("event_id"), F.col("user_id")
    at = F.col("ts").cast("timestamp")
    return events.select(
        event_id.alias("payment_id"),
        (user_id % 10 + 1).alias("merchant_id"),
        user_id.alias("shopper_id"),
        F.col("value").cast("decimal(12,2)").alias("amount"),
        _pick(event_id % 4, "EUR", "USD", "GBP", "CAD").alias("currency"),
        _pick(event_id % 5, "card", "paypal", "apple_pay", "bank_transfer", "google_pay").alias("payment_method"),
        _pick(
            event_id % 6, "authorized", "failed", "refunded", "pending", "authorized", "chargeback"
        ).alias("payment_status"),
        _pick(user_id % 8, "NL", "US", "DE", "BE", "FR", "GB", "CA", "ES").alias("country_code"),
        at.alias("created_at"),
        (at + F.expr("INTERVAL 1 HOUR")).alias("updated_at"),
    )


def defective_payments(events: DataFrame) -> DataFrame:
    """``payments`` with one class of defect per modulus of the id."""
    pid = F.col("payment_id")

    def blank(modulus: int, value: Column) -> Column:
        return F.when(pid % modulus != 0, value)

    def spoil(modulus: int, bad: Column, value: Column) -> Column:
        return F.when(pid % modulus == 0, bad).otherwise(value)

    return payments(events).select(
        blank(101, F.when(pid % 103 == 1, pid - 1).otherwise(pid)).alias("payment_id"),
        blank(107, F.col("merchant_id")).alias("merchant_id"),
        blank(109, spoil(113, -F.col("amount"), F.col("amount"))).alias("amount"),
        blank(127, spoil(131, F.lit("EURO"), F.col("currency"))).alias("currency"),
        blank(137, spoil(139, F.lit("cash"), F.col("payment_method"))).alias("payment_method"),
        blank(149, spoil(151, F.lit("unknown"), F.col("payment_status"))).alias("payment_status"),
        blank(157, spoil(163, F.lit("N1"), F.col("country_code"))).alias("country_code"),
        blank(167, F.col("created_at")).alias("created_at"),
        blank(
            173, spoil(179, F.col("created_at") - F.expr("INTERVAL 1 HOUR"), F.col("updated_at"))
        ).alias("updated_at"),
    )
