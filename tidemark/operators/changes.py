"""Turning a change log into one outcome per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.envelope import parse_envelope, route_of
from tidemark.functions.text import clean_code, clean_token
from tidemark.functions.typing import micros_to_timestamp, to_decimal, to_long

KEY = "payment_id"
REFERENCE, ORDERED = "reference", "ordered"


def project_records(records: DataFrame) -> DataFrame:
    """Message-log records to raw-log rows: text key and value, prefixed metadata."""
    return records.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("kafka_value"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
    )


def with_route(raw_log: DataFrame) -> DataFrame:
    """Add where each event goes, unless the log already stores it."""
    if "_route" in raw_log.columns:
        return raw_log
    parsed = raw_log.withColumn("_operation", F.from_json("kafka_value", "op STRING"))
    return parsed.withColumn("_route", route_of(F.col("_operation.op"))).drop("_operation")


def decode(raw_log: DataFrame, precision: str = "second") -> DataFrame:
    """Parse each envelope once; add route, key, typed payload and both creation times."""
    stored = [c for c in ("_route",) if c in raw_log.columns]
    logged_at = F.col("kafka_timestamp") if "kafka_timestamp" in raw_log.columns else F.lit(None).cast("timestamp")
    parsed = raw_log.select(
        "kafka_value", "kafka_offset", logged_at.alias("kafka_timestamp"), *stored,
        parse_envelope(F.col("kafka_value")).alias("_envelope"),
    )
    after, before = F.col("_envelope.after"), F.col("_envelope.before")
    route = F.col("_route") if stored else route_of(F.col("_envelope.op"))
    after_id, before_id = to_long(after[KEY]), to_long(before[KEY])
    return parsed.select(
        "kafka_value",
        "kafka_offset",
        "kafka_timestamp",
        route.alias("_route"),
        before_id.alias("_before_id"),
        micros_to_timestamp(before["created_at"], precision).alias("_before_created_at"),
        after_id.alias("payment_id"),
        to_long(after["merchant_id"]).alias("merchant_id"),
        to_decimal(after["amount"]).alias("amount"),
        clean_code(after["currency"]).alias("currency"),
        clean_token(after["payment_method"]).alias("payment_method"),
        clean_token(after["payment_status"]).alias("payment_status"),
        clean_code(after["country_code"]).alias("country_code"),
        micros_to_timestamp(after["created_at"], precision).alias("created_at"),
        micros_to_timestamp(after["updated_at"], precision).alias("updated_at"),
    )


def creation_times(raw_log: DataFrame, precision: str = "second") -> DataFrame:
    """The route and both creation times of ``decode``; no other field is read out of the envelope."""
    routed = "_route" in raw_log.columns
    image = schemas.struct(created_at=schemas.TEXT)
    wanted = schemas.struct(**({} if routed else {"op": schemas.TEXT}), before=image, after=image)
    parsed = raw_log.select(*(["_route"] if routed else []), F.from_json("kafka_value", wanted).alias("_envelope"))
    return parsed.select(
        F.col("_route") if routed else route_of(F.col("_envelope.op")).alias("_route"),
        micros_to_timestamp(F.col("_envelope.before.created_at"), precision).alias("_before_created_at"),
        micros_to_timestamp(F.col("_envelope.after.created_at"), precision).alias("created_at"),
    )


def typed_upserts(decoded: DataFrame) -> DataFrame:
    """Every create, update and snapshot-read event as a typed payment row."""
    return decoded.where(F.col("_route") == "upsert").select(
        *schemas.PAYMENT.names, F.col("kafka_offset").alias("_kafka_offset")
    )


def latest_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that is last by ``order`` (NULL counts as earliest).

    Planned as a per-partition rank limit before the shuffle, so a hot key sends one row
    per map task and not its whole history.
    """
    keys = [key] if isinstance(key, str) else list(key)
    newest_first = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return (
        df.withColumn("_rank", F.row_number().over(newest_first))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def latest_per_key_by_max(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """``latest_per_key`` as a partial-then-final aggregate."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    winner = F.max_by(F.struct(*rest), F.struct(*order)).alias("_winner")
    return df.groupBy(*keys).agg(winner).select(*keys, "_winner.*").select(*df.columns)


def delete_keys(decoded: DataFrame) -> DataFrame:
    """Keys named by delete events; a delete without a readable key gives NULL, which names none.

    Only the stored route is filtered on, so every payload is parsed once.
    """
    return decoded.where(F.col("_route") == "delete").select(F.col("_before_id").alias(KEY))


def _outcome_input(decoded: DataFrame) -> DataFrame:
    """Upserts and deletes in one shape. ``_version`` is (time of the record, offset).

    Offsets start anew when a topic is made again or a key moves to another partition, so the
    time of the record comes first. A delete without a readable key names nothing: its ``_version`` is NULL, which loses
    against every other event. (A filter on the key here would be pushed to the scan and
    parse every payload a second time.)
    """
    is_delete = F.col("_route") == "delete"
    key = F.when(is_delete, F.col("_before_id")).otherwise(F.col(KEY))
    created = F.when(is_delete, F.col("_before_created_at")).otherwise(F.col("created_at"))
    rest = [c for c in schemas.PAYMENT.names if c not in (KEY, "created_at")]
    shaped = decoded.where(F.col("_route").isin("upsert", "delete")).select(
        key.alias(KEY), *rest, created.alias("created_at"), is_delete.alias("_deleted"), "kafka_timestamp", "kafka_offset"
    )
    named = ~(F.col("_deleted") & F.col(KEY).isNull())
    version = F.struct(F.col("kafka_timestamp").alias("at"), F.col("kafka_offset").alias("offset"))
    return shaped.withColumn("_version", F.when(named, version)).drop("kafka_timestamp", "kafka_offset")


def resolve(decoded: DataFrame, mode: str = REFERENCE) -> DataFrame:
    """One row per key of a batch: payment columns, ``_deleted``, ``_upserted``, ``_version``.

    ``reference``: the newest upsert by (updated_at, offset), and any delete in the batch
    removes the key whatever its position.
    ``ordered``: the last event by (record time, offset) decides, delete or not.

    Upserts and deletes share a single shuffle by key, and the repeated events of a key
    shrink to one row per map task before it.
    """
    events = _outcome_input(decoded)
    rest = [c for c in schemas.PAYMENT.names if c != KEY]
    if mode == ORDERED:
        outcome = latest_per_key(events, KEY, ["_version"]).withColumn("_upserted", ~F.col("_deleted"))
    elif mode == REFERENCE:
        upserted = ~F.col("_deleted")
        newest = F.max_by(
            F.when(upserted, F.struct(*rest)), F.when(upserted, F.struct("updated_at", F.col("_version.offset")))
        )
        outcome = (
            events.groupBy(KEY)
            .agg(
                newest.alias("_newest"),
                F.bool_or(F.col("_deleted") & F.col("_version").isNotNull()).alias("_deleted"),
                F.bool_or(upserted).alias("_upserted"),
                F.max("_version").alias("_version"),
            )
            .select("*", "_newest.*")
        )
    else:
        raise ValueError(f"unknown resolution mode {mode!r}")
    return outcome.where(F.col("_version").isNotNull()).select(
        KEY, *rest, "_deleted", "_upserted", "_version"
    )


def validated_rows(resolved: DataFrame) -> DataFrame:
    """The rows quality rules apply to: each key's newest upsert, even if also deleted."""
    return resolved.where(F.col("_upserted")).select(*schemas.PAYMENT.names)


def apply_changes(target: DataFrame, resolved: DataFrame, mode: str = REFERENCE) -> DataFrame:
    """``target`` after one batch. Key-unique on both sides, so neither join can skew.

    No side is forced to broadcast: a small batch is broadcast at run time by its measured
    size, a large one is shuffled.
    """
    if mode == REFERENCE:
        kept = target.join(resolved.select(KEY), KEY, "left_anti")
        return kept.unionByName(resolved.where(~F.col("_deleted")).select(*target.columns))
    fresh = drop_stale(target, resolved)
    kept = target.join(fresh.select(KEY), KEY, "left_anti")
    return kept.unionByName(fresh.select(*target.columns))


def drop_stale(target: DataFrame, resolved: DataFrame) -> DataFrame:
    """Outcomes that are newer than what ``target`` already holds for their key."""
    held = target.select(KEY, F.col("_version").alias("_held"))
    stale = (
        held.join(resolved.select(KEY, "_version"), KEY)
        .where(F.col("_held") >= F.col("_version"))
        .select(KEY)
    )
    return resolved.join(stale, KEY, "left_anti")


def current_rows(versioned: DataFrame) -> DataFrame:
    """The live rows of an ordered-mode table."""
    return versioned.where(~F.col("_deleted")).drop("_deleted", "_version")


def dead_letters(
    decoded: DataFrame, batch_id: int | Column, clock: Column | None = None, drop_tombstones: bool = False
) -> DataFrame:
    """Events turned away, with the reason. NULL-valued tombstones are among them unless dropped.

    Takes the raw log or its decoded form; needs the value and its route.
    """
    batch = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
    turned_away = with_route(decoded).where(~F.col("_route").isin("upsert", "delete"))
    if drop_tombstones:
        turned_away = turned_away.where(F.col("kafka_value").isNotNull())
    return turned_away.select(
        "kafka_value",
        batch.cast("long").alias("batch_id"),
        F.col("_route").alias("error_reason"),
        (clock if clock is not None else F.current_timestamp()).alias("ingested_at"),
    )
