"""Table schemas. ``DAY`` and ``BUCKET`` are the physical partition columns that readers prune on."""

from __future__ import annotations

from pyspark.sql import types as T

DAY, BUCKET = "_day", "_bucket"


TEXT, INT, LONG, MOMENT = T.StringType(), T.IntegerType(), T.LongType(), T.TimestampType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def extend(schema: T.StructType, **fields: T.DataType) -> T.StructType:
    return T.StructType(schema.fields + struct(**fields).fields)


KAFKA_RECORD = struct(
    key=T.BinaryType(), value=T.BinaryType(), topic=TEXT, partition=INT, offset=LONG,
    timestamp=MOMENT, timestampType=INT,
)
BRONZE = struct(
    kafka_key=TEXT, kafka_value=TEXT, kafka_topic=TEXT, kafka_partition=INT,
    kafka_offset=LONG, kafka_timestamp=MOMENT,
)
# As stored: the route of each event is kept beside it, so that readers interested in one
# kind of event can filter on a column instead of parsing the payload.
BRONZE_STORED = extend(BRONZE, _route=TEXT)
PAYMENT = struct(
    payment_id=LONG, merchant_id=LONG, amount=T.DecimalType(12, 2), currency=TEXT,
    payment_method=TEXT, payment_status=TEXT, country_code=TEXT, created_at=MOMENT, updated_at=MOMENT,
)
SILVER = extend(PAYMENT, ingested_at=MOMENT)
# What ordered resolution keeps: deleted keys stay as tombstones so that an older event
# arriving later cannot bring the row back.
VERSION = struct(at=MOMENT, offset=LONG)
SILVER_VERSIONED = extend(SILVER, _version=VERSION, _deleted=T.BooleanType())
DEAD_LETTER = struct(kafka_value=TEXT, batch_id=LONG, error_reason=TEXT, ingested_at=MOMENT)
GOLD = struct(
    payment_hour=MOMENT, country_code=TEXT, payment_method=TEXT, payment_count=LONG,
    gross_volume=T.DecimalType(18, 2), auth_rate=T.DoubleType(),
)

# A change of silver: what a batch found under a key, and what it left there. Kept for every
# batch, so that readers of silver can follow it without reading it.
def change_rows(held: T.StructType) -> T.StructType:
    return struct(payment_id=LONG, before=held, after=held, run=TEXT, batch=LONG)


BATCHES = struct(run=TEXT, batch=LONG, taken_at=MOMENT)
# Metric cells as sums, which can be added to and taken from; the share is derived when they are read.
CELLS = struct(
    payment_hour=MOMENT, country_code=TEXT, payment_method=TEXT, payment_count=LONG, valued_count=LONG,
    gross_volume=T.DecimalType(28, 2), authorized_count=LONG,
)

# Every payload field is read as text and typed afterwards, so one odd value costs one
# NULL and never the whole record.
_IMAGE = struct(**{name: TEXT for name in [*PAYMENT.names, "shopper_id"]})
ENVELOPE = struct(op=TEXT, before=_IMAGE, after=_IMAGE)


def with_day(schema: T.StructType) -> T.StructType:
    return extend(schema, **{DAY: T.DateType()})


def with_part(schema: T.StructType) -> T.StructType:
    return extend(schema, **{DAY: T.DateType(), BUCKET: INT})
