"""Queries over the test tables, one per operator."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import changes, drift, feed, merge, metrics, quality, series
from tidemark.plans import layers, normalize, seed
from tidemark.session import scratch_folder, settle
from tidemark.sinks.deadletter import read_dead_letters
from tidemark.sources import sample
from tidemark.sources.records import file_records, stream_table
from tidemark.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SPLIT = datetime(2024, 1, 16)
OLD_UNTIL, NEW_FROM = datetime(2000, 1, 1), datetime(1996, 1, 1)
SEED_BASE = datetime(2024, 2, 1, 12, 34, 56)
STATES = ("click", "view", "signup", "purchase", "error", "refund")
EVENT_CONTRACT = {"events": (("event_id", "ts", "user_id", "value"), ())}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return zoneless(function(spark, sf_dir))

    QUERIES[function.__name__] = run
    return run


def zoneless(df: DataFrame) -> DataFrame:
    """UTC timestamps as plain timestamps, the type the SQL side uses."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if f.dataType.typeName() == "timestamp"
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# --- inputs ----------------------------------------------------------------------------


def _events(spark: SparkSession, d: str) -> DataFrame:
    return sample.load(spark, d, "events")


def _log(spark: SparkSession, d: str) -> DataFrame:
    return sample.raw_log(spark, d)


def _decoded(spark: SparkSession, d: str) -> DataFrame:
    return changes.decode(_log(spark, d))


def _payments(spark: SparkSession, d: str) -> DataFrame:
    return sample.payments(_events(spark, d))


def _refunds(spark: SparkSession, d: str) -> DataFrame:
    return seed.refunds_for(_payments(spark, d))


def _old_orders(spark: SparkSession, d: str) -> DataFrame:
    return sample.load(spark, d, "orders").where(F.col("o_orderdate") < F.lit(OLD_UNTIL))


def _new_orders(spark: SparkSession, d: str) -> DataFrame:
    """The later part of the table, with the low-priority open orders changed."""
    changed = (F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "5-LOW")
    recent = sample.load(spark, d, "orders").where(F.col("o_orderdate") >= F.lit(NEW_FROM))
    return recent.withColumn("o_orderstatus", F.when(changed, "X").otherwise(F.col("o_orderstatus")))


# --- raw log ---------------------------------------------------------------------------


@query
def q_bronze_project(spark, d):
    return changes.project_records(sample.record_log(spark, d)).select(
        "kafka_key",
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        "kafka_timestamp",
        F.get_json_object("kafka_value", "$.op").alias("op"),
        F.get_json_object("kafka_value", "$.after.amount").alias("amount"),
    )


@query
def q_bronze_mask(spark, d):
    masked = layers.bronze(sample.record_log(spark, d))
    envelope = F.from_json("kafka_value", schemas.ENVELOPE)
    return masked.select("kafka_offset", envelope.alias("e")).select(
        "kafka_offset",
        F.col("e.op").alias("op"),
        F.col("e.before.shopper_id").alias("before_shopper"),
        F.col("e.after.shopper_id").alias("after_shopper"),
        F.col("e.after.amount").alias("amount"),
        F.col("e.after.payment_method").alias("method"),
        F.col("e.after.created_at").cast("bigint").alias("created_micros"),
    )


# --- silver ----------------------------------------------------------------------------


@query
def q_op_routing(spark, d):
    rows = changes.with_route(changes.project_records(sample.record_log(spark, d)))
    return rows.groupBy(F.col("_route").alias("route")).agg(F.count("*").alias("n"))


@query
def q_dlq(spark, d):
    letters = changes.dead_letters(_log(spark, d), batch_id=7)
    subject = F.coalesce(F.get_json_object("kafka_value", "$.after.payment_id"), F.col("kafka_value"))
    return letters.select("batch_id", "error_reason", subject.alias("subject"))


@query
def q_silver_typed(spark, d):
    return changes.typed_upserts(_decoded(spark, d))


@query
def q_silver_latest(spark, d):
    return changes.latest_per_key(
        changes.typed_upserts(_decoded(spark, d)), changes.KEY, ["updated_at", "_kafka_offset"]
    ).drop("_kafka_offset")


@query
def q_silver_latest_maxby(spark, d):
    return changes.latest_per_key_by_max(
        changes.typed_upserts(_decoded(spark, d)), changes.KEY, ["updated_at", "_kafka_offset"]
    ).drop("_kafka_offset")


@query
def q_silver_micros(spark, d):
    return layers.silver_state(_log(spark, d), changes.ORDERED, precision="micros").select(
        "payment_id", "created_at", "updated_at"
    )


@query
def q_delete_keys(spark, d):
    return changes.delete_keys(_decoded(spark, d))


@query
def q_silver_state_reference(spark, d):
    return layers.silver_state(_log(spark, d), changes.REFERENCE)


@query
def q_silver_state_ordered(spark, d):
    return layers.silver_state(_log(spark, d), changes.ORDERED)


@query
def q_silver_two_batches(spark, d):
    return _two_batches(spark, d)[-1]


def _two_batches(spark, d):
    """State after the first batch, events and outcomes of the second, state after it.

    The log is read and parsed once; what several steps read is stored.
    """
    decoded = settle(_decoded(spark, d).drop("kafka_value"), "decoded")
    late = F.col("kafka_timestamp") >= F.lit(SPLIT)
    first = settle(layers.live_after(decoded.where(~late)), "first")
    resolved = settle(changes.resolve(decoded.where(late)), "resolved")
    return first, decoded.where(late), resolved, changes.apply_changes(first, resolved)


# --- quality and drift -----------------------------------------------------------------


@query
def q_dq_metrics(spark, d):
    return quality.dq_metrics(sample.defective_payments(_events(spark, d)), quality.payment_rules())


@query
def q_dup_keys(spark, d):
    return quality.duplicate_keys(sample.defective_payments(_events(spark, d)), "payment_id")


@query
def q_quarantine(spark, d):
    _, bad = quality.quarantine(sample.defective_payments(_events(spark, d)), quality.payment_rules())
    broken = F.array_join(F.array_sort("_broken_rules"), ",").alias("broken_rules")
    return bad.groupBy(broken).agg(F.count("*").alias("n"))


@query
def q_fk_orphans(spark, d):
    key = F.col("l_orderkey")
    lines = sample.load(spark, d, "lineitem").withColumn("l_orderkey", F.when(key % 97 == 0, -key).otherwise(key))
    return quality.fk_orphans(lines, sample.load(spark, d, "orders"), "l_orderkey", "o_orderkey")


@query
def q_schema_drift(spark, d):
    return drift.drifted_fill(_events(spark, d), "events", EVENT_CONTRACT)


@query
def q_payload_drift(spark, d):
    known = [c for c in schemas.PAYMENT.names if c != "merchant_id"]
    return drift.payload_drift(_log(spark, d), known)


# --- gold ------------------------------------------------------------------------------


@query
def q_affected_hours(spark, d):
    return metrics.affected_hours(_decoded(spark, d))


@query
def q_gold_hourly(spark, d):
    return layers.gold(_log(spark, d))


@query
def q_gold_incremental(spark, d):
    first, decoded, resolved, state = _two_batches(spark, d)
    old_gold = metrics.hourly_metrics(first)
    state = settle(state, "state")
    replaced = first.join(resolved.select(changes.KEY), changes.KEY, "left_semi")
    hours = (
        metrics.affected_hours(decoded, both_images=True)
        .union(replaced.select(F.date_trunc("hour", "created_at")))
        .distinct()
    )
    fresh = metrics.hourly_metrics(metrics.in_hours(state, hours))
    return merge.replace_groups(old_gold, hours, fresh, "payment_hour")


@query
def q_silver_rows(spark, d):
    return layers.silver_state(_log(spark, d)).agg(F.count("*").alias("silver_rows"))


@query
def q_gold_rows(spark, d):
    return metrics.hourly_metrics(_payments(spark, d)).agg(F.count("*").alias("gold_rows"))


@query
def q_rollup_country_method(spark, d):
    return metrics.rollup_country_method(metrics.hourly_metrics(_payments(spark, d)))


@query
def q_rollup_auth_rate(spark, d):
    gold = metrics.hourly_metrics(_payments(spark, d), exact_rate=True)
    rate = F.round(metrics.weighted_share(), 9).alias("auth_rate")
    return gold.groupBy("country_code").agg(rate)


@query
def q_silver_serving(spark, d):
    state = layers.silver_state(_log(spark, d))
    columns = ("payment_id", "amount", "payment_method", "payment_status", "created_at", "updated_at")
    return state.select(*columns).orderBy("payment_id")


@query
def q_gold_serving(spark, d):
    gold = metrics.hourly_metrics(_payments(spark, d))
    return gold.orderBy("payment_hour", "country_code", "payment_method")


# --- dashboards ------------------------------------------------------------------------


@query
def q_total_payments(spark, d):
    return metrics.total_rows(_payments(spark, d), "total_payments")


@query
def q_gross_volume(spark, d):
    return metrics.gross_volume(_payments(spark, d))


@query
def q_auth_rate(spark, d):
    return metrics.authorization_rate(_payments(spark, d))


@query
def q_refund_count(spark, d):
    return metrics.total_rows(_refunds(spark, d), "refunds_issued")


@query
def q_volume_by_hour(spark, d):
    return metrics.volume_by_hour(_payments(spark, d))


@query
def q_method_mix(spark, d):
    return metrics.count_by(_payments(spark, d), "payment_method", "payments")


@query
def q_volume_by_country(spark, d):
    return metrics.volume_by(_payments(spark, d), "country_code")


@query
def q_refunds_by_hour(spark, d):
    return metrics.rows_by_hour(_refunds(spark, d), "refunds")


@query
def q_method_share(spark, d):
    return metrics.share_of_total(_payments(spark, d), "payment_method")


@query
def q_auth_rate_4dp(spark, d):
    return metrics.authorization_rate_4dp(_payments(spark, d))


@query
def q_normalize_payment(spark, d):
    rows = sample.change_rows(_events(spark, d))
    text = [F.col(c).cast("string").alias(c) for c in ("payment_id", "merchant_id", "shopper_id", "amount")]
    raw = rows.select(
        *text, "currency", "payment_method", "payment_status", "country_code", "created_at", "updated_at"
    )
    return normalize.normalize_payments(raw)


# --- row-level changes -----------------------------------------------------------------


@query
def q_merge_upsert(spark, d):
    return merge.merge_upsert(_old_orders(spark, d), _new_orders(spark, d), "o_orderkey")


@query
def q_delete_by_key(spark, d):
    gone = sample.load(spark, d, "lineitem").where(F.col("l_returnflag") == "R")
    keys = gone.select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return merge.delete_by_key(sample.load(spark, d, "orders"), keys, "o_orderkey")


@query
def q_update_by_key(spark, d):
    return merge.update_where(
        _payments(spark, d),
        F.col("shopper_id") == 7,
        {
            "amount": F.lit(Decimal("149.99")),
            "payment_status": F.lit("authorized"),
            "updated_at": F.lit(SEED_BASE),
        },
    )


@query
def q_insert_if_absent(spark, d):
    new = _new_orders(spark, d)
    doubled = new.union(new.withColumn("o_totalprice", F.col("o_totalprice") + 1))
    key = F.when(F.col("o_orderkey") % 101 != 0, F.col("o_orderkey"))
    return merge.insert_if_absent(
        _old_orders(spark, d), doubled.withColumn("o_orderkey", key), "o_orderkey", ["o_totalprice"]
    )


@query
def q_change_feed(spark, d):
    rush = F.when(F.col("o_orderpriority") == "1-URGENT", "yes").alias("o_rush")
    new = _new_orders(spark, d).select("*", rush)
    changed = feed.change_feed(_old_orders(spark, d), new, "o_orderkey")
    logged = feed.to_envelopes(changed, "o_orderkey")

    def part(path: str):
        return F.get_json_object("value", path)

    return logged.select(
        F.get_json_object("key", "$.o_orderkey").cast("bigint").alias("o_orderkey"),
        part("$.op").alias("op"),
        part("$.before.o_orderstatus").alias("old_status"),
        part("$.after.o_orderstatus").alias("new_status"),
        part("$.after.o_rush").alias("new_rush"),
        part("$.after.o_orderdate").cast("bigint").alias("new_date_micros"),
    )


@query
def q_sparse_change_feed(spark, d):
    """Of a thousand orders one is repriced, one has lost its status, one is gone, and one is new."""
    old = sample.load(spark, d, "orders")
    at = F.pmod("o_orderkey", F.lit(1000))
    added = old.where(at == 1).withColumn("o_orderkey", -F.col("o_orderkey"))
    new = old.where(at != 4).unionByName(added).withColumns({
        "o_totalprice": F.when(at == 2, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
        "o_orderstatus": F.when(at != 3, F.col("o_orderstatus")),
    })
    feed_rows = feed.sparse_change_feed(old, new, "o_orderkey")
    return feed_rows.select(
        "o_orderkey", "op", F.col("before.o_orderstatus").alias("old_status"), F.col("after.o_orderstatus").alias("new_status"),
        (F.col("after.o_totalprice") > F.col("before.o_totalprice")).alias("dearer"),
    )


@query
def q_snapshot_feed(spark, d):
    rows = feed.snapshot_feed(sample.load(spark, d, "orders"), "o_orderkey")
    return rows.select("o_orderkey", "op", F.col("after.o_totalprice").alias("o_totalprice"))


# --- demo data -------------------------------------------------------------------------


def _numbers(spark, d):
    return _events(spark, d).select((F.col("event_id") + 1).alias("n"))


def _seeded(spark, d):
    base = F.lit(SEED_BASE).cast("timestamp")
    generated = seed.generated_payments(_numbers(spark, d), base)
    return merge.insert_if_absent(seed.literal_payments(spark, base), generated, "payment_id")


@query
def q_seed_payments(spark, d):
    return _seeded(spark, d)


@query
def q_seed_refunds(spark, d):
    length = _numbers(spark, d).agg(F.max("n")).scalar()
    return seed.demo_refunds(spark, _seeded(spark, d), F.lit(SEED_BASE).cast("timestamp"), length)


# --- metric series ---------------------------------------------------------------------


@query
def q_state_counts(spark, d):
    return metrics.state_counts(_events(spark, d), "event_type", STATES)


@query
def q_last_value(spark, d):
    gauge = F.when(F.col("event_type") != "error", F.col("value")).alias("value")
    samples = _events(spark, d).select("user_id", "ts", "event_id", gauge)
    return series.last_value(samples, ["user_id"], "value", ["ts", "event_id"])


@query
def q_sum_latest(spark, d):
    samples = _events(spark, d).withColumn("value", F.col("value").cast("decimal(12,2)"))
    latest = series.sum_latest(samples, ["event_type", "user_id"], "value", ["ts", "event_id"])
    return latest.select(F.col("total").cast("decimal(18,2)").alias("total"))


@query
def q_counter_rate(spark, d):
    known = F.when(F.col("event_id") % 17 != 0, F.col("value").cast("decimal(12,2)"))
    samples = _events(spark, d).withColumn("value", known)
    return series.counter_rate(
        samples, ["event_type", "user_id"], "ts", "value", by=["event_type"], order=["event_id"]
    )


# --- the incremental jobs --------------------------------------------------------------


def _layout(spark):
    folder = scratch_folder(spark, "stream")
    # a day of the test tables is far below the size of one part
    return jobs.Layout(f"{folder}/tables", f"{folder}/progress", buckets=1)


def _streamed(spark, d, mode):
    """All three layers run over the stored record files as streams."""
    _events(spark, d)
    layout = _layout(spark)
    jobs.run_layers(file_records(spark, sample.record_folder(spark, d)), layout, mode)
    return layout


@query
def q_stream_silver(spark, d):
    return _streamed(spark, d, changes.ORDERED).read_silver(spark, changes.ORDERED).select(*schemas.PAYMENT.names)


@query
def q_stream_gold(spark, d):
    return _streamed(spark, d, changes.REFERENCE).read_gold(spark)


def _late_and_early(records, moment: str):
    late = F.col(moment) >= F.lit(SPLIT)
    return records.where(~late), records.where(late)


@query
def q_stream_gold_events(spark, d):
    """Metrics refreshed by the hours that events name, batch by batch, then by what silver changed."""
    _events(spark, d)
    layout = _layout(spark)
    for part in _late_and_early(sample.record_log(spark, d), "timestamp"):
        part.write.mode("append").parquet(f"{layout.root}/records")
        jobs.run_bronze(file_records(spark, f"{layout.root}/records"), layout)
        jobs.run_silver(spark, layout)
        jobs.run_gold_from_events(spark, layout)
    jobs.run_gold_from_changes(spark, layout)
    return layout.read_gold_by_hour(spark)


@query
def q_silver_version(spark, d):
    """Silver as it was after its first batch, told after the second."""
    _events(spark, d)
    layout = _layout(spark)
    for number, part in enumerate(_late_and_early(_log(spark, d), "kafka_timestamp")):
        jobs.apply_batch(part, number, layout)
    return jobs.silver_as_of(spark, layout, "manual", 0).select(*schemas.PAYMENT.names)


@query
def q_table_silver(spark, d):
    """The silver table after two batches, the second applied twice."""
    _events(spark, d)
    layout = _layout(spark)
    parts = _late_and_early(_log(spark, d), "kafka_timestamp")
    for number, part in ((0, parts[0]), (1, parts[1]), (1, parts[1])):
        jobs.apply_batch(part, number, layout)
    return layout.read_silver(spark).select(*schemas.PAYMENT.names)


@query
def q_gold_retraction(spark, d):
    """Metric cells of the first batch with the second one's old images taken out and new ones added."""
    first, _, resolved, _ = _two_batches(spark, d)
    before = first.select(changes.KEY, F.struct(*first.columns).alias("before"))
    after = F.when(~F.col("_deleted"), F.struct(*schemas.PAYMENT.names)).alias("after")
    images = resolved.join(before, changes.KEY, "left").select(changes.KEY, "before", after)
    deltas = metrics.hourly_cells(metrics.signed_payments(images))
    return metrics.gold_of_cells(metrics.add_cells(metrics.hourly_cells(first), deltas)).select(*schemas.GOLD.names)


@query
def q_stream_once(spark, d):
    """Records in the raw log after every file was delivered twice, the second time after a restart."""
    _events(spark, d)
    layout = _layout(spark)
    for _ in range(2):
        sample.record_log(spark, d).write.mode("append").parquet(f"{layout.root}/records")
        jobs.run_bronze(file_records(spark, f"{layout.root}/records"), layout, redelivered_within="30 days")
    return spark.read.parquet(layout.bronze).groupBy("kafka_partition").agg(F.count("*").alias("n"))


@query
def q_stream_dlq(spark, d):
    letters = read_dead_letters(spark, _streamed(spark, d, changes.REFERENCE).dead_letters)
    return letters.groupBy("error_reason").agg(F.count("*").alias("n"))


@query
def q_type_drift(spark, d):
    """One merchant id in five has become an object; a creation time is no text; nobody knows ``before.country_code``."""
    nested = F.regexp_replace("kafka_value", r'"merchant_id":(\d+)', r'"merchant_id":{"id":$1}')
    log = _log(spark, d).withColumn("kafka_value", F.when(F.col("kafka_offset") % 5 == 0, nested).otherwise(F.col("kafka_value")))
    image = {"payment_id": "number", "merchant_id": "number", "shopper_id": "text", "created_at": "text", "updated_at": "number"}
    image |= dict.fromkeys(("amount", "currency", "payment_method", "payment_status", "country_code"), "text")
    contract = {"op": "text", "before": "object", "after": "object"}
    contract |= {f"{side}.{name}": kind for side in ("before", "after") for name, kind in image.items()}
    del contract["before.country_code"]
    return drift.type_drift(log, contract)


@query
def q_stream_last_value(spark, d):
    """``q_last_value`` kept by a stream: three drops that overlap in time, with a restart before each."""
    gauge = F.when(F.col("event_type") != "error", F.col("value")).alias("value")
    samples = _events(spark, d).select("user_id", "ts", "event_id", gauge)
    layout = _layout(spark)
    for drop in range(3):
        samples.where(F.col("event_id") % 3 == drop).write.mode("append").parquet(f"{layout.root}/samples")
        stream = stream_table(spark, f"{layout.root}/samples", samples.schema)
        jobs.run_last_values(stream, layout, "last_values", ["user_id"], "value", ["ts", "event_id"])
    return spark.table(layout.table("last_values")).select("user_id", "value")


@query
def q_stream_orphans(spark, d):
    """Refunds without a payment in time, told by two streams; the payments come a drop after the refunds.

    Last come heartbeats, which move the watermark past all that is held.
    """
    at = F.col("ts").cast("timestamp")
    base = _events(spark, d).select("event_id", "event_type", F.col("user_id"), at.alias("at"))
    later = F.make_interval(mins=F.col("event_id") % 300)
    made = base.where(F.col("event_id") % 4 != 0).select(F.col("event_id").alias("payment_id"), (F.col("at") + later).alias("made_at"))
    refunds = base.where(F.col("event_id") % 3 == 0).select((F.col("event_id")).alias("payment_id"), F.col("at").alias("refunded_at"), "user_id")
    beat = base.agg((F.max("at") + F.expr("INTERVAL 90 DAYS")).alias("at"))
    folder = _layout(spark)
    drops = (
        (refunds, made.where("payment_id % 2 = 0")),
        (refunds.where("false"), made.where("payment_id % 2 = 1")),
        (
            beat.select(F.lit(-1).cast("long").alias("payment_id"), F.col("at").alias("refunded_at"), F.lit(0).cast("long").alias("user_id")),
            beat.select(F.lit(-2).cast("long").alias("payment_id"), F.col("at").alias("made_at")),
        ),
    )
    for children, parents in drops:
        children.write.mode("append").parquet(f"{folder.root}/refunds")
        parents.write.mode("append").parquet(f"{folder.root}/payments")
        held = quality.orphans_in_motion(
            stream_table(spark, f"{folder.root}/refunds", refunds.schema), stream_table(spark, f"{folder.root}/payments", made.schema),
            "payment_id", "payment_id", "refunded_at", "made_at", wait="2 HOURS", reach="30 DAYS", late="60 days", spread=2,
        )
        path = jobs.run_orphans(held, folder, "orphans")
    return spark.read.schema(refunds.schema).parquet(path).select("payment_id", "user_id")
