from __future__ import annotations

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.checks.queries import QUERIES
from tidemark.operators import changes
from tidemark.sources import sample

HOUR = 3_600_000_000


def event(op, key, updated=1, status="authorized", created=0, **extra):
    image = {
        "payment_id": key, "merchant_id": 1, "shopper_id": 5, "amount": "10.00", "currency": "eur",
        "payment_method": "Card", "payment_status": status, "country_code": " nl ",
        "created_at": created * HOUR, "updated_at": updated * HOUR, **extra,
    }
    before, after = (image, None) if op == "d" else (None, image)
    return json.dumps({"op": op, "before": before, "after": after})


def log(spark, values, start=0):
    rows = [(v, start + i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "kafka_value STRING, kafka_offset BIGINT")


def state_of(spark, batches, mode):
    schema = schemas.PAYMENT if mode == changes.REFERENCE else schemas.extend(
        schemas.PAYMENT, _version=schemas.VERSION, _deleted=schemas.T.BooleanType()
    )
    target, start = spark.createDataFrame([], schema), 0
    for batch in batches:
        resolved = changes.resolve(changes.decode(log(spark, batch, start)), mode)
        target = changes.apply_changes(target, resolved, mode)
        start += len(batch)
    live = target if mode == changes.REFERENCE else changes.current_rows(target)
    return {r.payment_id: r.payment_status for r in live.collect()}


def test_typing_and_clean_up(spark):
    raw = event("c", "12.9", amount="1.005", currency=" usd ", payment_method=" Apple  Pay ", status=" FAILED ")
    row = changes.typed_upserts(changes.decode(log(spark, [raw]))).first()
    assert (row.payment_id, str(row.amount), row.currency) == (12, "1.01", "USD")
    assert (row.payment_method, row.payment_status, row.country_code) == ("apple_pay", "failed", "NL")


def test_untypable_values_become_null(spark):
    raw = event("c", "abc", amount="99999999999999.00", merchant_id={"a": 1}, created_at="soon")
    raw = json.dumps({**json.loads(raw), "after": {**json.loads(raw)["after"], "created_at": "soon"}})
    row = changes.typed_upserts(changes.decode(log(spark, [raw]))).first()
    assert (row.payment_id, row.amount, row.merchant_id, row.created_at) == (None, None, None, None)


def test_fraction_of_a_second(spark):
    raw = event("c", 1, created_at=1_500_000, updated_at=-1)
    for precision, created, updated in (("second", 1_000_000, -1_000_000), ("micros", 1_500_000, -1)):
        row = changes.decode(log(spark, [raw]), precision).select(
            F.unix_micros("created_at").alias("c"), F.unix_micros("updated_at").alias("u")
        ).first()
        assert (row.c, row.u) == (created, updated)


@pytest.mark.parametrize(
    "value, route",
    [
        (None, "null_op"), ("not-json", "null_op"), ("[1]", "null_op"), ('{"op":null}', "null_op"),
        ('{"op":7}', "unexpected_op"), ('{"op":"t"}', "unexpected_op"), ('{"op":"d"}', "delete"),
        ('{"op":"r"}', "upsert"),
    ],
)
def test_routes(spark, value, route):
    assert changes.decode(log(spark, [value])).first()._route == route
    assert changes.with_route(log(spark, [value])).first()._route == route


def test_latest_breaks_ties_by_offset_and_puts_null_last(spark):
    values = [event("u", 1, 5, "pending"), event("u", 1, 5, "failed"), event("u", 1, 3, "refunded")]
    values.append(event("u", 1, status="cancelled", updated_at=None))
    upserts = changes.typed_upserts(changes.decode(log(spark, values)))
    for latest in (changes.latest_per_key, changes.latest_per_key_by_max):
        rows = latest(upserts, "payment_id", ["updated_at", "_kafka_offset"]).collect()
        assert [r.payment_status for r in rows] == ["failed"]


def test_delete_then_recreate(spark):
    batch = [event("c", 1), event("d", 1), event("c", 1, 9, "pending")]
    assert state_of(spark, [batch], changes.REFERENCE) == {}
    assert state_of(spark, [batch], changes.ORDERED) == {1: "pending"}


def test_delete_without_key_removes_nothing(spark):
    batch = [event("c", 1), json.dumps({"op": "d", "before": None}), event("d", None)]
    for mode in (changes.REFERENCE, changes.ORDERED):
        assert state_of(spark, [batch], mode) == {1: "authorized"}


def test_upsert_without_key_still_reaches_the_rules(spark):
    batch = [event("c", None), event("d", None)]
    for mode in (changes.REFERENCE, changes.ORDERED):
        rows = changes.validated_rows(changes.resolve(changes.decode(log(spark, batch)), mode)).collect()
        assert [r.payment_id for r in rows] == [None]


def test_hot_key_is_reduced_before_the_shuffle(spark, data):
    upserts = changes.typed_upserts(changes.decode(sample.raw_log(spark, data)))

    def before_exchange(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return plan[plan.index("Exchange hashpartitioning"):]

    order = ["updated_at", "_kafka_offset"]
    assert "WindowGroupLimit" in before_exchange(changes.latest_per_key(upserts, "payment_id", order))
    assert "partial_max_by" in before_exchange(changes.latest_per_key_by_max(upserts, "payment_id", order))
    resolved = changes.resolve(changes.decode(sample.raw_log(spark, data)))
    plan = resolved._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("AS _envelope") == 1
    assert "PushedFilters: [In(_route" in plan


events_strategy = st.lists(
    st.tuples(st.sampled_from("curd"), st.integers(1, 4), st.sampled_from(["authorized", "failed", "pending"])),
    min_size=1, max_size=12,
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(events=events_strategy, cut=st.integers(0, 12))
def test_ordered_state_does_not_depend_on_batches(spark, events, cut):
    values = [event(op, key, i + 1, status) for i, (op, key, status) in enumerate(events)]
    expected = {}
    for op, key, status in events:
        expected.pop(key, None)
        if op != "d":
            expected[key] = status
    batches = [b for b in (values[:cut], values[cut:]) if b]
    assert state_of(spark, [values], changes.ORDERED) == expected
    assert state_of(spark, batches, changes.ORDERED) == expected


def test_late_older_event_does_not_resurrect(spark):
    decode = lambda values, start: changes.decode(log(spark, values, start))
    schema = schemas.extend(schemas.PAYMENT, _version=schemas.VERSION, _deleted=schemas.T.BooleanType())
    empty = spark.createDataFrame([], schema)
    late_delete = changes.apply_changes(empty, changes.resolve(decode([event("d", 1)], 9), changes.ORDERED), changes.ORDERED)
    after = changes.apply_changes(late_delete, changes.resolve(decode([event("u", 1)], 3), changes.ORDERED), changes.ORDERED)
    assert changes.current_rows(after).count() == 0


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(events=events_strategy)
def test_replay_changes_nothing(spark, events):
    values = [event(op, key, i + 1, status) for i, (op, key, status) in enumerate(events)]
    once = state_of(spark, [values], changes.REFERENCE)
    assert state_of(spark, [values, values], changes.REFERENCE) == once


def test_newer_event_wins_after_offsets_restart(spark):
    def batch(value, second, offset):
        rows = spark.createDataFrame([(value, offset, second)], "kafka_value STRING, kafka_offset BIGINT, s BIGINT")
        return rows.withColumn("kafka_timestamp", F.timestamp_seconds("s")).drop("s")

    schema = schemas.extend(schemas.PAYMENT, _version=schemas.VERSION, _deleted=schemas.T.BooleanType())
    state = spark.createDataFrame([], schema)
    for rows in (batch(event("u", 1, status="pending"), 10, 5000), batch(event("u", 1, status="failed"), 20, 3), batch(event("d", 1), 15, 9000)):
        state = changes.apply_changes(state, changes.resolve(changes.decode(rows), changes.ORDERED), changes.ORDERED)
    assert [r.payment_status for r in changes.current_rows(state).collect()] == ["failed"]


@pytest.mark.parametrize("name, scans", [("q_affected_hours", 1), ("q_delete_keys", 1), ("q_op_routing", 1), ("q_silver_latest", 1)])
def test_each_payload_is_parsed_once(spark, data, name, scans):
    plan = QUERIES[name](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == plan.count("FileScan parquet") == scans


def test_dropped_tombstones(spark):
    rows = log(spark, [None, "junk", event("t", 1)])
    assert changes.dead_letters(rows, 0).count() == 3
    assert changes.dead_letters(rows, 0, drop_tombstones=True).count() == 2
