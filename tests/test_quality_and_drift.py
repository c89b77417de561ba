from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.fixed_values import CONTRACTS
from tidemark.operators import drift, quality
from tidemark.sources import sample
from tidemark.sources.catalog import catalog_columns, columns_of, visible_tables


@pytest.fixture(scope="module")
def dirty(spark, data):
    return sample.defective_payments(sample.load(spark, data, "events"))


def test_empty_input_passes(spark):
    empty = spark.createDataFrame([], schemas.PAYMENT)
    quality.enforce(empty, quality.payment_rules(), unique_key="payment_id")
    assert set(quality.dq_metrics(empty, quality.payment_rules()).first()) == {0}


def test_enforce_lists_every_broken_rule(dirty):
    with pytest.raises(quality.DataQualityError) as caught:
        quality.enforce(dirty, quality.payment_rules(), unique_key="payment_id")
    assert isinstance(caught.value, ValueError)
    assert set(caught.value.failures) == set(quality.payment_rules()) | {"duplicate_payment_ids"}
    assert "null_payment_id" in str(caught.value)


def test_clean_rows_pass(spark, data):
    clean = sample.payments(sample.load(spark, data, "events"))
    quality.enforce(clean, quality.payment_rules(), unique_key="payment_id")
    quality.enforce(clean, quality.required_rules("shopper_id"))


def test_quarantine_splits_without_loss(dirty):
    clean, bad = quality.quarantine(dirty, quality.payment_rules())
    quality.enforce(clean, quality.payment_rules())
    assert clean.count() + bad.count() == dirty.count()
    assert bad.where(F.size("_broken_rules") == 0).isEmpty()


def test_rules_are_one_scan_without_row_shuffle(dirty):
    plan = quality.dq_metrics(dirty, quality.payment_rules())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange SinglePartition") == 1
    assert "hashpartitioning" not in plan


def frames(spark, **extra):
    return {
        table: spark.createDataFrame([], schemas.struct(**{c: schemas.TEXT for c in [*mapped, *excluded, *extra.get(table, [])]}))
        for table, (mapped, excluded) in CONTRACTS.items()
    }


def test_no_drift_when_every_column_is_decided(spark):
    drift.check_drift(columns_of(frames(spark)), drift.contract_table(spark))


@pytest.mark.parametrize(
    "extra",
    [
        {"payments": ["risk_score"]}, {"payments": ["risk_score", "device_fingerprint"]},
        {"merchants": ["merchant_tier"]}, {"refunds": ["refund_status"]},
        {"payments": ["new_col"], "merchants": ["new_col"], "refunds": ["new_col"]},
    ],
)
def test_drift_names_every_table_and_column(spark, extra):
    with pytest.raises(drift.SchemaDriftError) as caught:
        drift.check_drift(columns_of(frames(spark, **extra)), drift.contract_table(spark))
    assert caught.value.drift == {table: sorted(columns) for table, columns in extra.items()}


def test_removed_columns_are_no_drift(spark):
    narrow = spark.createDataFrame([], schemas.struct(payment_id=schemas.LONG, amount=schemas.TEXT))
    drift.check_drift(columns_of({"payments": narrow}), drift.contract_table(spark))


def test_drift_reads_only_undecided_columns(spark, data):
    fill = drift.drifted_fill(sample.load(spark, data, "events"), "events", {"events": (("event_id", "ts"), ("user_id", "value"))})
    assert "ReadSchema: struct<event_type:string,props:string>" in fill._jdf.queryExecution().executedPlan().toString()


def test_catalog_listing(spark):
    spark.range(1).createOrReplaceTempView("seen_payments")
    assert "seen_payments" in visible_tables(spark)
    assert [r.column_name for r in catalog_columns(spark, "seen_payments").collect()] == ["id"]
    spark.catalog.dropTempView("seen_payments")


def test_orphans_are_counted_before_the_join(spark):
    child = spark.createDataFrame([(1,)] * 50 + [(2,), (None,)], "fk BIGINT")
    parent = spark.createDataFrame([(2,)], "pk BIGINT")
    assert [tuple(r) for r in quality.fk_orphans(child, parent, "fk", "pk").collect()] == [(1, 50)]


def test_kinds_of_nested_fields(spark):
    log = spark.createDataFrame(
        [
            ('{"op":"c","after":{"id":1,"card":{"bin":411111,"tags":["a",2,"b"]}}}',),
            ('{"op":"c","after":{"id":"1","card":{"bin":"x","tags":[]}}}',),
            ('{"op":"c","after":{"id":2.5,"card":null,"ok":true}}',),
            ('{"op":"c","after":{"a":{"b":{"c":{"d":1}}}}}',),
            ("not-json",), (None,), ("7",), ("{}",),
        ],
        "kafka_value STRING",
    )
    contract = {"op": "text", "after": "object", "after.id": "number", "after.card": "object", "after.card.bin": "number",
                "after.card.tags": "array", "after.card.tags[]": "text", "after.ok": "boolean"}
    nested = {("after.a", "object", None, 1), ("after.a.b", "object", None, 1), ("after.a.b.c", "object", None, 1)}
    wanted = {
        ("after.id", "text", "number", 1), ("after.card.bin", "text", "number", 1), ("after.card.tags[]", "number", "text", 1),
    }
    got = {tuple(r) for r in drift.type_drift(log, contract).collect()}
    assert got == wanted | nested | {("after.a.b.c.d", "number", None, 1)}
    # what lies below the last level is told, not lost
    got = {tuple(r) for r in drift.type_drift(log, contract, depth=4).collect()}
    assert got == wanted | nested - {("after.a.b.c", "object", None, 1)} | {("after.a.b.c", "unread object", None, 1)}
    kinds = {(r.path, r.kind): r.records for r in drift.payload_kinds(log).collect()}
    assert kinds[("after.id", "number")] == 2 and kinds[("after.card", "null")] == 1 and kinds[("after.card.tags[]", "text")] == 1
    assert drift.type_drift(log.where("false"), contract).isEmpty()
