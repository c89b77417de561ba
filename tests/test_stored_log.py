"""What the stored record log and raw log cost to write."""

from __future__ import annotations

import pytest
from pyspark.sql import DataFrameWriter

from tidemark.operators import changes, metrics
from tidemark.plans import layers
from tidemark.sinks.tables import setting
from tidemark.sources import sample

SMALL = "/root/testdata/sf0.001"


def test_only_narrow_events_are_shuffled(spark, monkeypatch):
    """Neither log moves its wide payloads between tasks, nor sorts them to deal them round robin."""
    plans = []
    write = DataFrameWriter.parquet

    def parquet(self, path, *args, **kwargs):
        plans.append(self._df._jdf.queryExecution().optimizedPlan().toString())
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(sample, "_stored", {})
    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    log = sample.raw_log(spark, SMALL)
    assert len(plans) == 2
    for plan in plans:
        assert not plan.startswith("RebalancePartitions")
        assert "json" not in plan.partition("RebalancePartitions")[2].lower()
    assert log.count() == sample.load(spark, SMALL, "events").count()


def test_a_personal_field_is_hashed_once(spark):
    """One digest for the swap in place, one in each of the two ways to rebuild a payload."""
    with setting(spark, "spark.sql.debug.maxToStringFields", "1000"):
        rows = layers.stored_bronze(sample.record_log(spark, SMALL))
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sha2(") == 3


@pytest.mark.parametrize("both_images", [True, False])
def test_hours_are_told_by_the_creation_times_alone(spark, both_images):
    odd = [
        '{"op":"u","before":{"created_at":1},"after":{"created_at":"7200000000"}}', '{"op":"d","before":{"created_at":null}}',
        '{"op":"d","before":"text","after":[1]}', '{"op":"c","after":{"created_at":1e10,"payment_id":{"a":[1]}}}', '{"op":"c","after":{',
        '{"op":"t","after":{"created_at":-1}}', "not-json", None,
    ]
    rows = spark.createDataFrame([(v, k) for k, v in enumerate(odd)], "kafka_value STRING, kafka_offset LONG")
    stored = sample.raw_log(spark, SMALL)
    for log in (rows, stored):
        whole = metrics.affected_hours(changes.decode(log), both_images)
        times = metrics.affected_hours(changes.creation_times(log), both_images)
        assert sorted(times.collect()) == sorted(whole.collect())
    plan = changes.creation_times(stored)._jdf.queryExecution().optimizedPlan().toString()
    assert "amount" not in plan
