from __future__ import annotations

from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.fixed_values import QUERY_STATES
from tidemark.functions.text import clean_code, clean_token, clean_token_per_space
from tidemark.operators import metrics, series
from tidemark.plans.normalize import normalize_payments


def statuses(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "payment_status STRING")


@pytest.mark.parametrize(
    "values, rate",
    [((), "0.0000"), (("authorized", "failed", "authorized"), "0.6667"), (("authorized",), "1.0000"),
     (("authorized",) + ("failed",) * 15 , "0.0625"), (("authorized",) + ("failed",) * 31, "0.0312")],
)
def test_rate_to_four_places_rounds_halves_to_even(spark, values, rate):
    assert metrics.authorization_rate_4dp(statuses(spark, *values)).first().auth_rate == Decimal(rate)


def test_empty_panels_are_zero(spark):
    empty = spark.createDataFrame([], schemas.PAYMENT)
    assert metrics.gross_volume(empty).first().gross_volume == 0.0
    assert metrics.authorization_rate(empty).first().authorization_rate == 0.0
    stamped = metrics.total_rows(empty, "total_payments", clock=F.current_timestamp())
    assert stamped.columns == ["time", "total_payments"] and stamped.first().total_payments == 0.0


def test_hourly_share_has_five_places_unless_exact(spark):
    rows = spark.createDataFrame(
        [("authorized", "1.00"), ("failed", "2.00"), ("authorized", "3.50")], "payment_status STRING, a STRING"
    ).select("payment_status", F.col("a").cast("decimal(12,2)").alias("amount"), F.lit("NL").alias("country_code"),
             F.lit("card").alias("payment_method"), F.timestamp_micros(F.lit(5_000_000)).alias("created_at"))
    row = metrics.hourly_metrics(rows).first()
    assert (row.payment_count, row.gross_volume, row.auth_rate) == (3, Decimal("6.50"), 0.66667)
    assert metrics.hourly_metrics(rows, exact_rate=True).first().auth_rate == pytest.approx(2 / 3, abs=1e-15)
    assert dict(metrics.hourly_metrics(rows).dtypes) == {f.name: f.dataType.simpleString() for f in schemas.GOLD.fields}


def test_state_counts(spark):
    rows = spark.createDataFrame([(s,) for s in ["RUNNING"] * 2 + ["QUEUED"] + ["FINISHED"] * 3 + ["FAILED"]], "state STRING")
    assert metrics.state_counts(rows, "state", QUERY_STATES).first().asDict() == {
        "running": 2, "queued": 1, "blocked": 0, "finished": 3, "failed": 1
    }


def test_text_rules(spark):
    row = spark.createDataFrame([(" Apple  Pay ", " gb ")], "a STRING, b STRING").select(
        clean_token(F.col("a")).alias("t"), clean_token_per_space(F.col("a")).alias("s"), clean_code(F.col("b")).alias("c")
    ).first()
    assert tuple(row) == ("apple_pay", "apple__pay", "GB")


def test_record_shape(spark):
    names = ["payment_id", "merchant_id", "shopper_id", "amount", "currency", "payment_method", "payment_status",
             "country_code", "created_at", "updated_at"]
    raw = spark.createDataFrame(
        [("1", "2", "3", "42.50", "eur", "Card", "AUTHORIZED", "nl", "2026-01-01T00:00:00", "2026-01-01T00:00:05")], names
    )
    row = normalize_payments(raw).first()
    assert (row.payment_id, row.amount, row.currency, row.payment_method) == (1, Decimal("42.50"), "EUR", "card")
    assert (row.payment_status, row.country_code, row.created_at) == ("authorized", "NL", "2026-01-01T00:00:00")


samples = st.lists(
    st.tuples(st.sampled_from(["hot", "hot", "hot", "a", None]), st.integers(0, 1500), st.integers(0, 9)),
    min_size=1, max_size=40,
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(points=samples, size=st.integers(1, 50))
def test_previous_value_matches_brute_force(spark, points, size):
    rows = [(key, second, i, value) for i, (key, second, value) in enumerate(points)]
    df = spark.createDataFrame(rows, "k STRING, t INT, i INT, v INT")
    got = series.with_previous(df, ["k"], ["t", "i"], "v", "p", size)
    last, expected = {}, {}
    for key, _, i, value in sorted(rows, key=lambda r: (r[1], r[2])):
        expected[i] = last.get(key)
        last[key] = value
    assert {r.i: r.p for r in got.collect()} == expected


def test_hot_series_is_spread_over_tasks(spark):
    df = spark.range(20_000).select(F.lit("hot").alias("k"), F.col("id").alias("t"), (F.col("id") % 7).alias("v"))
    got = series.with_previous(df, ["k"], ["t"], "v", "p", rows_per_slice=2_500)
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 20_000 and got.where(F.col("p").isNull()).count() == 1
    assert got.where(F.col("p") != (F.col("t") + 6) % 7).isEmpty()


def test_counter_restart(spark):
    rows = [("s", 0, 10), ("s", 60, 40), ("s", 120, 5), ("s", 360, 20)]
    df = spark.createDataFrame(rows, "s STRING, sec INT, v INT").withColumn("ts", F.timestamp_seconds("sec"))
    got = series.counter_rate(df, ["s"], "ts", "v").orderBy("window_start").collect()
    assert [r.rate for r in got] == [pytest.approx(35 / 300), pytest.approx(15 / 300)]


def test_null_sample_does_not_break_the_chain(spark):
    rows = [("s", 0, 10), ("s", 60, None), ("s", 120, 40)]
    df = spark.createDataFrame(rows, "s STRING, sec INT, v INT").withColumn("ts", F.timestamp_seconds("sec"))
    assert [r.rate for r in series.counter_rate(df, ["s"], "ts", "v").collect()] == [pytest.approx(30 / 300)]


def test_slices_keep_their_size(spark, monkeypatch):
    stored, settle = [], series.settle
    monkeypatch.setattr(series, "settle", lambda df, label: stored.append(settle(df, label)) or stored[-1])
    for rows in (4_000, 40_000):
        df = spark.range(rows).select(F.lit("hot").alias("k"), F.col("id").alias("t"), (F.col("id") % 7).alias("v"))
        assert series.with_previous(df, ["k"], ["t"], "v", "p", rows_per_slice=2_000).count() == rows
        sizes = [r["count"] for r in stored[-1].groupBy("_slice").count().collect()]
        assert sum(sizes) == rows and max(sizes) < 4_000
