"""Golden totals of the demo data."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import metrics, quality
from tidemark.plans import seed


@pytest.fixture(scope="module")
def base():
    return F.lit(datetime(2024, 5, 6, 7, 8, 9)).cast("timestamp")


@pytest.fixture(scope="module")
def payments(spark, base):
    return seed.demo_payments(spark, base).cache()


def by(df, column, value):
    return {r[0]: r[1] for r in df.groupBy(column).agg(value).collect()}


def test_payment_totals(spark, base, payments):
    assert seed.demo_merchants(spark, base).count() == 10
    assert payments.count() == 124
    assert payments.agg(F.sum("amount")).first()[0] == Decimal("30361.54")
    assert metrics.authorization_rate_4dp(payments).first().auth_rate == Decimal("0.3790")
    quality.enforce(payments, quality.payment_rules(), unique_key="payment_id")


def test_payment_groups(payments):
    assert by(payments, "payment_status", F.count("*")) == {
        "authorized": 47, "failed": 16, "refunded": 16, "pending": 15, "chargeback": 15, "cancelled": 15
    }
    assert by(payments, "payment_method", F.count("*")) == {
        "card": 27, "paypal": 25, "apple_pay": 24, "bank_transfer": 24, "google_pay": 24
    }
    assert {k: str(v) for k, v in by(payments, "payment_method", F.sum("amount")).items()} == {
        "card": "6237.76", "paypal": "6387.14", "apple_pay": "5820.76", "bank_transfer": "5753.88", "google_pay": "6162.00"
    }
    assert {k: str(v) for k, v in by(payments, "country_code", F.sum("amount")).items()} == {
        "NL": "3666.14", "US": "4272.60", "DE": "4074.30", "BE": "3423.00", "FR": "3587.95", "GB": "3841.90",
        "CA": "4095.85", "ES": "3399.80",
    }
    assert metrics.hourly_metrics(payments).select("country_code", "payment_method").distinct().count() == 40


def test_refunds(spark, base, payments):
    refunds = seed.demo_refunds(spark, payments, base)
    assert refunds.count() == 16 and refunds.agg(F.sum("refund_amount")).first()[0] == Decimal("3632.20")
    assert by(refunds, "refund_reason", F.count("*")) == {"duplicate": 16}
    assert quality.fk_orphans(refunds, payments, "payment_id", "payment_id").isEmpty()


def test_reload_adds_nothing(spark, base, payments):
    again = seed.insert_if_absent(payments, seed.demo_payments(spark, base), "payment_id")
    assert again.count() == 124
