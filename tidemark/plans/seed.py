"""Demo merchants, payments and refunds; the generators take any id series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.operators.merge import insert_if_absent

PAYMENT_COLUMNS = (
    "payment_id", "merchant_id", "shopper_id", "amount", "currency", "payment_method",
    "payment_status", "country_code", "created_at", "updated_at",
)
REFUND_COLUMNS = ("refund_id", "payment_id", "refund_amount", "refund_reason", "created_at")


def _cycle(values: Sequence[str], step: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (step % len(values) + 1).cast("int"))


def _hours(n: Column) -> Column:
    return F.make_dt_interval(hours=n.cast("int"))


def demo_merchants(spark: SparkSession, base: Column) -> DataFrame:
    rows = spark.createDataFrame(
        fixed.DEMO_MERCHANTS,
        "merchant_id BIGINT, merchant_name STRING, country_code STRING, category STRING",
    )
    return rows.withColumn("created_at", base)


def literal_payments(spark: SparkSession, base: Column) -> DataFrame:
    rows = spark.createDataFrame(
        fixed.DEMO_PAYMENTS,
        "payment_id BIGINT, merchant_id BIGINT, shopper_id BIGINT, amount STRING, currency STRING, "
        "payment_method STRING, payment_status STRING, country_code STRING, created_ago INT, updated_ago INT",
    )
    return rows.select(
        *PAYMENT_COLUMNS[:3],
        F.col("amount").cast("decimal(12,2)").alias("amount"),
        *PAYMENT_COLUMNS[4:8],
        (base - _hours(F.col("created_ago"))).alias("created_at"),
        (base - _hours(F.col("updated_ago"))).alias("updated_at"),
    )


def generated_payments(series: DataFrame, base: Column, n: str = "n") -> DataFrame:
    """One payment per number of ``series`` (1, 2, 3, ...)."""
    number = F.col(n)
    step = number - 1
    whole, cents = 25 + number * 17 % 475, number * 13 % 100  # fixed values, as are the steps below
    quarter = F.make_dt_interval(mins=(step % 4 * 15).cast("int"))
    created = F.date_trunc("hour", base - _hours(step % 168)) - quarter
    rows = series.select(
        (2000 + number).alias("payment_id"),
        (step % 10 + 1).alias("merchant_id"),
        (700 + number).alias("shopper_id"),
        (whole + cents.cast("decimal(10,2)") / 100).cast("decimal(12,2)").alias("amount"),
        _cycle(fixed.DEMO_CURRENCIES, step).alias("currency"),
        _cycle(fixed.DEMO_METHODS, step).alias("payment_method"),
        _cycle(fixed.DEMO_STATUSES, step).alias("payment_status"),
        _cycle(fixed.DEMO_COUNTRIES, step).alias("country_code"),
        created.alias("created_at"),
    )
    later = _hours(F.col("payment_id") % 6 + 1)
    return rows.withColumn("updated_at", F.col("created_at") + later)


def demo_payments(spark: SparkSession, base: Column) -> DataFrame:
    series = spark.range(1, fixed.DEMO_SERIES_LENGTH + 1).withColumnRenamed("id", "n")
    return insert_if_absent(literal_payments(spark, base), generated_payments(series, base), "payment_id")


def literal_refunds(spark: SparkSession, base: Column) -> DataFrame:
    rows = spark.createDataFrame(
        fixed.DEMO_REFUNDS,
        "refund_id BIGINT, payment_id BIGINT, refund_amount STRING, refund_reason STRING, ago INT",
    )
    return rows.select(
        "refund_id",
        "payment_id",
        F.col("refund_amount").cast("decimal(12,2)").alias("refund_amount"),
        "refund_reason",
        (base - _hours(F.col("ago"))).alias("created_at"),
    )


def refunds_for(payments: DataFrame) -> DataFrame:
    """One refund, half an hour after the last update, per refunded payment."""
    return payments.where(F.col("payment_status") == "refunded").select(
        (F.col("payment_id") + fixed.REFUND_ID_OFFSET).alias("refund_id"),
        "payment_id",
        F.col("amount").alias("refund_amount"),
        _cycle(fixed.REFUND_REASONS, F.col("payment_id")).alias("refund_reason"),
        (F.col("updated_at") + F.expr("INTERVAL 30 MINUTES")).alias("created_at"),
    )


def demo_refunds(
    spark: SparkSession, payments: DataFrame, base: Column, length: Column | int = fixed.DEMO_SERIES_LENGTH
) -> DataFrame:
    """Refunds of the generated payments, whose ids end with the series' ``length``."""
    end = (length if isinstance(length, Column) else F.lit(length)) + 2000
    generated = payments.where(F.col("payment_id").between(2001, end))
    return insert_if_absent(literal_refunds(spark, base), refunds_for(generated), "refund_id")
