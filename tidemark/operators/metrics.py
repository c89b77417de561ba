"""Aggregates of the metric layer and of the dashboards.

All are grouped sums, counts and averages with a partial step before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.fixed_values import AUTHORIZED

MONEY = "decimal(18,2)"


def authorized_share(status: str = "payment_status", exact: bool = False) -> Column:
    """Share of authorized rows as a double; rounded to 5 places unless ``exact``.

    The rounding is that of a decimal average of 1.0 and 0.0.
    """
    authorized = F.col(status) == AUTHORIZED
    if exact:
        return F.avg(F.when(authorized, 1.0).otherwise(0.0))
    one, zero = F.lit(Decimal("1.0")), F.lit(Decimal("0.0"))
    return F.avg(F.when(authorized, one).otherwise(zero)).cast("double")


def hourly_metrics(payments: DataFrame, exact_rate: bool = False) -> DataFrame:
    """Count, volume and authorized share by hour, country and method."""
    hour = F.date_trunc("hour", F.col("created_at")).alias("payment_hour")
    return payments.groupBy(hour, "country_code", "payment_method").agg(
        F.count("*").alias("payment_count"),
        F.sum("amount").cast(MONEY).alias("gross_volume"),
        authorized_share(exact=exact_rate).alias("auth_rate"),
    )


# --- cells that can be added to and taken from -----------------------------------------

CELL = ("payment_hour", "country_code", "payment_method")
SUMS = ("payment_count", "valued_count", "gross_volume", "authorized_count")


def signed_payments(changes: DataFrame) -> DataFrame:
    """Rows ``(sign, payment columns)`` of change rows ``(before, after)``: the old image counts -1, the new one +1.

    An image that is NULL, or marked ``_deleted``, is no payment.
    """
    def image(side: str, sign: int) -> Column:
        row = F.col(side)
        fields = changes.schema[side].dataType.names
        live = row.isNotNull() & (~F.coalesce(row["_deleted"], F.lit(False)) if "_deleted" in fields else F.lit(True))
        return F.when(live, F.struct(F.lit(sign).alias("sign"), *[row[c].alias(c) for c in ("created_at", "amount", "country_code", "payment_method", "payment_status")]))

    images = F.filter(F.array(image("before", -1), image("after", 1)), lambda i: i.isNotNull())
    return changes.select(F.inline(images))


def hourly_cells(signed: DataFrame) -> DataFrame:
    """Sums per hour, country and method of rows with a ``sign``; without one every row counts once."""
    sign = F.col("sign") if "sign" in signed.columns else F.lit(1)
    hour = F.date_trunc("hour", F.col("created_at")).alias("payment_hour")
    return signed.groupBy(hour, "country_code", "payment_method").agg(
        F.sum(sign).cast("long").alias("payment_count"),
        F.sum(F.when(F.col("amount").isNotNull(), sign).otherwise(0)).cast("long").alias("valued_count"),
        F.coalesce(F.sum(F.col("amount") * sign), F.lit(0)).cast("decimal(28,2)").alias("gross_volume"),
        F.sum(F.when(F.col("payment_status") == AUTHORIZED, sign).otherwise(0)).cast("long").alias("authorized_count"),
    )


def add_cells(cells: DataFrame, deltas: DataFrame) -> DataFrame:
    """Cells with the deltas added in. One that nets to nothing stays, with zeros: see ``gold_of_cells``."""
    sums = [F.sum(c).cast(cells.schema[c].dataType).alias(c) for c in SUMS]
    return cells.select(*CELL, *SUMS).unionByName(deltas.select(*CELL, *SUMS)).groupBy(*CELL).agg(*sums)


def gold_of_cells(cells: DataFrame) -> DataFrame:
    """Count, volume and share as ``hourly_metrics`` gives them, of the cells that hold a payment."""
    share = F.col("authorized_count").cast("decimal(12,1)") / F.col("payment_count").cast("decimal(20,0)")
    return cells.where(F.col("payment_count") > 0).select(
        *CELL, "payment_count",
        F.when(F.col("valued_count") > 0, F.col("gross_volume")).cast(MONEY).alias("gross_volume"),
        share.cast("decimal(6,5)").cast("double").alias("auth_rate"),
    )


def rollup_country_method(gold: DataFrame) -> DataFrame:
    """Hourly cells added up per country and method, largest volume first.

    Only additive measures: a share has to be re-weighted, see ``weighted_share``.
    """
    return (
        gold.groupBy("country_code", "payment_method")
        .agg(
            F.sum("payment_count").alias("total_payments"),
            F.sum("gross_volume").cast(MONEY).alias("total_volume"),
        )
        .orderBy(F.desc("total_volume"))
    )


def weighted_share(rate: str = "auth_rate", weight: str = "payment_count") -> Column:
    return F.try_divide(F.sum(F.col(rate) * F.col(weight)), F.sum(weight))


def affected_hours(decoded: DataFrame, both_images: bool = False) -> DataFrame:
    """Distinct hours that a batch of decoded events touches.

    A delete counts under its old creation time, anything else under its new one;
    ``both_images`` takes both, so that a payment moved to another hour marks the old one.
    """
    old, new = F.col("_before_created_at"), F.col("created_at")
    if both_images:
        times = decoded.select(F.explode(F.array(old, new)).alias("_at"))
    else:
        times = decoded.select(F.when(F.col("_route") == "delete", old).otherwise(new).alias("_at"))
    hour = F.date_trunc("hour", F.col("_at")).alias("payment_hour")
    # the NULL hour goes after the grouping, tied to its count: a plain filter would be pushed
    # to the scan and carry copies of the parse with it
    hours = times.select(hour).groupBy("payment_hour").agg(F.count("*").alias("_n"))
    return hours.where(F.when(F.col("_n") > 0, F.col("payment_hour")).isNotNull()).select("payment_hour")


def in_hours(payments: DataFrame, hours: DataFrame) -> DataFrame:
    """Payments created in one of ``hours``; the smaller side is picked at run time."""
    keyed = payments.withColumn("payment_hour", F.date_trunc("hour", F.col("created_at")))
    return keyed.join(hours, "payment_hour", "left_semi").drop("payment_hour")


# --- dashboard panels ------------------------------------------------------------------


def _stamped(df: DataFrame, clock: Column | None) -> DataFrame:
    return df if clock is None else df.select(clock.alias("time"), "*")


def total_rows(df: DataFrame, name: str, clock: Column | None = None) -> DataFrame:
    return _stamped(df.agg(F.count("*").cast("double").alias(name)), clock)


def gross_volume(payments: DataFrame, clock: Column | None = None) -> DataFrame:
    volume = F.coalesce(F.sum("amount"), F.lit(0)).cast("double")
    return _stamped(payments.agg(volume.alias("gross_volume")), clock)


def authorization_rate(payments: DataFrame, clock: Column | None = None) -> DataFrame:
    rate = F.coalesce(authorized_share(exact=True), F.lit(0.0))
    return _stamped(payments.agg(rate.alias("authorization_rate")), clock)


def authorization_rate_4dp(payments: DataFrame) -> DataFrame:
    """The share of the whole table to four places, halves to the even digit; 0 if empty."""
    hits = F.count_if(F.col("payment_status") == AUTHORIZED).cast("decimal(19,0)")
    share = F.try_divide(hits, F.count("*").cast("decimal(19,0)"))
    rounded = F.bround(F.coalesce(share, F.lit(0)), 4).cast("decimal(5,4)")
    return payments.agg(rounded.alias("auth_rate"))


def volume_by_hour(payments: DataFrame) -> DataFrame:
    hour = F.date_trunc("hour", F.col("created_at")).alias("time")
    volume = F.sum("amount").cast("double").alias("gross_volume")
    return payments.groupBy(hour).agg(volume).orderBy("time")


def rows_by_hour(df: DataFrame, name: str) -> DataFrame:
    hour = F.date_trunc("hour", F.col("created_at")).alias("time")
    return df.groupBy(hour).agg(F.count("*").cast("double").alias(name)).orderBy("time")


def count_by(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").cast("double").alias(name)).orderBy(F.desc(name))


def volume_by(payments: DataFrame, column: str) -> DataFrame:
    volume = F.sum("amount").cast("double").alias("gross_volume")
    return payments.groupBy(column).agg(volume).orderBy(F.desc("gross_volume"))


def share_of_total(df: DataFrame, column: str) -> DataFrame:
    """Rows per value and their share of all rows.

    The total is a scalar subquery that reads no columns, so nothing is gathered into one
    task however many values there are.
    """
    total = df.agg(F.count("*").alias("n")).scalar()
    counted = df.groupBy(column).agg(F.count("*").alias("payments"))
    return counted.withColumn("share", F.col("payments") / total)


def state_counts(df: DataFrame, state: str, states: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows per state as one column each; a state that never occurs counts 0."""
    counts = [F.count_if(F.col(state) == name).alias(name.lower()) for name in states]
    return df.groupBy(*by).agg(*counts)
