"""Row rules, key rules and reference checks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.fixed_values import COUNTRY_PATTERN, CURRENCY_PATTERN, PAYMENT_METHODS, PAYMENT_STATUSES

Rules = Mapping[str, Column]


class DataQualityError(ValueError):
    """A batch broke at least one rule; ``failures`` maps rule name to row count."""

    def __init__(self, failures: Mapping[str, int]):
        super().__init__(f"data quality rules failed: {dict(failures)}")
        self.failures = dict(failures)


def payment_rules() -> dict[str, Column]:
    """Rule name to the condition that marks a bad row.

    A NULL value meets only its ``null_`` rule: the other conditions are unknown on NULL
    and unknown is not counted.
    """
    rules = {f"null_{name}": F.col(name).isNull() for name in schemas.PAYMENT.names}
    rules["negative_amount"] = F.col("amount") < 0
    rules["invalid_currency"] = ~F.col("currency").rlike(CURRENCY_PATTERN)
    rules["invalid_country_code"] = ~F.col("country_code").rlike(COUNTRY_PATTERN)
    rules["invalid_payment_method"] = ~F.col("payment_method").isin(*PAYMENT_METHODS)
    rules["invalid_payment_status"] = ~F.col("payment_status").isin(*PAYMENT_STATUSES)
    rules["updated_before_created"] = F.col("updated_at") < F.col("created_at")
    return rules


def required_rules(*columns: str) -> dict[str, Column]:
    """NOT NULL constraints as rules."""
    return {f"null_{name}": F.col(name).isNull() for name in columns}


def dq_metrics(df: DataFrame, rules: Rules) -> DataFrame:
    """One row with the count of bad rows per rule: one scan, no shuffle of rows."""
    return df.agg(*[F.count_if(bad).alias(name) for name, bad in rules.items()])


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Non-NULL keys held by more than one row."""
    counted = df.groupBy(key).agg(F.count("*").alias("row_count"))
    return counted.where(F.col(key).isNotNull() & (F.col("row_count") > 1))


def enforce(df: DataFrame, rules: Rules, unique_key: str | None = None) -> None:
    """Raise if any rule counts a row (or, on request, if ``unique_key`` repeats).

    Only one row of counters, and one count, reach the driver.
    """
    counts = dq_metrics(df, rules).first().asDict()
    if unique_key:
        counts[f"duplicate_{unique_key}s"] = duplicate_keys(df, unique_key).count()
    raise_on_failures(counts)


def raise_on_failures(counts: Mapping[str, int]) -> None:
    failures = {name: count for name, count in counts.items() if count}
    if failures:
        raise DataQualityError(failures)


def quarantine(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """Clean rows, and bad rows with the list of rules each one broke."""
    broken = F.filter(
        F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()]), lambda r: r.isNotNull()
    )
    judged = df.withColumn("_broken_rules", broken)
    clean = judged.where(F.size("_broken_rules") == 0).drop("_broken_rules")
    return clean, judged.where(F.size("_broken_rules") > 0)


def fk_orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Foreign-key values without a parent, with the number of child rows behind each.

    The child is counted per value before the join, so a value shared by most child rows
    crosses the shuffle as one row per map task.
    """
    used = child.where(F.col(fk).isNotNull()).groupBy(fk).agg(F.count("*").alias("child_rows"))
    return used.join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")


def orphans_in_motion(
    children: DataFrame, parents: DataFrame, fk: str, pk: str, child_time: str, parent_time: str,
    wait: str, reach: str, late: str, spread: int = 1,
) -> DataFrame:
    """Rows of a stream whose parent did not come in time, each given out once it no longer can.

    A parent counts if its time is at most ``reach`` before and ``wait`` after that of the child. Both streams
    may be ``late`` by so much; a row later than that is dropped behind the watermark, as any in the
    stream. So a child is held until the watermark of the parents has passed its time and
    ``wait``, and a parent until no child can name it: the state is bounded by the three intervals. A NULL
    reference names nobody and is no orphan; a child without a time is never given out.

    ``spread``: over how many tasks the children of one parent are dealt. Parents are repeated so often, so raise it
    only if one parent has a large share of all children.
    """
    dealt = F.pmod(F.xxhash64(*children.columns), F.lit(spread)).cast("int")
    child = children.where(F.col(fk).isNotNull()).withWatermark(child_time, late).withColumn("_share", dealt)
    shares = F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("_of")
    parent = parents.withWatermark(parent_time, late).select(F.col(pk).alias("_pk"), F.col(parent_time).alias("_came"), shares)
    near = F.expr(f"_came >= {child_time} - INTERVAL {reach} AND _came <= {child_time} + INTERVAL {wait}")
    same = (F.col(fk) == F.col("_pk")) & (F.col("_share") == F.col("_of")) & near
    return child.join(parent, same, "left_outer").where(F.col("_pk").isNull()).select(*children.columns)
