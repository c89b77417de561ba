"""Published tables and the queries readers run on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import changes, metrics
from tidemark.streaming.jobs import Layout

SILVER_VIEW, GOLD_VIEW = "payments_silver", "payment_metrics_gold"


def publish(spark: SparkSession, layout: Layout, mode: str = changes.REFERENCE) -> None:
    """Register the live rows of both tables under their names.

    Sessions of the same application find them below ``global_temp``; the tables themselves are in
    the catalog, under ``layout.namespace``.
    """
    for name, rows in ((SILVER_VIEW, layout.read_silver(spark, mode)), (GOLD_VIEW, layout.read_gold(spark))):
        rows.createOrReplaceTempView(name)
        rows.createOrReplaceGlobalTempView(name)


def validation_queries(spark: SparkSession) -> dict[str, DataFrame]:
    silver, gold = spark.table(SILVER_VIEW), spark.table(GOLD_VIEW)
    return {
        "silver_rows": silver.agg(F.count("*").alias("silver_rows")),
        "gold_rows": gold.agg(F.count("*").alias("gold_rows")),
        "totals": metrics.rollup_country_method(gold),
    }
