"""Connectors that stock Spark lacks: what can be checked without them."""

from __future__ import annotations

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException

from tidemark import schemas
from tidemark.plans import serving
from tidemark.sinks import lake
from tidemark.sources import records, sample
from tidemark.sources.catalog import visible_tables
from tidemark.streaming import jobs


@pytest.mark.parametrize(
    "statement",
    [
        lake.create_statement("lake.analytics.payments_silver", schemas.SILVER, "created_at"),
        lake.changes_statement("lake.analytics.payments_silver", "payment_id", schemas.SILVER.names),
        lake.delete_statement("lake.analytics.payments_silver", "payment_id"),
    ],
)
def test_statements_parse(spark, statement):
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(statement)
    assert "payments_silver" in plan.toString()


def test_missing_connectors_say_so(spark):
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        records.kafka_records(spark, "localhost:1", "cdc.public.payments")
    with pytest.raises((AnalysisException, Py4JJavaError), match="(?i)iceberg"):
        records.stream_lake_table(spark, "lake.analytics.payments_bronze")


def test_published_tables_answer_the_validation_queries(spark, tmp_path):
    layout = jobs.Layout(str(tmp_path / "t"), str(tmp_path / "p"))
    jobs.apply_batch(sample.raw_log(spark, "/root/testdata/sf0.001"), 0, layout)
    jobs.run_gold(spark, layout)
    serving.publish(spark, layout)
    other = spark.newSession()
    assert other.table("global_temp.payments_silver").count() == layout.read_silver(spark).count()
    assert {"payments_silver", "payment_metrics_gold"} <= set(visible_tables(spark))
    answers = serving.validation_queries(spark)
    totals = answers["totals"].collect()
    assert sum(r.total_payments for r in totals) == answers["silver_rows"].first().silver_rows > 0
    assert [r.total_volume for r in totals] == sorted((r.total_volume for r in totals), reverse=True)
    assert answers["gold_rows"].first().gold_rows >= len(totals)
    # the tables themselves are seen by every session of the catalog
    assert other.table(layout.silver).count() == other.table("global_temp.payments_silver").count()
    spark.sql(f"DROP DATABASE {layout.namespace} CASCADE")
