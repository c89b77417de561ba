"""One key holding a third of all rows: what crosses the shuffle stays small."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.operators import changes, drift, feed, metrics, quality, series
from tidemark.sources import sample

ROWS = 30_000


@pytest.fixture(scope="module")
def events(spark):
    """A third of the events belong to one user and one payment of theirs."""
    n = F.col("id")
    hot = n % 3 == 0
    return spark.range(0, ROWS, 1, 8).select(
        F.when(hot, n * 10 + 7).otherwise(n).alias("event_id"),
        F.timestamp_seconds(1_704_067_200 + n).cast("timestamp_ntz").alias("ts"),
        F.when(hot, 4).otherwise(n % 50).alias("user_id"),
        F.when(n % 7 == 0, "error").otherwise("click").alias("event_type"),
        (n % 100).cast("double").alias("value"),
    )


@pytest.fixture(scope="module")
def log(spark, events, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skew") / "log")
    changes.with_route(changes.project_records(sample.change_records(events))).write.parquet(folder)
    return spark.read.parquet(folder)


def shuffled_records(df) -> int:
    """Records written by the widest shuffle of ``df``."""
    execution = df._jdf.queryExecution()
    df._jdf.queryExecution().executedPlan().execute().count()

    def walk(plan):
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            yield from walk(plan.executedPlan())
            return
        if kind.endswith("QueryStageExec"):
            yield from walk(plan.plan())
            return
        metric = plan.metrics().get("shuffleRecordsWritten")
        if metric.isDefined():
            yield metric.get().value()
        children = plan.children()
        for i in range(children.size()):
            yield from walk(children.apply(i))

    return max(walk(execution.executedPlan()), default=0)


def test_resolution(spark, log):
    files = len(log.inputFiles())
    for mode in (changes.REFERENCE, changes.ORDERED):
        resolved = changes.resolve(changes.decode(log), mode)
        keys = resolved.count()
        # at most one row per key and map task, and the hot key is a third of all rows
        assert shuffled_records(resolved) <= keys * files
        assert shuffled_records(resolved) < ROWS / 3


def test_grouped_measures(spark, events, log):
    payments = sample.payments(events)
    for df in (
        metrics.hourly_metrics(payments),
        metrics.count_by(payments, "country_code", "n"),
        quality.fk_orphans(payments, payments.where("shopper_id <> 4"), "shopper_id", "shopper_id"),
        drift.payload_drift(log, ["payment_id"]),
        series.last_value(events, ["user_id"], "value", ["ts"]),
        metrics.affected_hours(changes.decode(log)),
    ):
        assert df.count() > 0
        assert 0 < shuffled_records(df) < ROWS / 10


def test_counter_rate_matches_plain_lag(spark, events):
    from pyspark.sql import Window

    plain = events.withColumn("p", F.lag("value").over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    split = series.with_previous(events, ["user_id"], ["ts", "event_id"], "value", "p", rows_per_slice=5_000)
    assert split.exceptAll(plain.select(*split.columns)).isEmpty()
    assert plain.count() == split.count()


def test_counter_segments_of_a_series_with_nine_tenths_of_all_rows(spark):
    """No task reads more than a few slices of the hot series, and segments add up to the plain lag."""
    from pyspark.sql import Window

    n = F.col("id")
    samples = spark.range(0, ROWS, 1, 8).select(
        F.timestamp_seconds(1_704_067_200 + n).alias("ts"), (n * 37 % 101).alias("value"), n.alias("event_id"),
        F.when(n % 10 == 0, n % 7 + 1).otherwise(0).alias("series"), F.when(n % 1000 < 500, "a").otherwise("b").alias("label"),
    )
    for by in (["series"], ["label"]):
        segments = series.counter_segments(samples, ["series"], "ts", "value", by, ["event_id"])
        rate = series.counter_rate(samples, ["series"], "ts", "value", by, ["event_id"])
        before = F.lag("value").over(Window.partitionBy("series").orderBy("ts", "event_id"))
        plain = samples.withColumn("step", series.increase(before, F.col("value"))).where("step IS NOT NULL")
        start = F.window("ts", "5 minutes")["start"].alias("window_start")
        want = plain.groupBy(*by, start).agg((F.sum("step").cast("double") / 300).alias("rate"))
        assert {tuple(r) for r in rate.collect()} == {tuple(r) for r in want.select(*rate.columns).collect()}
        # what meets by series is segments, a sixtieth of the hot one's samples
        assert segments.where("series = 0").count() < 2 * ROWS / 60 + 2
    assert rate._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 1


def test_segments_merge_across_gaps_restarts_and_nulls(spark):
    rows = [(0, 5.0), (30, 7.0), (400, 1.0), (410, None), (2000, 4.0), (2001, 4.0), (90_000, 10.0)]
    samples = spark.createDataFrame([(k, t, v) for k in (1, 2) for t, v in rows], "series int, t int, value double")
    samples = samples.withColumn("ts", F.timestamp_seconds("t"))
    got = {(r.series, int(r.window_start.timestamp())): r.rate * 300 for r in series.counter_rate(samples, ["series"], "ts", "value", ["series"]).collect()}
    want = {0: 2.0, 300: 1.0, 1800: 3.0, 90_000: 6.0}
    assert got == {(k, w): pytest.approx(v) for k in (1, 2) for w, v in want.items()}
    with pytest.raises(ValueError):
        series.counter_rate(samples, ["series"], "ts", "value", slice_seconds=7)


def test_a_sparse_feed_moves_digests_and_few_rows(spark):
    """One row in a thousand has changed: under a twentieth of the rows cross a shuffle."""
    old = spark.range(0, 200_000, 1, 8).selectExpr("id AS k", "CAST(id AS STRING) AS v")
    new = old.selectExpr("k", "CASE WHEN k % 1000 = 5 THEN 'x' ELSE v END AS v")
    digests = feed.differing_buckets(old, new, "k", 32, 1)
    assert digests.count() == 200
    assert 0 < shuffled_records(digests) < 400_000 / 20
    found = feed.sparse_change_feed(old, new, "k")
    assert found.count() == 200
    assert 0 < shuffled_records(found) < 400_000 / 20
