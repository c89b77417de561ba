"""The incremental jobs against the same operators run in batch."""

from __future__ import annotations

import json
import random
import time
from collections import Counter
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import changes, metrics, quality, series
from tidemark.plans import layers
from tidemark.sinks import tables
from tidemark.sinks.deadletter import read_dead_letters, write_dead_letters
from tidemark.sources import sample
from tidemark.sources.records import file_records, stream_table
from tidemark.streaming import jobs

SMALL = "/root/testdata/sf0.001"
COLUMNS = schemas.PAYMENT.names


@pytest.fixture
def layout(spark, tmp_path):
    made = jobs.Layout(str(tmp_path / "tables"), str(tmp_path / "progress"), buckets=2)
    yield made
    spark.sql(f"DROP DATABASE IF EXISTS {made.namespace} CASCADE")


def files(spark, name):
    """Paths of a table's data files; a rewritten partition has new ones."""
    spark.catalog.refreshTable(name)
    return set(spark.table(name).inputFiles())


def folders(paths):
    return {p.rsplit("/", 1)[0] for p in paths}


def event(op, key, hour=0, amount="10.00", status="authorized", **more):
    """A change event whose payment is made so many hours after 2024-01-01."""
    micros = (1_704_067_200 + hour * 3600) * 1_000_000
    image = {
        "payment_id": key, "merchant_id": 1, "amount": amount, "currency": "EUR", "payment_method": "card",
        "payment_status": status, "country_code": "NL", "created_at": micros, "updated_at": micros + 1_000_000,
    } | more
    return json.dumps({"op": op, "before" if op == "d" else "after": {"payment_id": key} if op == "d" else image})


def log_of(spark, *values, start=0):
    return spark.createDataFrame([(v, start + k) for k, v in enumerate(values)], "kafka_value STRING, kafka_offset BIGINT")


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def records_in_order(spark, folder, batches=3):
    """The record log split by time into one file per batch; offsets restart on the way."""
    records = sample.record_log(spark, SMALL)
    at = F.unix_seconds("timestamp")
    first, last = records.agg(F.min(at), F.max(at)).first()
    for i in range(batches):
        part = records.where(F.least(F.floor((at - first) * batches / (last - first)), F.lit(batches - 1)) == i)
        part.coalesce(1).write.mode("append").parquet(folder)
        yield i


@pytest.mark.parametrize("mode", [changes.REFERENCE, changes.ORDERED])
def test_layers_fed_in_steps(spark, tmp_path, layout, mode):
    folder = str(tmp_path / "records")
    log = sample.raw_log(spark, SMALL)
    for step in records_in_order(spark, folder):
        jobs.run_layers(file_records(spark, folder), layout, mode)
        assert spark.table(layout.batches).count() == step + 1

    # raw log: every record once, masked
    stored = spark.read.parquet(layout.bronze)
    assert bag(stored.select(*schemas.BRONZE.names)) == bag(log.select(*schemas.BRONZE.names))

    live = layout.read_silver(spark, mode)
    if mode == changes.ORDERED:
        # the outcome does not depend on how the log was cut
        assert bag(live.select(*COLUMNS)) == bag(layers.silver_state(log, mode))
    assert live.select("payment_id").distinct().count() == live.count()

    # metrics that followed the changes equal metrics of the final state
    assert bag(layout.read_gold(spark)) == bag(metrics.hourly_metrics(live).select(*schemas.GOLD.names))

    letters = read_dead_letters(spark, layout.dead_letters)
    assert letters.count() == log.where(F.col("_route").isin("null_op", "unexpected_op")).count()
    assert letters.select("batch_id").distinct().count() == 3

    # nothing new: nothing happens
    names = (layout.silver, layout.cells, layout.batches, layout.change_log)
    before = [files(spark, n) for n in names]
    jobs.run_layers(file_records(spark, folder), layout, mode)
    assert [files(spark, n) for n in names] == before


def test_steps_equal_batches_in_reference_mode(spark, layout):
    log = sample.raw_log(spark, SMALL)
    half = F.lit(datetime(2024, 1, 16))
    parts = [log.where(F.col("kafka_timestamp") <= half), log.where(F.col("kafka_timestamp") > half)]
    state = layers.silver_state(parts[0])
    for i, part in enumerate(parts):
        assert jobs.apply_batch(part, i, layout) > 0
    state = changes.apply_changes(state, changes.resolve(changes.decode(parts[1])))
    assert bag(layout.read_silver(spark).select(*COLUMNS)) == bag(state.select(*COLUMNS))
    # an earlier state, and a replay of the last batch
    assert bag(jobs.silver_as_of(spark, layout, "manual", 0).select(*COLUMNS)) == bag(layers.silver_state(parts[0]))
    before = files(spark, layout.silver)
    assert jobs.apply_batch(parts[1], 1, layout) == 0 and files(spark, layout.silver) == before


def test_metrics_from_events_and_from_changes(spark, layout):
    log = sample.raw_log(spark, SMALL)
    jobs.apply_batch(log, 0, layout)
    jobs.apply_gold_batch(log, layout)
    full = metrics.hourly_metrics(layout.read_silver(spark)).select(*schemas.GOLD.names)
    assert bag(layout.read_gold_by_hour(spark)) == bag(full)
    jobs.run_gold_from_changes(spark, layout)
    assert bag(layout.read_gold_by_hour(spark)) == bag(full)
    # a delete that names only its key: the events do not tell the hour, the change rows do
    key = layout.read_silver(spark).first().payment_id
    jobs.apply_batch(log_of(spark, event("d", key)), 1, layout)
    jobs.run_gold_from_changes(spark, layout)
    full = metrics.hourly_metrics(layout.read_silver(spark)).select(*schemas.GOLD.names)
    assert bag(layout.read_gold_by_hour(spark)) == bag(full)


def test_bad_batch_publishes_nothing(spark, layout):
    bad = '{"op":"c","after":{"payment_id":1,"amount":"-5"}}'
    for _ in range(2):
        with pytest.raises(quality.DataQualityError, match="negative_amount"):
            jobs.apply_batch(log_of(spark, bad, "junk"), 0, layout)
    for name in (layout.silver, layout.change_log, layout.batches):
        assert not files(spark, name)
    # a retried batch does not repeat its dead letters
    assert read_dead_letters(spark, layout.dead_letters).count() == 1


@pytest.mark.parametrize("broken", ["_rewrite_parts", "drop_parts", "overwrite_parts"])
def test_a_batch_that_failed_is_completed_by_its_retry(spark, layout, monkeypatch, broken):
    jobs.apply_batch(log_of(spark, event("c", 1), event("c", 2, 30), event("c", 3, 60)), 0, layout)
    second = log_of(spark, event("u", 1, 90), event("d", 2), event("u", 3, 60, "99.00"), start=10)

    def fail(name, *args, **kwargs):
        if broken != "overwrite_parts" or name == layout.silver:
            raise RuntimeError("lost")
        return whole(name, *args, **kwargs)

    whole = tables.overwrite_parts
    with monkeypatch.context() as patch:
        patch.setattr(jobs if broken == "_rewrite_parts" else tables, broken, fail)
        with pytest.raises(RuntimeError, match="lost"):
            jobs.apply_batch(second, 1, layout)
    for _ in range(2):
        jobs.apply_batch(second, 1, layout)
    got = {(r.payment_id, r.created_at.day, str(r.amount)) for r in layout.read_silver(spark).collect()}
    assert got == {(1, 4, "10.00"), (3, 3, "99.00")}
    jobs.run_gold(spark, layout)
    full = metrics.hourly_metrics(layout.read_silver(spark)).select(*schemas.GOLD.names)
    assert bag(layout.read_gold(spark)) == bag(full)


def test_dead_letters_of_other_runs_are_kept(spark, tmp_path):
    letters = changes.dead_letters(spark.createDataFrame([("junk",)], "kafka_value STRING"), 0)
    for run in ("a", "b", "b"):
        write_dead_letters(letters, str(tmp_path), run, 0)
    assert read_dead_letters(spark, str(tmp_path)).count() == 2


def test_one_row_rewrites_one_partition_and_the_last_one_empties_it(spark, layout):
    day = 24
    jobs.apply_batch(log_of(spark, *[event("c", k, day * (k % 12)) for k in range(48)]), 0, layout)
    before = files(spark, layout.silver)
    assert len(folders(before)) > 12
    jobs.apply_batch(log_of(spark, event("u", 5, day * 5, "77.00")), 1, layout)
    after = files(spark, layout.silver)
    assert len(folders(before ^ after)) == 1
    # a payment that moves to a day of its own takes one partition along, and leaves one
    jobs.apply_batch(log_of(spark, event("u", 5, day * 40)), 2, layout)
    moved = files(spark, layout.silver)
    assert len(folders(after ^ moved)) == 2
    # its delete leaves an empty day
    jobs.apply_batch(log_of(spark, event("d", 5)), 3, layout)
    left = files(spark, layout.silver)
    assert len(moved - left) == 1 and not left - moved
    shown = {r.partition.split("/")[0] for r in spark.sql(f"SHOW PARTITIONS {layout.silver}").collect()}
    assert "_day=2024-02-10" not in shown and layout.read_silver(spark).count() == 47


@pytest.mark.parametrize("mode", [changes.REFERENCE, changes.ORDERED])
def test_replay_changes_nothing(spark, layout, mode):
    log = sample.raw_log(spark, SMALL)
    assert jobs.apply_batch(log, 0, layout, mode) > 0
    before = files(spark, layout.silver)
    assert jobs.apply_batch(log, 0, layout, mode) == 0
    if mode == changes.ORDERED:  # known outcomes touch nothing even under another batch number
        assert jobs.apply_batch(log, 1, layout, mode) == 0
    assert files(spark, layout.silver) == before


def test_gold_by_retraction_over_random_batches(spark, layout):
    rng = random.Random(4)
    for number in range(10):
        events = []
        for key in rng.sample(range(30), 8):
            if rng.random() < 0.3:
                events.append(event("d", key))
            else:
                events.append(event("u", key, rng.randrange(60), f"{rng.randrange(1, 900)}.25", rng.choice(["authorized", "failed"])))
        jobs.apply_batch(log_of(spark, *events), number, layout)
        if number in (2, 3, 9):
            jobs.run_gold(spark, layout)
            full = metrics.hourly_metrics(layout.read_silver(spark)).select(*schemas.GOLD.names)
            assert bag(layout.read_gold(spark)) == bag(full)
    # silver is not scanned: gold follows even where it is gone
    want = bag(layout.read_gold(spark))
    spark.sql(f"TRUNCATE TABLE {layout.silver}")
    spark.sql(f"TRUNCATE TABLE {layout.cells}")
    fresh = jobs.Layout(layout.root, f"{layout.checkpoints}-new", layout.buckets)
    jobs.run_gold(spark, fresh)
    assert bag(layout.read_gold(spark)) == want
    # cells of a lost checkpoint are not added to a second time
    jobs.run_gold(spark, jobs.Layout(layout.root, f"{layout.checkpoints}-newer", layout.buckets))
    assert bag(layout.read_gold(spark)) == want


def test_a_retried_gold_step_counts_once(spark, layout):
    jobs.apply_batch(log_of(spark, event("c", 1), event("c", 2, 30), event("c", 3, 31)), 0, layout)
    images = spark.table(layout.change_log)
    # the first attempt got as far as one of the two days
    jobs.apply_deltas(images.where("payment_id = 1"), 7, layout)
    jobs.apply_deltas(images, 7, layout)
    assert [(r.payment_hour.day, r.payment_count) for r in layout.read_gold(spark).orderBy("payment_hour").collect()] == [(1, 1), (2, 1), (2, 1)]
    jobs.apply_deltas(images, 7, layout)
    assert layout.read_gold(spark).agg(F.sum("payment_count")).first()[0] == 3
    # taken out again, the cell is no longer shown
    gone = images.select("payment_id", F.col("after").alias("before"), F.lit(None).cast(images.schema["after"].dataType).alias("after"))
    jobs.apply_deltas(gone, 8, layout)
    assert layout.read_gold(spark).count() == 0 and spark.table(layout.cells).count() == 3


def test_cells_without_amounts_or_hours(spark):
    row = "struct<created_at:timestamp,amount:decimal(12,2),country_code:string,payment_method:string,payment_status:string>"
    rows = [(None, (None, None, "NL", "card", "authorized")), ((None, None, "NL", "card", "failed"), None), (None, (None, 5, "NL", None, None)), (None, None)]
    images = spark.createDataFrame([], f"before {row}, after {row}")
    images = spark.createDataFrame([(b and (b[0], b[1] and Decimal(b[1]), *b[2:]), a and (a[0], a[1] and Decimal(a[1]), *a[2:])) for b, a in rows], images.schema)
    cells = metrics.add_cells(metrics.hourly_cells(images.select("after.*").where("false")), metrics.hourly_cells(metrics.signed_payments(images)))
    got = {tuple(r) for r in metrics.gold_of_cells(cells).collect()}
    assert got == {(None, "NL", None, 1, Decimal("5.00"), 0.0)}


def scans(df):
    """Rows that each file scan of ``df`` gave out of the row groups it read, and its files."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().execute().count()

    def walk(plan):
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            yield from walk(plan.executedPlan())
        elif kind.endswith("QueryStageExec"):
            yield from walk(plan.plan())
        else:
            if kind == "FileSourceScanExec":
                yield tuple(plan.metrics().apply(m).value() for m in ("numOutputRows", "numFiles"))
            for i in range(plan.children().size()):
                yield from walk(plan.children().apply(i))

    return list(walk(execution.executedPlan()))


def test_distant_keys_are_looked_up_in_few_row_groups(spark, layout):
    parts, rows = 150, 30_000
    name = layout.table("wide")
    spark.sql(f"CREATE DATABASE {layout.namespace} LOCATION '{layout.folder}'")
    schema = schemas.struct(payment_id=schemas.LONG, v=schemas.TEXT, _day=schemas.T.DateType())
    spark.sql(tables.create_statement(name, schema, ["_day"], lookups=["payment_id"]))
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int"))
    made = spark.range(rows).select(F.col("id").alias("payment_id"), F.lit("v").alias("v"), day.alias("_day"))
    tables.overwrite_parts(name, made, ["payment_id"])
    keys = spark.createDataFrame([(0,), (rows - 1,), (rows * 5,)], "payment_id LONG")
    with tables.lookups(spark):
        found = tables.with_keys(spark.table(name), keys, "payment_id").select("payment_id", "_day")
        (read, _), = scans(found)
        assert found.count() == 2
    assert read < 0.05 * rows
    # many keys go by their range, to the same result
    many = spark.range(tables.MAX_LOOKUPS + 50).select(F.col("id").alias("payment_id"))
    assert tables.with_keys(spark.table(name), many, "payment_id").count() == tables.MAX_LOOKUPS + 50


def test_parts_prune_the_scan_at_run_time(spark, layout):
    jobs.apply_batch(log_of(spark, *[event("c", k, 24 * k) for k in range(20)]), 0, layout)
    hours = spark.createDataFrame([(datetime(2024, 1, 3),), (datetime(2024, 1, 9),)], "payment_hour timestamp")
    days = hours.select(tables.day_of("payment_hour").alias("_day")).distinct()
    rows = tables.in_parts(spark.table(layout.silver), days)
    (_, read), = [s for s in scans(rows) if s[1]]
    assert read == 2 and rows.count() == 2
    assert "dynamicpruning" in rows._jdf.queryExecution().executedPlan().toString()


def test_columns_with_defaults(spark, layout):
    layout.ensure(spark)
    columns = ", ".join(c for c in COLUMNS)
    spark.sql(f"INSERT INTO {layout.silver} ({columns}, _day, _bucket) SELECT 1, 2, 3.00, 'EUR', 'card', 'failed', 'NL', current_timestamp(), current_timestamp(), current_date(), 0")
    row = spark.table(layout.silver).first()
    assert row.ingested_at is not None and row.amount == 3
    assert "DEFAULT" not in tables.create_statement("a.b", schemas.GOLD)


def test_gold_covers_the_day_of_rows_without_a_time(spark, layout):
    jobs.apply_batch(log_of(spark, event("c", 1)), 0, layout)
    images = spark.table(layout.change_log).withColumn("after", F.col("after").withField("created_at", F.lit(None).cast("timestamp")))
    jobs.apply_deltas(images, 0, layout)
    assert [(r.payment_hour, r.payment_count) for r in layout.read_gold(spark).collect()] == [(None, 1)]


def test_bounded_batches(spark, tmp_path, layout):
    folder = str(tmp_path / "records")
    records = sample.record_log(spark, SMALL)
    for parity in (0, 1):
        records.where(F.col("offset") % 2 == parity).coalesce(1).write.mode("append").parquet(folder)
        jobs.run_bronze(file_records(spark, folder), layout)
    jobs.run_layers(file_records(spark, folder), layout, changes.ORDERED, max_files_per_trigger=20)
    assert spark.table(layout.batches).count() > 1
    live = layout.read_silver(spark, changes.ORDERED).select(*COLUMNS)
    assert bag(live) == bag(layers.silver_state(sample.raw_log(spark, SMALL), changes.ORDERED))


def test_redelivered_records_are_taken_once(spark, tmp_path, layout):
    folder = str(tmp_path / "records")
    records = sample.record_log(spark, SMALL).where(F.col("offset") % 4 == 0)
    odd = records.limit(3).withColumn("timestamp", F.lit(datetime(1999, 1, 1)).cast("timestamp"))
    total = records.count()
    # twice in one run, again after a restart, then with records that are years late and of a restarted topic
    for part in (records.unionByName(records), records, odd):
        part.coalesce(1).write.mode("append").parquet(folder)
        done = jobs.run_bronze(file_records(spark, folder), layout, redelivered_within="1 day")
    assert spark.read.parquet(layout.bronze).count() == total + 3
    assert done.lastProgress["stateOperators"][0]["numRowsTotal"] == total + 3


def test_what_was_seen_is_forgotten_behind_the_watermark(spark, tmp_path, layout):
    folder = str(tmp_path / "records")
    records = sample.record_log(spark, SMALL).where(F.col("offset") % 4 == 0)
    held = []
    for k in range(3):
        part = records.withColumn("offset", F.col("offset") + F.lit(k).cast("long") * 10_000_000_000)
        part.coalesce(1).write.mode("append").parquet(folder)
        done = jobs.run_bronze(file_records(spark, folder), layout, redelivered_within="1 second")
        held.append(done.lastProgress["stateOperators"][0]["numRowsTotal"])
        time.sleep(1.5)
    assert max(held) <= records.count() and spark.read.parquet(layout.bronze).count() == 3 * records.count()


def test_dead_letters_before_the_first_batch_and_of_empty_ones(spark, tmp_path):
    assert read_dead_letters(spark, str(tmp_path / "none")).count() == 0
    none = changes.dead_letters(spark.createDataFrame([], "kafka_value STRING"), 0)
    write_dead_letters(none, str(tmp_path), "a", 0)
    assert not list(tmp_path.glob("_day=*")) and read_dead_letters(spark, str(tmp_path)).count() == 0
    one = changes.dead_letters(spark.createDataFrame([("junk",)], "kafka_value STRING"), 0)
    write_dead_letters(one, str(tmp_path), "a", 0)
    assert len(list(tmp_path.glob("_day=*"))) == 1
    # the retry of a batch on a later day leaves nothing behind on the first
    later = one.withColumn("ingested_at", F.lit(datetime(2040, 1, 1)).cast("timestamp"))
    write_dead_letters(later, str(tmp_path), "a", 0)
    assert [r.ingested_at.year for r in read_dead_letters(spark, str(tmp_path)).collect()] == [2040]


def test_last_values_follow_the_stream(spark, tmp_path, layout):
    folder, table = str(tmp_path / "samples"), layout.table("last")
    schema = "host string, at timestamp, n long, up double"
    drops = [
        [("a", 10, 1, 1.0), ("b", 10, 2, 5.0), (None, 3, 3, 7.0)],
        [("a", 9, 4, 2.0), ("b", 11, 5, None), ("c", 1, 6, 0.0)],  # late, without a value, new
        [("a", 10, 7, 3.0), (None, 2, 8, 9.0)],  # the same moment, later in the log
    ]
    seen = []
    for drop in drops:
        rows = [(h, datetime.fromtimestamp(1_704_067_200 + s), n, v) for h, s, n, v in drop]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        samples = stream_table(spark, folder, spark.read.parquet(folder).schema)
        jobs.run_last_values(samples, layout, "last", ["host"], "up", ["at", "n"])  # each run is a restart
        whole = series.last_value(spark.read.parquet(folder), ["host"], "up", ["at", "n"])
        assert bag(spark.table(table).select("host", "up")) == bag(whole)
        seen.append(files(spark, table))
    assert seen[0] != seen[1]
    jobs.run_last_values(samples, layout, "last", ["host"], "up", ["at", "n"])
    assert files(spark, table) == seen[2]


def test_a_batch_of_last_values_opens_its_parts_only(spark, tmp_path):
    layout = jobs.Layout(str(tmp_path / "tables"), str(tmp_path / "progress"), buckets=16)
    folder, table = str(tmp_path / "samples"), layout.table("last")
    for rows in (spark.range(400).selectExpr("id", "1 AS n", "id * 1.0D AS up"), spark.range(1).selectExpr("id", "2 AS n", "9.0D AS up")):
        rows.coalesce(1).write.mode("append").parquet(folder)
        before = files(spark, table) if spark.catalog.tableExists(table) else set()
        jobs.run_last_values(stream_table(spark, folder, rows.schema), layout, "last", ["id"], "up", ["n"])
    after = files(spark, table)
    assert len(folders(before - after)) == 1 and len(before & after) >= 15
    assert spark.table(table).agg(F.sum("up")).first()[0] == sum(range(400)) + 9.0
    spark.sql(f"DROP DATABASE {layout.namespace} CASCADE")


@pytest.mark.parametrize("spread", [1, 4])
def test_orphans_are_told_when_no_parent_can_come(spark, tmp_path, layout, spread):
    minute = lambda m: datetime.fromtimestamp(1_704_067_200 + 60 * m)
    kids, dads = str(tmp_path / "kids"), str(tmp_path / "dads")

    def told(children, parents):
        spark.createDataFrame([(k, p, minute(m)) for k, p, m in children], "kid long, pid long, born timestamp").write.mode("append").parquet(kids)
        spark.createDataFrame([(p, minute(m)) for p, m in parents], "pid long, came timestamp").write.mode("append").parquet(dads)
        held = quality.orphans_in_motion(
            stream_table(spark, kids, spark.read.parquet(kids).schema), stream_table(spark, dads, spark.read.parquet(dads).schema),
            "pid", "pid", "born", "came", wait="30 minutes", reach="1 day", late="10 minutes", spread=spread,
        )
        path = jobs.run_orphans(held, layout, "orphans")
        return sorted(r.kid for r in spark.read.schema("kid long").parquet(path).collect())

    # 1: parent before; 2: inside the wait, a drop later; 3: after the wait; 4: never; 5: names nobody; 10..: many of one parent
    many = [(k, 7, 0) for k in range(10, 40)]
    assert told([(1, 1, 0), (2, 2, 0), (3, 3, 0), (4, 4, 0), (5, None, 0), *many], [(1, -60), (7, -1)]) == []
    assert told([(6, 1, 20)], [(2, 29), (9, 20)]) == []
    assert told([(7, 7, 45)], [(3, 31), (9, 45)]) == [3, 4]
    # 8 comes later than the watermark allows and is dropped; a parent older than ``reach`` is none
    assert told([(8, 4, -1000), (9, 1, 1500)], [(9, 1500)]) == [3, 4]
    assert told([(50, 9, 3000)], [(9, 3000)]) == [3, 4, 9]
