"""Headline queries, timed. Prints one JSON line.

BENCH_SF_DIR   test-table folder (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame

from tidemark.checks.queries import QUERIES
from tidemark.session import build_session, clear_scratch
from tidemark.sources import sample

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = (
    "q_bronze_mask", "q_op_routing", "q_dlq",
    "q_silver_typed", "q_silver_latest", "q_silver_latest_maxby",
    "q_silver_state_reference", "q_silver_state_ordered", "q_silver_two_batches",
    "q_dq_metrics", "q_dup_keys", "q_fk_orphans", "q_payload_drift",
    "q_affected_hours", "q_gold_hourly", "q_gold_incremental", "q_rollup_country_method",
    "q_volume_by_hour", "q_method_share", "q_merge_upsert", "q_insert_if_absent",
    "q_change_feed", "q_last_value", "q_counter_rate", "q_stream_gold",
)


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(make) -> float:
    start = time.perf_counter()
    run(make())
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = build_session(
        "tidemark-bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory="12g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    start = time.perf_counter()
    sample.raw_log(spark, SF_DIR)
    setup = round(time.perf_counter() - start, 3)

    plans = {name: (lambda q=QUERIES[name]: q(spark, SF_DIR)) for name in HEADLINE}
    first = {name: timed(make) for name, make in plans.items()}
    warm = {name: timed(make) for name, make in plans.items()}
    result = {
        "metric": "headline_queries_warm_total",
        "value": round(sum(warm[name] for name in HEADLINE), 3),
        "unit": "sec",
        "queries": warm,
        "first_run": first,
        "setup_sec": setup,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS),
    }
    print(json.dumps(result))
    clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
