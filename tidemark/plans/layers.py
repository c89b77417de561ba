"""Bronze, silver and gold as pure functions of a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.envelope import route_of
from tidemark.functions.masking import mask_rows, scan_schema
from tidemark.operators import changes, metrics


def stored_bronze(records: DataFrame) -> DataFrame:
    """Raw log rows with personal fields hashed and the route of each event beside them.

    Narrow, one parse per record; works on a stream or a table.
    """
    scan = F.from_json("kafka_value", scan_schema()).alias("_scan")
    scanned = changes.project_records(records).select("*", scan)
    masked = mask_rows(scanned, "kafka_value", F.col("_scan"))
    return masked.select(*schemas.BRONZE.names, route_of(F.col("_scan.op")).alias("_route"))


def bronze(records: DataFrame) -> DataFrame:
    """The six raw-log columns alone."""
    return stored_bronze(records).select(*schemas.BRONZE.names)


def silver_state(raw_log: DataFrame, mode: str = changes.REFERENCE, precision: str = "second") -> DataFrame:
    """Current payments after the whole of ``raw_log`` taken as one batch."""
    return live_after(changes.decode(raw_log, precision), mode)


def live_after(decoded: DataFrame, mode: str = changes.REFERENCE) -> DataFrame:
    """``silver_state`` of events that are decoded already."""
    resolved = changes.resolve(decoded, mode)
    return resolved.where(~F.col("_deleted")).select(*schemas.PAYMENT.names)


def gold(raw_log: DataFrame, mode: str = changes.REFERENCE) -> DataFrame:
    return metrics.hourly_metrics(silver_state(raw_log, mode))
