"""Time-series reductions: last value, sum of last values, counter rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import settle


def last_value(samples: DataFrame, series: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """Newest non-NULL value of each series."""
    newest = F.max_by(value, F.struct(*order)).alias(value)
    return samples.where(F.col(value).isNotNull()).groupBy(*series).agg(newest)


def sum_latest(samples: DataFrame, series: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    return last_value(samples, series, value, order).agg(F.sum(value).alias("total"))


def with_previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str, rows_per_slice: int = 2_000_000
) -> DataFrame:
    """Add ``name``: ``value`` of the row before, by ``order`` within ``keys``.

    A plain ``lag`` would put every row of a key into one task. Here rows are range-split
    by key and order, so a long series spans many slices; ``lag`` runs inside a slice, and
    the last row of each slice is repeated at the head of the key's next one. Those
    repeated rows number at most one per slice and key. Slices are cut to
    ``rows_per_slice`` rows of the whole input, so a slice keeps its size as the input grows.
    The split is written out once, because two evaluations of a sampled range split need not agree.
    """
    slices = max(1, -(-df.count() // rows_per_slice))
    ranged = df.repartitionByRange(slices, *keys, *order).withColumn("_slice", F.spark_partition_id())
    sliced = settle(ranged, "slices")

    tail = F.max_by(F.struct(*order, value), F.struct(*order)).alias("_tail")
    tails = sliced.groupBy("_slice", *keys).agg(tail)
    following = F.lead("_slice").over(Window.partitionBy(*keys).orderBy("_slice"))
    heads = (
        tails.withColumn("_slice", following)
        .where(F.col("_slice").isNotNull())
        .select("_slice", *keys, "_tail.*", F.lit(True).alias("_repeated"))
    )
    rows = sliced.withColumn("_repeated", F.lit(False)).unionByName(heads, allowMissingColumns=True)
    inside = Window.partitionBy("_slice", *keys).orderBy(*[F.col(c) for c in order], F.desc("_repeated"))
    return (
        rows.withColumn(name, F.lag(value).over(inside))
        .where(~F.col("_repeated"))
        .drop("_slice", "_repeated")
    )


def counter_segments(
    samples: DataFrame,
    series: Sequence[str],
    ts: str,
    value: str,
    by: Sequence[str] = (),
    order: Sequence[str] = (),
    seconds: int = 60,
) -> DataFrame:
    """What each time slice of a series adds to a counter: ``(series, by, slice, first, last, inner)``.

    ``first`` and ``last`` are the outermost samples as ``(ts, order, value)``, ``inner`` the increase between
    neighbours inside the slice (NULL if there are none). Segments of one series follow
    each other by ``first`` and merge: the increases add up, plus the one from ``last`` to the next
    ``first``. Samples meet by series and slice, so a series however long lies in many tasks.
    """
    needed = list(dict.fromkeys([*series, *by, ts, *order, value]))
    sliced = F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / seconds).alias("_slice")
    known = samples.select(*needed, sliced).where(F.col(value).isNotNull())
    before = F.lag(value).over(Window.partitionBy(*series, "_slice").orderBy(ts, *order))
    sample = F.struct(ts, *order, F.col(value).alias("_value"))
    groups = list(dict.fromkeys([*series, *by]))
    return known.withColumn("_inner", increase(before, F.col(value))).groupBy(*groups, "_slice").agg(
        F.min(sample).alias("_first"), F.max(sample).alias("_last"), F.sum("_inner").alias("_inner")
    )


def increase(before: Column, now: Column) -> Column:
    """What a counter went up by. A lower value means that it started again from zero."""
    return F.when(now >= before, now - before).when(now < before, now)


def bridged(segments: DataFrame, series: Sequence[str]) -> DataFrame:
    """Segments with ``_bridge``: the increase from the last sample of earlier slices to their first one.

    Only segments meet by series. Of several segments of one slice (they differ in labels) the
    earliest has the bridge; what lies between the others is inside the slice already.
    """
    in_time = Window.partitionBy(*series).orderBy("_slice", "_first")
    earlier = F.max("_last").over(in_time.rowsBetween(Window.unboundedPreceding, -1))
    opens = ~F.lag("_slice").over(in_time).eqNullSafe(F.col("_slice"))
    step = increase(earlier["_value"], F.col("_first._value"))
    return segments.withColumn("_bridge", F.when(opens, step))


def counter_rate(
    samples: DataFrame,
    series: Sequence[str],
    ts: str,
    value: str,
    by: Sequence[str] = (),
    order: Sequence[str] = (),
    minutes: int = 5,
    slice_seconds: int = 60,
) -> DataFrame:
    """Per-second increase of a counter, summed over series, by window and ``by`` labels.

    A value below the one before means the counter restarted from zero. The first sample
    of a series has nothing to compare with and adds nothing. A NULL sample is no sample: the
    next one is compared with the last that has a value.

    One pass over the samples: they become segments of ``slice_seconds``, which must divide the
    window, and only segments meet to be put in a row.
    """
    if minutes * 60 % slice_seconds:
        raise ValueError(f"{slice_seconds} seconds do not divide {minutes} minutes")
    segments = bridged(counter_segments(samples, series, ts, value, by, order, slice_seconds), series)
    per_window = minutes * 60 // slice_seconds
    start = F.timestamp_seconds(F.floor(F.col("_slice") / per_window) * (minutes * 60)).alias("window_start")
    parts = F.array("_inner", "_bridge")
    added = segments.select(*by, start, F.explode(parts).alias("_step")).where(F.col("_step").isNotNull())
    rate = (F.sum("_step").cast("double") / (minutes * 60)).alias("rate")
    return added.groupBy(*by, "window_start").agg(rate)
