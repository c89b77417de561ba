"""Casts of untrusted text. Bad input gives NULL under ANSI mode instead of an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_long(c: Column) -> Column:
    """Whole number from text; a decimal fraction is cut off (``'12.7'`` gives 12)."""
    whole = F.regexp_extract(c, r"^\s*([+-]?\d+)\.\d*\s*$", 1)
    return F.coalesce(c.try_cast("bigint"), whole.try_cast("bigint"))


def to_decimal(c: Column, precision: int = 12, scale: int = 2) -> Column:
    return c.try_cast(f"decimal({precision},{scale})")


def micros_to_timestamp(c: Column, precision: str = "second") -> Column:
    """Timestamp from text holding microseconds since the epoch.

    ``precision="second"`` drops the fraction (rounding down, also before 1970);
    ``"micros"`` keeps it.
    """
    exact = F.timestamp_micros(c.try_cast("double").try_cast("bigint"))
    if precision == "micros":
        return exact
    if precision == "second":
        return F.date_trunc("second", exact)
    raise ValueError(f"unknown precision {precision!r}")
