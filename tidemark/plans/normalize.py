"""The ten-field payment record shape for rows that are still all text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import clean_token_per_space
from tidemark.functions.typing import to_decimal, to_long


def normalize_payments(raw: DataFrame) -> DataFrame:
    """Typed and cleaned record. Currency is upper-cased but not trimmed."""
    stripped_country = F.regexp_replace(F.col("country_code"), r"^\s+|\s+$", "")
    return raw.select(
        to_long(F.col("payment_id")).alias("payment_id"),
        to_long(F.col("merchant_id")).alias("merchant_id"),
        to_long(F.col("shopper_id")).alias("shopper_id"),
        to_decimal(F.col("amount")).alias("amount"),
        F.upper("currency").alias("currency"),
        clean_token_per_space(F.col("payment_method")).alias("payment_method"),
        clean_token_per_space(F.col("payment_status")).alias("payment_status"),
        F.upper(stripped_country).alias("country_code"),
        "created_at",
        "updated_at",
    )
