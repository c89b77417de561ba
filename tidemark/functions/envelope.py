"""Reading a change envelope (``op``, ``before``, ``after``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.fixed_values import DELETE_OP, KNOWN_OPS, REASON_NULL_OP, REASON_UNEXPECTED_OP


def parse_envelope(value: Column) -> Column:
    """The envelope as a struct of text fields, parsed in one pass over the JSON."""
    return F.from_json(value, schemas.ENVELOPE)


def route_of(op: Column) -> Column:
    """Where an event goes: ``upsert``, ``delete``, or the reason it is turned away."""
    return (
        F.when(op.isNull(), F.lit(REASON_NULL_OP))
        .when(~op.isin(*KNOWN_OPS), F.lit(REASON_UNEXPECTED_OP))
        .when(op == DELETE_OP, F.lit("delete"))
        .otherwise(F.lit("upsert"))
    )
