"""Hashing personal fields inside a JSON envelope without leaving the JVM.

Three ways, tried in this order per row:

1. *In place.* If every mention of each field in the text is accounted for by the parsed
   sections, the value tokens are swapped inside the text; all else stays byte for byte.
2. *By variant.* The payload is rebuilt from ``map<string, variant>``, so fields this code
   knows nothing about keep their types.
3. *From text.* A payload that VARIANT refuses (repeated keys) but the lenient parser reads
   is rebuilt with text values, because a later reader would find the personal field.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.fixed_values import ENVELOPE_SECTIONS, PII_FIELDS
from tidemark.schemas import struct

_TEXT_MAP = "map<string,string>"
_VARIANT_MAP = "map<string,variant>"


def _sql_list(names: Sequence[str]) -> str:
    quoted = (name.replace("\\", "\\\\").replace("'", "\\'") for name in names)
    return ", ".join(f"'{name}'" for name in quoted)


def _by_variant(value: str, fields: Sequence[str], sections: Sequence[str]) -> Column:
    hashed = f"""transform_values(CAST(part AS {_VARIANT_MAP}), (name, x) ->
        CASE WHEN name IN ({_sql_list(fields)}) AND NOT is_variant_null(x)
             THEN CAST(sha2(CAST(x AS STRING), 256) AS VARIANT) ELSE x END)"""
    return F.expr(
        f"""to_json(transform_values(from_json({value}, '{_VARIANT_MAP}'), (section, part) ->
        CASE WHEN section IN ({_sql_list(sections)}) AND startswith(schema_of_variant(part), 'OBJECT')
             THEN to_variant_object({hashed}) ELSE part END))"""
    )


def _by_text(value: str, fields: Sequence[str], sections: Sequence[str]) -> Column:
    """A section that occurs twice stays twice, hashed both times; of a key repeated within
    a section the last occurrence stays."""
    inner = f"from_json(part, '{_TEXT_MAP}')"
    last_of_each = f"""map_from_entries(transform(array_distinct(map_keys({inner})),
        n -> element_at(filter(map_entries({inner}), e -> e.key = n), -1)))"""
    hashed = f"""transform_values({last_of_each}, (name, x) ->
        CAST(CASE WHEN name IN ({_sql_list(fields)}) THEN sha2(x, 256) ELSE x END AS VARIANT))"""
    return F.expr(
        f"""to_json(transform_values(from_json({value}, '{_TEXT_MAP}'), (section, part) ->
        CASE WHEN section IN ({_sql_list(sections)}) AND {inner} IS NOT NULL
             THEN to_variant_object({hashed}) ELSE CAST(part AS VARIANT) END))"""
    )


def scan_schema(
    fields: Sequence[str] = PII_FIELDS, sections: Sequence[str] = ENVELOPE_SECTIONS
) -> T.StructType:
    """What masking needs to see of an envelope, plus ``op``."""
    text = T.StringType()
    section = struct(**{field: text for field in fields})
    return struct(op=text, **{name: section for name in sections})


#: Takes a step's name and expression, gives the expression to go on with.
Keep = Callable[[str, Column], Column]


def _in_line(name: str, step: Column) -> Column:
    return step


def _in_place(value: Column, scan: Column, field: str, sections: Sequence[str], keep: Keep = _in_line) -> tuple[Column, Column]:
    """Condition under which swapping value tokens in the text is exact, and the swap.

    Without backslashes a quoted name followed by a colon can only be a key. If there are
    as many such keys as sections holding a value, and as many swaps of that value were
    made, then every key belongs to its section: none is nested, repeated or elsewhere.
    Counts come from byte lengths, which is cheaper than matching a pattern.
    """
    name = f'"{field}"'
    held = [scan[section][field] for section in sections]
    secret = F.coalesce(*held)
    present = sum((h.isNotNull().cast("int") for h in held), F.lit(0))
    alike = F.lit(True) if len(held) == 1 else F.least(*held) == F.greatest(*held)

    quoted = F.concat(F.lit(name + ':"'), secret, F.lit('"'))
    bare = F.when(secret.rlike(r"^-?\d+$"), F.concat(F.lit(name + ":"), secret))
    token = keep("token", F.when(value.contains(quoted), quoted).otherwise(bare))
    masked = keep("masked", F.concat(F.lit(name + ':"'), F.sha2(secret, 256), F.lit('"')))
    swapped = keep("swapped", F.replace(value, token, masked))

    growth = F.octet_length(masked) - F.octet_length(token)
    unnamed = F.octet_length(F.replace(value, F.lit(name), F.lit("")))
    exact = (
        (F.octet_length(swapped) - F.octet_length(value) == growth * present)
        & (growth != 0)
        & (F.octet_length(value) - unnamed == present * len(name))
        & ~value.contains("\\")
        & alike
    )
    return exact, swapped


def mask_scanned(
    value: str,
    scan: Column,
    fields: Sequence[str] = PII_FIELDS,
    sections: Sequence[str] = ENVELOPE_SECTIONS,
    keep: Keep = _in_line,
) -> Column:
    """``mask_envelope`` for a row whose ``scan_schema`` view is at hand as a column."""
    text = F.col(value)
    mention = text.contains("\\u")
    for field in fields:
        mention = mention | text.contains(field)
    rebuilt = F.coalesce(_by_variant(value, fields, sections), _by_text(value, fields, sections), text)
    all_exact, masked = F.lit(True), text
    for field in fields:
        # a swap changes values only, so the counts of the next field still hold
        exact, swapped = _in_place(masked, scan, field, sections, keep)
        named = text.contains(field)
        all_exact = all_exact & (~named | exact)
        masked = F.when(named, swapped).otherwise(masked)
    in_place = mention & F.coalesce(all_exact & ~text.contains("\\"), F.lit(False))
    return F.when(in_place, masked).when(mention, rebuilt).otherwise(text)


def mask_rows(
    rows: DataFrame,
    value: str,
    scan: Column,
    fields: Sequence[str] = PII_FIELDS,
    sections: Sequence[str] = ENVELOPE_SECTIONS,
) -> DataFrame:
    """``rows`` with ``mask_scanned`` of ``value``. Digests and swaps are columns on the way, so each is made once."""
    steps: list[str] = []

    def keep(name: str, step: Column) -> Column:
        nonlocal rows
        steps.append(f"_{name}_{len(steps)}")
        rows = rows.withColumn(steps[-1], step)
        return F.col(steps[-1])

    masked = mask_scanned(value, scan, fields, sections, keep)
    return rows.withColumn(value, masked).drop(*steps)


def mask_envelope(
    value: str,
    fields: Sequence[str] = PII_FIELDS,
    sections: Sequence[str] = ENVELOPE_SECTIONS,
) -> Column:
    """Column ``value`` with each of ``fields`` replaced by its SHA-256 digest in each section.

    NULL and unreadable text pass through. Text that cannot name any of the fields
    (no literal mention, no ``\\u`` escape that could spell one) is not rebuilt at all.
    """
    return mask_scanned(value, F.from_json(value, scan_schema(fields, sections)), fields, sections)
