"""Change capture between two snapshots of a keyed table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import settle


def _columns_of_both(old: DataFrame, new: DataFrame) -> list[tuple[str, T.DataType]]:
    """Columns of either side, the old ones first; a column whose type differs is an error."""
    kinds = {f.name: f.dataType for f in old.schema.fields}
    for field in new.schema.fields:
        if kinds.setdefault(field.name, field.dataType) != field.dataType:
            raise ValueError(f"column {field.name} is {kinds[field.name].simpleString()} and {field.dataType.simpleString()}")
    return list(kinds.items())


def change_feed(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows ``(key, op, before, after)`` that turn ``old`` into ``new``; equal rows are left out.

    A column that one side lacks is NULL there, so an added or removed column shows as a change
    wherever it holds a value. Both sides meet in one grouping by key, which also finds a key
    that repeats on a side: an error. A row without a key is not the same as any other: it is
    a delete if old, a create if new.
    """
    columns = _columns_of_both(old, new)

    def image(df: DataFrame) -> Column:
        return F.struct(*[(F.col(n) if n in df.columns else F.lit(None).cast(t)).alias(n) for n, t in columns])

    kind = T.StructType([T.StructField(n, t) for n, t in columns])
    nothing = F.lit(None).cast(kind)
    left = old.select(F.col(key), image(old).alias("before"), nothing.alias("after"))
    right = new.select(F.col(key), nothing.alias("before"), image(new).alias("after"))
    both = left.unionByName(right)
    met = both.where(F.col(key).isNotNull()).groupBy(key).agg(
        *[F.any_value(side, ignoreNulls=True).alias(side) for side in ("before", "after")],
        F.greatest(F.count("before"), F.count("after")).alias("_times"),
    )
    repeated = F.raise_error(F.concat(F.lit(f"a side repeats {key} = "), F.col(key).cast("string"))).cast("string")
    op = (
        F.when(F.col("_times") > 1, repeated)
        .when(F.col("before").isNull(), "c")
        .when(F.col("after").isNull(), "d")
        .when(~F.col("before").eqNullSafe(F.col("after")), "u")
    )
    paired = met.select(key, op.alias("op"), "before", "after").where(F.col("op").isNotNull())
    alone = F.when(F.col("before").isNull(), "c").otherwise("d")
    return paired.unionByName(both.where(F.col(key).isNull()).select(key, alone.alias("op"), "before", "after"))


def _bucket(df: DataFrame, key: str, rows: int, buckets: int) -> Column:
    """Ranges of whole numbers, which lie together in a table that lies by key; hashes of other keys."""
    if isinstance(df.schema[key].dataType, T.IntegralType):
        return F.floor(F.col(key) / rows).alias("_bucket")
    return F.pmod(F.xxhash64(key), F.lit(buckets)).alias("_bucket")


def differing_buckets(old: DataFrame, new: DataFrame, key: str, rows: int, buckets: int) -> DataFrame:
    """``(_bucket)``: the buckets of keys whose rows differ, told by digests.

    A bucket's digest is the sum of 128 bits of hash of each of its rows, old ones added and new ones taken away; it
    and the number of rows are zero where both sides hold the same rows. The sums are formed before the shuffle.
    """
    columns = _columns_of_both(old, new)

    def hashed(df: DataFrame, sign: int) -> DataFrame:
        held = [F.col(n) if n in df.columns else F.lit(None).cast(t) for n, t in columns]
        blanks = [c.isNull() for c in held]  # a hash passes over NULL
        halves = []
        for seed in (1, 2):
            digest = F.xxhash64(F.lit(seed), *held, *blanks)
            halves += [F.shiftright(digest, 32) * sign, digest.bitwiseAND(F.lit(0xFFFFFFFF)) * sign]
        named = [h.alias(f"_d{k}") for k, h in enumerate([F.lit(sign).cast("long"), *halves])]
        return df.where(F.col(key).isNotNull()).select(_bucket(df, key, rows, buckets), *named)

    sums = [f"_d{k}" for k in range(5)]
    both = hashed(old, 1).unionByName(hashed(new, -1)).groupBy("_bucket").agg(*[F.sum(c).alias(c) for c in sums])
    return both.where(F.greatest(*[F.abs(c) for c in sums]) > 0).select("_bucket")


def sparse_change_feed(old: DataFrame, new: DataFrame, key: str, rows_per_bucket: int = 32) -> DataFrame:
    """``change_feed`` of two snapshots that are mostly alike: whole rows meet only where something differs.

    Keys are dealt into buckets of about ``rows_per_bucket`` rows, and only rows of buckets whose digests differ are
    compared. The list of these is stored, so its real size decides whether it is broadcast or joined by shuffle.
    Digests shrink before the shuffle as far as the keys of a bucket lie in one task: whole-number keys of a
    table laid out by key do. With few rows changed in every bucket this is a scan more than ``change_feed``.

    A key that both sides repeat with the same rows goes unnoticed, any other repeated key is an error.
    """
    buckets = max(1, old.count() // rows_per_bucket)
    differing = settle(differing_buckets(old, new, key, rows_per_bucket, buckets), "differing")

    def part(df: DataFrame) -> DataFrame:
        keyed = df.where(F.col(key).isNotNull()).select("*", _bucket(df, key, rows_per_bucket, buckets))
        met = keyed.join(differing, "_bucket", "left_semi").drop("_bucket")
        return met.unionByName(df.where(F.col(key).isNull()))

    return change_feed(part(old), part(new), key)


def snapshot_feed(table: DataFrame, key: str) -> DataFrame:
    """Every row of a first snapshot as a read event."""
    row = F.struct(*table.columns)
    return table.select(
        key, F.lit("r").alias("op"), F.lit(None).cast(table.schema).alias("before"), row.alias("after")
    )


def _as_logged(image: str, schema) -> Column:
    """An image with decimals as text and timestamps as microseconds."""
    fields = []
    for field in schema.fields:
        value, kind = F.col(f"{image}.{field.name}"), field.dataType.typeName()
        if kind == "decimal":
            value = value.cast("string")
        elif kind in ("timestamp", "timestamp_ntz"):
            value = F.unix_micros(value.cast("timestamp"))
        fields.append(value.alias(field.name))
    return F.when(F.col(image).isNotNull(), F.struct(*fields))


def to_envelopes(feed: DataFrame, key: str) -> DataFrame:
    """Feed rows as ``(key, value)`` JSON text."""
    before = _as_logged("before", feed.schema["before"].dataType).alias("before")
    after = _as_logged("after", feed.schema["after"].dataType).alias("after")
    value = F.to_json(F.struct(before, after, "op"), {"ignoreNullFields": "false"})
    return feed.select(F.to_json(F.struct(key)).alias("key"), value.alias("value"))
