"""Row-level changes as joins over immutable DataFrames.

Keys are unique in a target. The complement of a semi-join is always ``left_anti``: NULL keys
in the target survive, as they do under ``IN``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _names(columns: str | Sequence[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def same_columns(left: DataFrame, right: DataFrame) -> None:
    """Raise unless both sides have the same columns; their order does not matter."""
    apart = set(left.columns) ^ set(right.columns)
    if apart:
        raise ValueError(f"columns of one side only: {sorted(apart)}")


def once_per_key(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The non-NULL keys of ``source``, each once; a key that repeats fails the job.

    The check rides on the shuffle by key and cannot be pruned: the key itself depends on it.
    """
    known = source.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("_times"))

    def guarded(name: str) -> Column:
        text = F.concat(F.lit(f"the source repeats {'/'.join(keys)} = "), F.concat_ws("/", *[F.col(k).cast("string") for k in keys]))
        repeats = F.raise_error(text).cast(source.schema[name].dataType)
        return F.when(F.col("_times") > 1, repeats).otherwise(F.col(name)).alias(name)

    return known.select(*[guarded(k) for k in keys])


def merge_upsert(target: DataFrame, source: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Matched rows replaced, unmatched rows added. A key that the source repeats is an error.

    A NULL key matches nothing: such rows of the source are added.
    """
    same_columns(target, source)
    keys = _names(key)
    return target.join(once_per_key(source, keys), keys, "left_anti").unionByName(source)


def delete_by_key(target: DataFrame, gone: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows whose key is not listed in ``gone`` (repeats and NULLs there are harmless)."""
    keys = _names(key)
    # repeats shrink to one row per map task, so a key deleted many times is no hot spot
    return target.join(gone.select(*keys).distinct(), keys, "left_anti")


def update_where(target: DataFrame, condition: Column, assignments: Mapping[str, Column]) -> DataFrame:
    """``UPDATE ... SET ... WHERE`` as one projection; an unknown condition leaves the row."""
    return target.withColumns(
        {
            name: F.when(condition, value).otherwise(F.col(name)).cast(target.schema[name].dataType)
            for name, value in assignments.items()
        }
    )


def insert_if_absent(
    target: DataFrame, new: DataFrame, key: str | Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Rows of ``new`` whose key ``target`` lacks are added.

    Of several new rows with one key the first by ``order`` (then by all columns) is kept. A key
    with a NULL in it equals no other: all such rows are added. They pass by the grouping, so
    however many there are they do not meet in one task.
    """
    same_columns(target, new)
    keys = _names(key)
    rest = [c for c in new.columns if c not in keys and c not in order]
    first = F.min(F.struct(*order, *rest)).alias("_first")
    whole = F.lit(True)
    for name in keys:
        whole = whole & F.col(name).isNotNull()
    once = new.where(whole).groupBy(*keys).agg(first).select(*keys, "_first.*")
    added = once.join(target.select(*keys).distinct(), keys, "left_anti")
    return target.unionByName(added).unionByName(new.where(~whole))


def replace_groups(
    target: DataFrame, groups: DataFrame, recomputed: DataFrame, by: str | Sequence[str]
) -> DataFrame:
    """``target`` with every row of the listed groups swapped for the recomputed rows."""
    keys = _names(by)
    return delete_by_key(target, groups, keys).unionByName(recomputed)
