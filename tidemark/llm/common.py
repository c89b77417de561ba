"""What several operators of this subpackage share: stored tables, components, unit blocks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import settle as stored

ROWS_PER_TASK = 100_000
__all__ = ["Forest", "components", "free", "in_parts", "small_enough", "stored", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free(df: DataFrame, *names: str) -> list[str]:
    """``names``, each lengthened until no column of ``df`` has it."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def small_enough(df: DataFrame, max_rows: int) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows; reads no more than it must to know."""
    return df.limit(max_rows + 1).count() <= max_rows


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)`` as ``(node, root)``; root is the smallest node.

    Union-find as alternating star contraction: a large step hangs every larger neighbour on
    the smallest node known, a small step does the same for the smaller ones. Every step is
    a minimum per node (with a partial step before the shuffle) and an equi-join, which
    adaptive execution splits where a hub is hot. Rounds grow with the logarithm of the
    longest path. The driver sees one row of counters per round. Loops and NULL ends are
    ignored; nodes without an edge do not occur.
    """
    start = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    current, seen = stored(start.distinct(), "edges"), None
    while True:
        print_of = current.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        # tasks follow the number of edges, which a round at most doubles
        tasks = -(-print_of[0] // ROWS_PER_TASK) or 1
        current = current.coalesce(tasks)
        if print_of == seen or print_of[0] == 0:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                current.select("v", "v").distinct()
            )
        seen = print_of
        both = current.union(current.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("low").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("low"))
        ends = F.explode(F.array("u", "v")).alias("u")
        small = large.join(least, "u").select(ends, F.col("low").alias("v"))
        current = stored(small.where(F.col("u") != F.col("v")).distinct().coalesce(2 * tasks), "edges")


class Forest:
    """Labels of the rows of one bounded block; merging keeps the smallest."""

    def __init__(self, size: int):
        self.label = np.arange(size)

    def merge(self, members: np.ndarray) -> None:
        """Put all of ``members`` (row numbers) into one tree."""
        found = self.label[members]
        low = found.min()
        rest = np.unique(found[found != low])
        if len(rest) == 1:
            self.label[self.label == rest[0]] = low
        elif len(rest):
            self.label[np.isin(self.label, rest)] = low

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        """Put the trees of ``a[k]`` and ``b[k]`` together, for all k at once."""
        while len(a):
            low, high = np.minimum(self.label[a], self.label[b]), np.maximum(self.label[a], self.label[b])
            apart = low < high
            a, b = a[apart], b[apart]
            np.minimum.at(self.label, high[apart], low[apart])
            while (self.label != (above := self.label[self.label])).any():
                self.label = above


def in_parts(keys: list[str], rows: int, size: int = 20_000) -> Column:
    """A group number that deals whole units (by ``keys``) to groups of about ``size`` rows."""
    return F.pmod(F.xxhash64(*keys), F.lit(max(1, -(-rows // size))))
