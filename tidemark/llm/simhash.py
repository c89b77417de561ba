"""SimHash near-duplicates, searched with BK-trees.

A fingerprint pair within the radius differs in at most ``radius`` bits, so of ``radius + 1``
or more blocks of the 64 bits some agree. Every choice of blocks that could be the agreeing
ones is one table, the agreeing bits are the key of a shard, and each shard has a BK-tree of its
fingerprints. Trees meet the queries of their shard by shuffle, never through the driver; a
large shard is dealt into bounded blocks and each pair of blocks is searched. Nothing is
dropped: the search finds every linked pair, whatever the size of a shard.

Rows: a NULL or blank text has fingerprint zero and links like any other. A NULL id keeps its
row; it takes part in links but can name no component. Repeated rows stay, in one component. An
empty table gives an empty result. Extra columns of ``docs`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Forest, components, free, in_parts, stored

SEED = 42
BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
EDGES = "a long, b long"


def fingerprint_of(text: str | None, words_per_shingle: int = 4) -> int:
    """64-bit SimHash over word shingles of the ASCII-lower-cased text, as a signed long."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= words_per_shingle:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], dtype=np.uint64)
    else:
        joined, digest = b" ".join(words), xxhash.xxh64_intdigest
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[:-1]))[: len(words) - words_per_shingle + 1].tolist()
        stops = (ends[words_per_shingle - 1 :] - 1).tolist()
        found = [digest(joined[s:e], SEED) for s, e in zip(starts, stops, strict=True)]
        hashes = np.array(found, dtype=np.uint64)
    octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(octets[:, k], minlength=256) @ BITS for k in range(8)])
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def _simhash():
    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(x) for x in texts], dtype="int64")

    return simhash


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp)`` of every row."""

    return docs.select(F.col(id_col).alias("doc_id"), _simhash()(F.col(text_col).cast("string")).alias("fp"))


def _masks(rows: int, radius: int, per_shard: int = 64) -> list[int]:
    """The bits that must agree, per table: the fewest tables that leave shards of ``per_shard``."""
    for blocks in range(radius + 1, 2 * radius + 1):
        if rows >> (64 * (blocks - radius) // blocks) <= per_shard:
            break
    cuts = [64 * k // blocks for k in range(blocks + 1)]
    block = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(block, blocks - radius)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


class BKTree:
    """Children of a node are keyed by their integer Hamming distance to it."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.children: list[dict[int, int]] = [{} for _ in values]
        plain = values.tolist()
        for new in range(1, len(plain)):
            node = 0
            while True:
                edge = ((plain[new] ^ plain[node]) & 0xFFFFFFFFFFFFFFFF).bit_count()
                below = self.children[node].get(edge)
                if below is None:
                    self.children[node][edge] = new
                    break
                node = below

    def walk(self, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """For each node: which of ``queries`` are within ``radius`` of it.

        All queries go down together; a query follows an edge only if the edge's distance is
        within ``radius`` of its own distance to the node, as the triangle inequality allows.
        """
        open_nodes = [(0, np.arange(len(queries)))]
        while open_nodes:
            node, here = open_nodes.pop()
            far = np.bitwise_count((queries[here] ^ self.values[node]).view(np.uint64))
            near = here[far <= radius]
            if len(near):
                yield node, near
            far = far.astype(np.int64)
            for edge, child in self.children[node].items():
                follow = here[np.abs(far - edge) <= radius]
                if len(follow):
                    open_nodes.append((child, follow))


def _links_of(shards: pd.DataFrame, radius: int) -> pd.DataFrame:
    """Spanning edges of the links inside each unit (a shard, or a pair of its blocks)."""
    out_a, out_b = [], []
    shards = shards.sort_values(["t", "key", "i", "j"], kind="stable")
    unit = shards.groupby(["t", "key", "i", "j"], sort=False).ngroup().to_numpy()
    fp = shards["fp"].to_numpy()
    cuts = np.flatnonzero(np.diff(unit)) + 1
    for values in np.split(fp, cuts):
        values = np.unique(values)
        if len(values) < 2:
            continue
        forest = Forest(len(values))
        for node, near in BKTree(values).walk(values, radius):
            if len(near) > 1:
                forest.merge(np.append(near, node))
        moved = np.flatnonzero(forest.label != np.arange(len(values)))
        out_a.append(values[moved])
        out_b.append(values[forest.label[moved]])
    if not out_a:
        return pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64")})
    return pd.DataFrame({"a": np.concatenate(out_a), "b": np.concatenate(out_b)})


def links(fps: DataFrame, radius: int = 4, block: int = 2048) -> DataFrame:
    """Edges ``(a, b)`` whose components are those of all pairs within ``radius`` bits.

    ``fps`` has distinct ``fp``. A unit of work is at most two blocks of about ``block`` rows.
    """
    rows = fps.count()
    masks = _masks(rows, radius)
    tables = F.explode(
        F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(_signed(m)).alias("key")) for t, m in enumerate(masks)])
    )
    keyed = fps.select("fp", tables.alias("_")).select("fp", "_.t", "_.key")
    large = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).where(F.col("n") > block)
    blocks = F.coalesce(F.ceil(F.col("n") / block), F.lit(1))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    dealt = (
        keyed.join(large, ["t", "key"], "left")
        .withColumn("blocks", blocks)
        .select("fp", "t", "key", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
        .select("fp", "t", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    )
    unit = ["t", "key", "i", "j"]
    parts = dealt.withColumn("part", in_parts(unit, rows * len(masks)))
    return parts.groupBy("part").applyInPandas(
        lambda shards: _links_of(shards, radius), schema=EDGES
    )


def components_of(prints: DataFrame, radius: int = 4) -> DataFrame:
    """``(fp, root)`` of every fingerprint of ``prints(fp)``; root is the component's smallest one."""
    distinct = stored(prints.select("fp").distinct(), "distinct")
    joined = components(links(distinct, radius)).withColumnRenamed("node", "fp")
    return distinct.join(joined, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(
    docs: DataFrame, radius: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, fp, component_id)`` per row; the component's id is its smallest doc_id."""
    prints = stored(fingerprints(docs, id_col, text_col), "fingerprints")
    lows = prints.groupBy("fp").agg(F.min("doc_id").alias("low"))
    rooted = stored(components_of(prints, radius).join(lows, "fp"), "roots")
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(lowest, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def representatives(docs: DataFrame, radius: int = 4) -> DataFrame:
    """The one row of ``docs`` that stays of each component: the smallest id, then text digest.

    A row without an id stays only where no row of its component has one. All columns are kept.
    """
    digest = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    narrow = docs.select("doc_id", "text", digest.alias("_digest"))
    prints = stored(narrow.select("doc_id", "_digest", _simhash()(F.col("text").cast("string")).alias("fp")), "fingerprints")
    rooted = prints.join(components_of(prints, radius), "fp")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_digest")).alias("first")
    root, its_id, its_digest = free(docs, "_root", "_id", "_print")
    stays = stored(rooted.groupBy("root").agg(first).select(
        F.col("root").alias(root), F.col("first.doc_id").alias(its_id), F.col("first._digest").alias(its_digest)
    ), "stays")
    kept = docs.join(stays, F.col("doc_id").eqNullSafe(F.col(its_id)) & (digest == F.col(its_digest)))
    rows = prints.join(stays, F.col("doc_id").eqNullSafe(F.col(its_id)) & (F.col("_digest") == F.col(its_digest)))
    if rows.count() > stays.count():  # some rows are repeated in full
        kept = kept.dropDuplicates([root])
    return kept.select(*[F.col(c) for c in docs.columns])


def as_hex(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))
