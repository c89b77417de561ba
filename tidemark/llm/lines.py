r"""Fuzzy line deduplication by MinHash, one line kept of every component.

A line's shingles are the characters that begin at each of its places (``shingles``). Lines that
are equal are one class. A class has a MinHash signature: ``ROWS * BANDS`` minima of its shingles'
hashes, each under a permutation of its own. Classes that agree on all rows of a band
meet in a bucket. Classes of at most ``SHORT`` shingles meet also under the digest of their set and
of the set less each shingle: with at most 9 shingles in the larger set, a similarity of 0.8 leaves
only equal sets, one shingle more or one exchanged, so none of these pairs is left to chance.

In a bucket every class is compared with the one that has most copies; classes that hang together
after that need no more comparing, only those outside meet the rest, block by block. Two classes are
compared if their shingle counts allow the threshold and, where the counts are equal and too
small for any difference, if their sets have one digest: what fails this cannot be near. The exact
Jaccard similarity decides, and distributed union-find (``common.components``) makes components.
The first line of a component by (doc_id, text, place) stays, all others are taken out.

Lines are cut, grouped, joined and taken out by DataFrame expressions. Shingles are made in numpy on
Arrow batches, as the native form with a shingle at every character missed the check's limits.

Rows: a NULL text stays NULL; an empty or blank line is kept and never compared. Rows that repeat
both id and text are one document and get the same result; a NULL id is a value like others. An
empty table gives an empty result. A line of any length is compared whole, in pieces of bounded
memory but for its text and one hash per distinct shingle. Extra columns are carried along, whatever
their names; ``n_lines`` and ``n_removed`` of the input give way to those of the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import components, free, small_enough, stored
from tidemark.llm.quality import _slices
from tidemark.llm.shingles import constants, crossed, groups, minima, mixed, sets, similarities

SHORT = 10
ROWS, BANDS = 4, 9
MASKS, ODDS = constants(ROWS * BANDS, 2), constants(ROWS * BANDS, 3)
LINE = ["h1", "h2"]
BLOCK, BLOCK_BYTES = 64, 1 << 20
MAX_BROADCAST = 1_000_000


def _exploded(docs: DataFrame, *more: Column) -> DataFrame:
    """Lines that are not blank, with 128 bits of hash that stand for their text."""
    lines = docs.select("doc_id", *more, F.posexplode(F.split("text", "\n")).alias("place", "line"))
    return lines.where(F.col("line").rlike(r"\S")).withColumns(
        {"h1": F.xxhash64("line"), "h2": F.xxhash64(F.lit(7), F.col("line"))}
    )


SIGNED = "h1 long, h2 long, line string, copies long, n long, whole long, keys array<long>"


def _signatures(docs: DataFrame, threshold: float) -> DataFrame:
    """``(h1, h2, line, copies, n, whole, keys)``: per class its size, its set and the keys of its buckets."""
    classes = _exploded(docs).groupBy("line").agg(F.count("*").alias("copies"))
    hashed = classes.select(F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), F.col("line")).alias("h2"), "line", "copies")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, 2):
                texts = part.column(2).to_pylist()
                for a, b in groups(texts):
                    n, whole, keys = _signed(texts[a:b], threshold)
                    made = [pa.array(n), pa.array(whole), pa.array(keys, pa.list_(pa.int64()))]
                    names = [*part.schema.names, "n", "whole", "keys"]
                    yield pa.RecordBatch.from_arrays([*part.slice(a, b - a).columns, *made], names=names)

    return hashed.mapInArrow(run, SIGNED)


def _signed(texts: list[str], threshold: float) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Per line: the number of its shingles, a digest of their set, and its distinct keys.

    Keys are a digest of each band and, for at most ``SHORT`` shingles, the digest of the set, and
    that of the set less each shingle where one of so many may be missing.
    """
    hashes, starts = sets(texts)
    n = np.diff(starts)
    spread = mixed(hashes)  # sums of plain hashes would tell less
    whole = np.bitwise_xor.reduceat(spread, starts[:-1])
    found = minima(hashes, starts, MASKS, ODDS).reshape(len(texts), BANDS, ROWS)
    bands = np.zeros((len(texts), BANDS), np.uint64) + constants(BANDS, 4)
    for row in range(ROWS):
        bands = mixed(bands + found[:, :, row])
    keys: list[np.ndarray] = list(bands.view(np.int64))
    for k in np.flatnonzero(n <= SHORT):
        more = [whole[k : k + 1]]
        if n[k] - 1 >= n[k] * threshold:
            more.append(whole[k] ^ spread[starts[k] : starts[k + 1]])
        keys[k] = np.concatenate((keys[k], np.concatenate(more).view(np.int64)))
    return n.astype(np.int64), whole.view(np.int64), [np.unique(k) for k in keys]


def _may_be_near(a: Column, b: Column, threshold: float) -> Column:
    """What two classes must fulfil to reach the threshold, told from their sizes and digests.

    Sets of one size ``n`` that differ share at most ``n - 1`` of ``n + 1`` shingles.
    """
    n, m = a["n"], b["n"]
    sizes = F.least(n, m) >= F.greatest(n, m) * threshold
    told_apart = (n == m) & (n - 1 < (n + 1) * threshold)
    return sizes & (~told_apart | (a["whole"] == b["whole"]))


def _node(prefix: str = "") -> Column:
    return F.concat_ws("/", F.col(f"{prefix}h1"), F.col(f"{prefix}h2"))


def _near(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``(a, b)`` whose exact Jaccard similarity reaches the threshold."""
    left = texts.select(F.col("node").alias("a"), F.col("line").alias("la"))
    right = texts.select(F.col("node").alias("b"), F.col("line").alias("lb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for half in _slices(batch, 2):
                for part in _slices(half, 3):
                    near = similarities(part.column(2).to_pylist(), part.column(3).to_pylist()) >= threshold
                    yield part.select(["a", "b"]).filter(pa.array(near))

    met = pairs.join(left, "a").join(right, "b").select("a", "b", "la", "lb")
    return met.mapInArrow(run, "a string, b string")


def similar_lines(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``(node, root)`` of every class of equal lines that is near another one."""
    signed = stored(_signatures(docs, threshold), "signatures")
    keys = signed.select("h1", F.explode("keys").alias("key"))
    met = keys.withColumn("met", F.count("*").over(Window.partitionBy("key"))).where("met > 1").select("key", "h1")
    met = stored(met, "met")
    few = met.select("h1").distinct()
    if small_enough(few, MAX_BROADCAST):
        few = F.broadcast(few)
    # from here on only classes that share a bucket carry their text
    classes = signed.drop("keys").join(few, "h1", "left_semi").withColumn("node", _node())
    classes = stored(classes.select("h1", "node", "line", "n", "whole", "copies"), "texts")
    info = F.struct("node", "n", "whole", "copies").alias("x")
    members = stored(met.join(classes.select("h1", info), "h1").select("key", "x"), "buckets")
    texts = classes.select("node", "line")

    heads = members.groupBy("key").agg(F.max_by("x", F.struct("x.copies", "x.node")).alias("y"))
    stars = members.join(heads, "key").where("x.node <> y.node").where(_may_be_near(F.col("x"), F.col("y"), threshold))
    pairs = stars.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
    near = stored(_near(pairs.distinct(), texts, threshold), "near")
    joined = stored(components(near), "joined")

    # classes outside the component of their bucket's head meet everything outside their own component
    root = joined.select(F.col("node").alias("_node"), "root")
    rooted = members.join(root, F.col("x.node") == F.col("_node"), "left").select("key", "x", F.coalesce("root", "x.node").alias("root"))
    head = heads.join(root, F.col("y.node") == F.col("_node"), "left").select("key", F.coalesce("root", "y.node").alias("head"))
    rooted = stored(rooted.join(head, "key"), "rooted")
    more = stored(_near_in_blocks(rooted, texts, threshold), "more")
    if more.isEmpty():
        return joined
    return components(joined.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))


def _near_in_blocks(rooted: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """``(a, b)``: near pairs of a bucket's outside classes and its classes of other components.

    ``rooted(key, x, root, head)``. Both sides of a bucket are dealt to blocks of about ``BLOCK``
    classes and ``BLOCK_BYTES`` of text; a pair of blocks is one row and is compared inside it.
    """
    busy = rooted.join(rooted.where("root <> head").select("key").distinct(), "key")
    sets = texts.select(F.col("node").alias("_node"), "line")
    busy = busy.join(sets, F.col("x.node") == F.col("_node")).drop("_node")
    busy = stored(busy, "busy")
    room = F.greatest(F.count("*") / BLOCK, F.sum(F.octet_length("line")) / BLOCK_BYTES)
    sizes = busy.groupBy("key").agg(F.ceil(room).alias("blocks"))
    one = F.struct("root", "line", F.col("x.node").alias("node"), F.col("x.n").alias("n"), F.col("x.whole").alias("whole"))
    placed = busy.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("x.node"), F.col("blocks")))
    blocks = placed.groupBy("key", "block").agg(F.collect_list(one).alias("ones"))
    outside = placed.where("root <> head").groupBy("key", "block").agg(F.collect_list(one).alias("others"))
    met = blocks.select("key", "ones").join(outside.select("key", "others"), "key")
    may = F.exists("ones", lambda x: F.exists("others", lambda y: (x["root"] != y["root"]) & _may_be_near(x, y, threshold)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                found = _near_of_blocks(batch.column(0)[k].as_py(), batch.column(1)[k].as_py(), threshold)
                if found:
                    yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in found])

    return met.where(may).select("ones", "others").mapInArrow(run, "a string, b string").distinct()


def _near_of_blocks(ones: list[dict], others: list[dict], threshold: float) -> list[tuple[str, str]]:
    """Near pairs ``(larger, smaller)`` of two blocks; rows that can be near nothing are not hashed."""
    column = lambda rows, name: np.array([r[name] for r in rows])
    n, m = column(ones, "n")[:, None], column(others, "n")[None, :]
    equal = column(ones, "whole")[:, None] == column(others, "whole")[None, :]
    told_apart = (n == m) & (n - 1 < (n + 1) * threshold) & ~equal
    may = (np.minimum(n, m) >= np.maximum(n, m) * threshold) & ~told_apart
    may &= column(ones, "root")[:, None] != column(others, "root")[None, :]
    rows, columns = np.flatnonzero(may.any(1)), np.flatnonzero(may.any(0))
    if not len(rows):
        return []
    share = crossed([ones[k]["line"] for k in rows], [others[k]["line"] for k in columns])
    near = np.argwhere((share >= threshold) & may[np.ix_(rows, columns)])
    pairs = [(ones[rows[i]]["node"], others[columns[j]]["node"]) for i, j in near]
    return [(max(p), min(p)) for p in pairs]


def removed_lines(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``(doc_id, digest, gone)``: the places of the lines that each document loses."""
    digest = F.xxhash64("text").alias("digest")
    lines = stored(_exploded(docs, digest).select("doc_id", "digest", "place", *LINE), "lines")
    spot = F.struct("doc_id", "digest", "place")
    classes = lines.groupBy(*LINE).agg(F.min(spot).alias("first"), F.count("*").alias("n"))
    rooted = classes.withColumn("node", _node()).join(similar_lines(docs, threshold), "node", "left")
    rooted = stored(rooted.where("n > 1 OR root IS NOT NULL").select(*LINE, "first", F.coalesce("root", "node").alias("root")), "classes")
    stays = rooted.groupBy("root").agg(F.min("first").alias("stays"))
    judged = rooted.join(stays, "root").select(*LINE, "stays")
    gone = lines.join(judged, LINE).where(~spot.eqNullSafe(F.col("stays")))
    return gone.groupBy("doc_id", "digest").agg(F.collect_set("place").alias("gone"))


def deduplicated(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``, and ``n_lines``, ``n_removed``."""
    docs = docs.drop("n_lines", "n_removed")
    plain = docs.select("doc_id", F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull())
    gone = stored(removed_lines(plain, threshold), "removed")
    its_doc, its_digest, places = free(docs, "_doc", "_digest", "_gone")
    gone = gone.select(F.col("doc_id").alias(its_doc), F.col("digest").alias(its_digest), F.col("gone").alias(places))
    if small_enough(gone, MAX_BROADCAST // 2) and gone.agg(F.coalesce(F.sum(F.size(places)), F.lit(0))).first()[0] <= 4 * MAX_BROADCAST:
        gone = F.broadcast(gone)
    text = F.col("text").cast("string")
    same = F.col("doc_id").eqNullSafe(F.col(its_doc)) & (F.xxhash64(text) == F.col(its_digest))
    lines = F.split(text, "\n")
    left = F.array_join(F.filter(lines, lambda x, k: ~F.array_contains(places, k)), "\n")
    return (
        docs.join(gone, same, "left")
        .withColumns({
            "n_lines": F.when(text.isNotNull(), F.size(lines)).otherwise(0),
            "n_removed": F.when(F.col(places).isNotNull(), F.size(places)).otherwise(0),
            "text": F.when(F.col(places).isNotNull(), left).otherwise(text),
        })
        .drop(its_doc, its_digest, places)
    )
