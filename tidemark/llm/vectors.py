"""Near-duplicate vectors by product quantisation.

Vectors are compared inside their label only, by cosine, with a threshold. A bounded sample
fits the index: coarse centroids and, for the residuals, one small codebook per subspace. Every
vector is then put on the inverted list of its nearest centroid with its residual's codes and
the error they leave, and as a query it visits every list that can hold a neighbour: for unit
vectors within distance r, a list is out of reach only if the plane between its centroid and the
query's own is further than r away. On a list, the codes give the distance of a query to each coded
vector, as products in single precision whose rounding is allowed for; a vector is passed on if that
distance less its own coding error is within r, and its exact cosine decides. Both bounds are those of
the triangle inequality, so no link is lost.

Equal vectors of a label are one class and searched once. A label of more than a block of vectors
(``BLOCK_BYTES``) is dealt: lists whose centroids lie together form a cell, and the vectors of a cell
go to blocks. A vector is sent to the pairs of its own block with the blocks of the cells that it
visits, so its copies number the blocks of its label at most. Two vectors within r visit each other's
list, so a unit (block against block) asks the vectors of one for those of the other, and a link counts
for both. A unit returns one row per vector, with its number of links and its tree in the unit, never
the pairs, and holds a bounded number of pairs at a time.

Rows: a vector that is NULL, zero, or has a NULL or non-finite component, a NULL label or a
NULL id links with nothing. Vectors of different lengths do not link. The ``MAX_DIMS`` most frequent lengths
have an index each; vectors of any other length are on one list of their length and compared exactly. Rows that share a vec_id
are one node for components. Repeated rows are vectors like others and link with each other. An
empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Forest, components, in_parts, stored

SUBSPACES, CODES = 8, 64
MAX_DIMS = 64
#: Vectors whose distances to all centroids are held at once.
PIECE = 1024
#: Bytes of the vectors of a block, in double precision.
BLOCK_BYTES = 1 << 24
#: Coded vectors and queries whose distances are held at once.
LISTED, ASKED = 512, 4096
#: Rows of labels of one block that a task takes, about; the tasks of a search.
SMALL_ROWS, MAX_TASKS = 4096, 20_000
#: Bytes of the vectors that are gathered for exact comparison at once.
PAIR_BYTES = 1 << 25
PLACED = (
    "cid long, label int, dim int, copies long, dealt boolean, raw binary, list int, codes binary, error double, "
    "cell int, cells array<int>"
)


@dataclass(frozen=True)
class Index:
    """``centroids`` (lists, dim); ``groups``: the cell of each list; ``books``: per subspace its
    columns and (CODES, width) codewords."""

    centroids: np.ndarray
    groups: np.ndarray
    books: list[tuple[slice, np.ndarray]]

    @cached_property
    def apart(self) -> np.ndarray:
        """The distance between each two centroids; row by row, since all differences at once are lists x lists x dim."""
        c = self.centroids
        return np.sqrt(np.maximum(np.stack([((c - one) ** 2).sum(axis=1) for one in c]), 1e-24))


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows at length one; scaled first, so neither tiny nor huge components break the norm."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    centers = x[rng.choice(len(x), size=min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = ((centers * centers).sum(axis=1) - 2 * x @ centers.T).argmin(axis=1)
        count = np.bincount(near, minlength=len(centers))
        total = np.zeros_like(centers)
        np.add.at(total, near, x)
        used = count > 0
        centers[used] = total[used] / count[used, None]
    return centers


def fit(sample: np.ndarray, lists: int, cells: int = 1, seed: int = 11) -> Index:
    """Coarse centroids in about ``cells`` cells, then codebooks of the residuals."""
    rng = np.random.default_rng(seed)
    x = _unit(sample)
    centroids = _kmeans(x, lists, rng)
    home = ((centroids * centroids).sum(axis=1) - 2 * x @ centroids.T).argmin(axis=1)
    rest = x - centroids[home]
    cuts = np.linspace(0, x.shape[1], min(SUBSPACES, x.shape[1]) + 1).astype(int)
    parts = [slice(a, b) for a, b in zip(cuts, cuts[1:], strict=False)]
    heads = _kmeans(centroids, cells, rng)
    groups = ((heads * heads).sum(axis=1) - 2 * centroids @ heads.T).argmin(axis=1)
    return Index(centroids, groups, [(p, _kmeans(np.ascontiguousarray(rest[:, p]), CODES, rng)) for p in parts])


def one_list(dim: int) -> Index:
    """The index of a length that none is fitted for: one list, no codes, so the exact cosine decides alone."""
    return Index(np.zeros((1, dim)), np.zeros(1, int), [])


def _encode(index: Index, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of residuals and the length of what the codes miss."""
    if not index.books:
        return np.zeros((len(rest), 0), int), np.sqrt((rest * rest).sum(axis=1))
    codes, missed = [], np.zeros(len(rest))
    for part, book in index.books:
        sub = rest[:, part]
        code = ((book * book).sum(axis=1) - 2 * sub @ book.T).argmin(axis=1)
        codes.append(code)
        missed += ((sub - book[code]) ** 2).sum(axis=1)
    return np.stack(codes, axis=1), np.sqrt(missed)


def _probes(index: Index, x: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Home list of each row, and a mask of all lists that may hold something within ``reach``."""
    c = index.centroids
    far = np.maximum(0, 1 + (c * c).sum(axis=1) - 2 * x @ c.T)
    home = far.argmin(axis=1)
    plane = (far - far[np.arange(len(x)), home][:, None]) / (2 * index.apart[home])
    mask = plane <= reach + 1e-9
    mask[np.arange(len(x)), home] = True
    return home, mask


def _packed(x: np.ndarray) -> list[bytes]:
    """Each row in single precision if that loses nothing, else in double."""
    with np.errstate(over="ignore", under="ignore"):
        narrow = x.astype(np.float32)
    return [(n if same else row).tobytes() for n, row, same in zip(narrow, x, (narrow == x).all(axis=1), strict=True)]


def _unpacked(raw: pd.Series, dim: int) -> np.ndarray:
    """The rows of ``_packed`` at length one."""
    out, narrow = np.empty((len(raw), dim)), (raw.str.len() == 4 * dim).to_numpy()
    for kind, rows in ((np.float32, narrow), (np.float64, ~narrow)):
        if rows.any():
            out[rows] = np.frombuffer(b"".join(raw[rows]), dtype=kind).reshape(-1, dim)
    return _unit(out)


def _search_unit(index: Index, listed: pd.DataFrame, asked: pd.DataFrame, threshold: float, reach: float):
    """Links of one unit: per row its weighted count, and its tree in the unit. A block with itself: ``asked is listed``."""
    alone, dim = asked is listed, index.centroids.shape[1]
    listed = listed.sort_values("list", kind="stable")
    lists, there, here = listed["list"].to_numpy(), listed["cid"].to_numpy(), asked["cid"].to_numpy()
    ux, uq = _unpacked(listed["raw"], dim), _unpacked(asked["raw"], dim)
    coded = index.centroids[lists]
    if index.books:
        codes = np.frombuffer(b"".join(listed["codes"]), dtype=np.uint8).reshape(len(listed), len(index.books))
        for m, (part, book) in enumerate(index.books):
            coded[:, part] += book[codes[:, m]]
    # a coded vector is near enough if its product with the query is at least this, less what single precision may lose
    square = (coded * coded).sum(axis=1)
    lost = (dim + 8) * np.finfo(np.float32).eps * np.sqrt(square) + 1e-6
    least = ((1 + square - (reach + listed["error"].to_numpy() + 1e-9) ** 2) / 2 - lost).astype(np.float32)
    coded, query = coded.astype(np.float32), uq.astype(np.float32)
    mask = np.concatenate([_probes(index, uq[k : k + PIECE], reach)[1] for k in range(0, len(uq), PIECE)])
    nodes = np.unique(np.concatenate([there, here]))
    at_x, at_q = np.searchsorted(nodes, there), np.searchsorted(nodes, here)
    forest, pairs = Forest(len(nodes)), max(1, PAIR_BYTES // (8 * dim))
    of_x, of_q = listed["copies"].to_numpy(), asked["copies"].to_numpy()
    count_x, count_q = np.zeros(len(there), dtype=np.int64), np.zeros(len(here), dtype=np.int64)
    for first in range(0, len(lists), LISTED):
        band = slice(first, first + LISTED)
        who = np.flatnonzero(mask[:, np.unique(lists[band])].any(axis=1))
        for some in (who[k : k + ASKED] for k in range(0, len(who), ASKED)):
            passed = coded[band] @ query[some].T >= least[band, None]
            found = np.flatnonzero(passed)
            col, row = np.divmod(found, len(some))
            if len(found) * 16 > passed.size:
                near = (ux[band] @ uq[some].T).ravel()[found] >= threshold
            else:
                cuts = [slice(k, k + pairs) for k in range(0, len(found), pairs)]
                parts = [np.einsum("ij,ij->i", uq[some[row[k]]], ux[first + col[k]]) >= threshold for k in cuts]
                near = np.concatenate([np.zeros(0, dtype=bool), *parts])
            col, row = first + col, some[row]
            near |= (here[row] == there[col]) & mask[row, lists[col]]
            if near.any():
                col, row = col[near], row[near]
                count_q += np.bincount(row, weights=of_x[col], minlength=len(here)).astype(np.int64)
                if not alone:
                    count_x += np.bincount(col, weights=of_q[row], minlength=len(there)).astype(np.int64)
                forest.link(at_x[col], at_q[row])
    trees = pd.DataFrame({"cid": nodes, "links": np.int64(0), "root": nodes[forest.label]})
    counts = [pd.DataFrame({"cid": ids, "links": n, "root": ids}) for ids, n in ((here, count_q), (there, count_x))]
    return [trees[trees["cid"] != trees["root"]], *(part[part["links"] > 0] for part in counts)]


def _search(rows: pd.DataFrame, indexes: dict[int, Index], threshold: float, reach: float) -> pd.DataFrame:
    out = [pd.DataFrame({"cid": np.zeros(0, np.int64), "links": np.zeros(0, np.int64), "root": np.zeros(0, np.int64)})]
    for (_, dim, i, j), unit in rows.groupby(["label", "dim", "i", "j"], sort=False):
        index = indexes.get(dim) or one_list(dim)
        listed = unit if i == j else unit[unit["own"] == i]
        asked = unit if i == j else unit[unit["own"] == j]
        if len(listed) and len(asked):
            out += _search_unit(index, listed, asked, threshold, reach)
    return pd.concat(out, ignore_index=True)


def block_rows(dim: int) -> int:
    return max(1, BLOCK_BYTES // (8 * dim))


def links(classes: DataFrame, indexes: dict[int, Index], threshold: float = 0.98, block: int | None = None) -> DataFrame:
    """``(cid, links, root)`` rows from every unit: partial counts, and edges to trees.

    ``indexes``: the index of each length of vectors; a length that is not there has ``one_list``.
    ``block``: the vectors of a block, if not ``block_rows`` of their length.
    """
    reach = math.sqrt(max(0.0, 2 - 2 * threshold))
    key = ["label", "dim"]
    hold = F.lit(block) if block else F.greatest(F.lit(1), F.floor(F.lit(BLOCK_BYTES) / (8 * F.col("dim"))))

    def place(batches):
        pieces = (whole.iloc[k : k + PIECE] for whole in batches for k in range(0, len(whole), PIECE))
        for dim, pdf in (alike for piece in pieces for alike in piece.groupby("dim", sort=False)):
            index = indexes.get(dim) or one_list(dim)
            raw = np.stack(pdf["vec"].to_numpy())
            x = _unit(raw)
            home, mask = _probes(index, x, reach)
            codes, error = _encode(index, x - index.centroids[home])
            cells = [np.unique(index.groups[visited]).astype(np.int32) for visited in mask]
            yield pdf.drop(columns="vec").assign(
                raw=_packed(raw), list=home, codes=[row.tobytes() for row in codes.astype(np.uint8)],
                error=error, cell=index.groups[home], cells=cells,
            )

    large = classes.groupBy(*key).count().where(F.col("count") > hold).select(*key, F.lit(True).alias("dealt"))
    told = classes.join(stored(large, "labels"), key, "left").select(
        "cid", *key, "copies", F.col("dealt").isNotNull().alias("dealt"), "vec"
    )
    placed = stored(told.mapInPandas(place, PLACED), "lists")
    sizes = placed.where("dealt").groupBy(*key, "cell").count().select(*key, "cell", F.ceil(F.col("count") / hold).alias("n"))
    blocks = stored(sizes.groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("cell", "n"))).alias("blocks")), "blocks")
    of_label = F.aggregate(F.map_values("blocks"), F.lit(0).cast("long"), lambda a, n: a + n)
    units = blocks.select(of_label.alias("n")).agg(F.sum(F.col("n") * (F.col("n") + 1) / 2)).first()[0] or 0
    small = placed.where("NOT dealt").count()

    def numbers(cell):
        """The numbers of the blocks of a cell."""
        return F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks")[cell] - 1), lambda k: cell.cast("long") * (1 << 32) + k)

    home = numbers(F.col("cell"))
    own = home[F.pmod(F.xxhash64("cid", "raw"), F.size(home)).cast("int")]
    there = F.flatten(F.transform(F.array_intersect("cells", F.map_keys("blocks")), numbers))
    first = F.lit(0).cast("long")
    dealt = (
        placed.join(blocks, key, "left")
        .withColumn("own", F.when(F.col("dealt"), own).otherwise(first))
        .withColumn("other", F.explode(F.when(F.col("dealt"), there).otherwise(F.array(first))))
        .withColumn("i", F.least("own", "other"))
        .withColumn("j", F.greatest("own", "other"))
        .withColumn("part", F.when(F.col("dealt"), F.xxhash64(*key, "i", "j")).otherwise(in_parts(key, small, SMALL_ROWS)))
        .drop("dealt", "cell", "cells", "blocks", "other")
    )
    tasks = int(units) + -(-small // SMALL_ROWS)
    return dealt.repartition(max(1, min(tasks, MAX_TASKS)), "part").groupBy("part").applyInPandas(
        lambda rows: _search(rows, indexes, threshold, reach), "cid long, links long, root long"
    )


def near_duplicates(embeddings: DataFrame, threshold: float = 0.98, fit_rows: int = 8192, lists: int | None = None) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``embeddings(vec_id, embedding, label)``.

    ``fit_rows`` bounds the sample that fits the index; every row is indexed.
    """
    spark = embeddings.sparkSession
    vec = F.col("embedding").cast("array<double>")
    finite = F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & finite & F.exists(vec, lambda v: v != 0)
    rows = embeddings.select(
        "vec_id", F.col("label").cast("int").alias("label"), vec.alias("vec"), F.coalesce(usable, F.lit(False)).alias("usable")
    )
    good = rows.where("usable").withColumn("vec", F.transform("vec", lambda v: v + 0.0))
    grouped = good.groupBy("label", "vec").agg(F.min("vec_id").alias("cid"), F.count("*").alias("copies"))
    classes = stored(grouped.select("cid", "label", F.size("vec").alias("dim"), "vec", "copies"), "classes")
    sizes = classes.groupBy("label", "dim").count().groupBy("dim").agg(F.sum("count").alias("count"), F.max("count").alias("most"))
    sizes = sizes.orderBy(F.desc("count"), "dim").limit(MAX_DIMS + 1).collect()
    parts = []
    for dim, count, most in sizes[:MAX_DIMS]:
        alike = classes.where(F.col("dim") == dim)
        # of a large table first a share by digest, else every task would send that many whole vectors to the driver
        share = 1.25 * fit_rows / count
        some = alike.where(F.xxhash64("vec", "label") < int((share - 0.5) * 2**64)) if share < 0.5 and fit_rows >= 1024 else alike
        sample = some.orderBy(F.xxhash64("cid", "label"), "cid").limit(fit_rows).select("vec").toPandas()
        wanted = lists or int(min(1024, max(8, math.sqrt(count) / 4)))
        index = fit(np.stack(sample["vec"].to_numpy()), wanted, -(-most // block_rows(dim)))
        parts.append(links(alike, {dim: index}, threshold))
    if len(sizes) > MAX_DIMS:
        parts.append(links(classes.where(~F.col("dim").isin([dim for dim, *_ in sizes[:MAX_DIMS]])), {}, threshold))
    found = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], "cid long, links long, root long")
    found = stored(found, "links")
    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = components(found.where("cid <> root").select(F.col("cid").alias("a"), F.col("root").alias("b")))
    named = (
        classes.join(counts, "cid", "left").join(roots.withColumnRenamed("node", "cid"), "cid", "left")
        .select("label", "vec", F.col("links"), F.coalesce("root", "cid").alias("component_id"))
    )
    linked = good.select("vec_id", "label", "vec").join(named, ["label", "vec"], "left").select(
        "vec_id", F.coalesce(F.col("links") - 1, F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    )
    alone = rows.where(~F.col("usable")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
