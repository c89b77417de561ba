"""Embedding whitening: float32 eigenvectors of a distributed covariance, refined in double precision.

A vector is taken to a grid, ``floor(scale * c) + shift`` per entry, and the model is fitted on the
distinct grid vectors. Sums, covariance and its check are three passes of numpy over Arrow batches;
a task sends one matrix of the size of the covariance, whatever it has read. Sums are exact
integers, and entries are centred before they are multiplied, so a large ``shift`` costs no digits.

The driver holds the covariance alone. Its eigenvectors come from a float32 solver and are corrected
by the iteration of Ogita and Aishima: matrix products in double precision measure how far the
columns are from orthonormal and the products from diagonal, and one more product corrects both, with
quadratic convergence. Eigenvalues closer to each other than what is still off the diagonal say
nothing about their vectors; such a cluster is solved on its own, in float32 again, with its mean taken off
the matrix, so that the few digits of float32 go to the differences inside it.

Rows: a vector that is NULL or holds a NULL, NaN or infinite entry is dropped. Vectors of different
lengths have a model each; an empty vector has no components and gives no row. Entries beyond
2^52 on the grid count as 2^52. Repeated rows, and a NULL id, give their rows each; in the fit a repeated
vector counts once. A component without variance (also where all vectors are equal) has ``whitened`` NULL
and does not count in ``identity_error``; ``explained`` and ``identity_error`` are NULL where
nothing varies, ``deviation`` where it does not fit a long. Components of equal eigenvalues are any
orthonormal basis of theirs, the same for all rows. An empty table gives an empty result. Only the
two named columns are read, so extra columns may have any name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
LIMIT = float(1 << 52)
HALF = 26
OUT = (
    "vec_id {id}, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def grid(vector: Column, scale: int = SCALE, shift: int = SHIFT) -> Column:
    """The entries of a vector on the integer grid; NULL for a vector that is dropped."""
    entries = vector.cast("array<double>")
    sound = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    onto = F.transform(entries, lambda c: F.floor(F.least(F.greatest(c * scale, F.lit(-LIMIT)), F.lit(LIMIT))) + shift)
    return F.when(vector.isNotNull() & sound, onto)


# --- eigenvectors, on the driver ---------------------------------------------------------


def _single(matrix: np.ndarray) -> np.ndarray:
    """Eigenvectors of a symmetric matrix by the float32 solver."""
    top = np.abs(matrix).max()
    return np.linalg.eigh((matrix / (top or 1.0)).astype(np.float32))[1].astype(np.float64)


def _clusters(values: np.ndarray, width: float) -> list[np.ndarray]:
    """Runs of more than one eigenvalue, neighbours at most ``width`` apart."""
    order = np.argsort(values, kind="stable")
    runs = np.split(order, np.flatnonzero(np.diff(values[order]) > width) + 1)
    return [run for run in runs if len(run) > 1]


def refined_eigenvectors(matrix: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, largest first, and unit eigenvectors (columns) of a symmetric matrix.

    ``rounds`` bounds the iteration, which ends by itself once a correction is down to rounding.
    """
    size, scale = len(matrix), np.abs(matrix).max(initial=0.0)
    if scale == 0:
        return np.zeros(size), np.eye(size)
    a = matrix / scale
    a = (a + a.T) / 2
    norm, rounding = np.linalg.norm(a, 2), size * np.finfo(np.float64).eps
    x, last = _single(a), np.inf
    for _ in range(rounds):
        gram_off = np.eye(size) - x.T @ x
        product = x.T @ a @ x
        values = np.diag(product) / (1 - np.diag(gram_off))
        off = product - np.diag(np.diag(product))
        width = 2 * (np.linalg.norm(off, 2) + norm * np.linalg.norm(gram_off, 2))
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > width
        correction = np.where(
            apart, (product + values[None, :] * gram_off) / np.where(apart, gap, 1.0), gram_off / 2
        )
        np.fill_diagonal(correction, np.diag(gram_off) / 2)
        x = x + x @ correction
        solved = False
        for run in _clusters(values, width):
            part = x[:, run]
            inner = part.T @ (a @ part - values[run].mean() * part)
            inner = (inner + inner.T) / 2
            # a cluster as narrow as rounding has no directions of its own
            if np.abs(inner).max() > rounding * norm:
                x[:, run], solved = part @ _single(inner), True
        step = np.abs(correction).max()
        if not solved and (step <= rounding or (step >= last / 2 and last <= 1e-10)):
            break
        last = step
    x = x + x @ (np.eye(size) - x.T @ x) / 2
    x /= np.linalg.norm(x, axis=0)
    values = np.einsum("ij,ij->j", x, a @ x) * scale
    order = np.argsort(-values, kind="stable")
    return values[order], x[:, order]


# --- the fit -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """What one length of vectors was fitted to. ``low`` is the rounded-down mean, ``rest = S - n * low``."""

    n: int
    low: np.ndarray
    rest: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None = None

    @property
    def live(self) -> np.ndarray:
        """Which components have variance beyond rounding."""
        size = len(self.low)
        return self.values > size * np.finfo(np.float64).eps * max(self.values.max(initial=0.0), 0.0)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Rows of grid vectors projected on the components; NaN where a component has no variance."""
        root = np.sqrt(np.where(self.live, self.values, np.nan))
        return centred(x, self.n, self.low, self.rest) @ self.vectors / root

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """``sum((n * x - S) ** 2)`` of each row, exactly; None beyond a long."""
        off = x - self.low
        reach = float(np.abs(off).max(initial=0)) * self.n + self.n
        if reach * reach * max(1, x.shape[1]) < 2.0**62:
            return ((off * self.n - self.rest) ** 2).sum(axis=1).tolist()
        exact = off.astype(object) * self.n - self.rest.astype(object)
        return [s if s < 1 << 63 else None for s in map(int, (exact**2).sum(axis=1))]


def centred(x: np.ndarray, n: int, low: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """``x - S / n``: the whole numbers are taken off first, exactly."""
    return (x - low).astype(np.float64) - rest / n


def _rows(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    flat = column.flatten() if isinstance(column, pa.Array) else column.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, size)


def _sums(points: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Per length: the number of rows and the exact sum of each entry.

    Entries are added as two halves, so that neither sum leaves a long within a task.
    """

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes).tolist():
                x = _rows(batch.column("x").filter(pa.array(sizes == size)), size)
                n, high, low = held.setdefault(size, [0, 0, 0])
                held[size] = [n + len(x), high + (x >> HALF).sum(axis=0), low + (x & ((1 << HALF) - 1)).sum(axis=0)]
        for size, (n, high, low) in held.items():
            every = np.full(size, size, np.int64), np.arange(size), np.full(size, n, np.int64), high, low
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in every], ["size", "i", "n", "high", "low"])

    partial = points.mapInArrow(added, "size long, i long, n long, high long, low long")
    exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "high", "low")]
    out: dict[int, tuple[int, list[int]]] = {}
    # as many rows as vectors have entries
    for row in partial.groupBy("size", "i").agg(*exact).orderBy("size", "i").collect():
        n, sums = out.get(row.size, (int(row.n), []))
        out[row.size] = n, [*sums, (int(row.high) << HALF) + int(row.low)]
    return out


def _moment(points: DataFrame, size: int, project: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """The sum over all rows of the outer product of ``project(row)`` with itself."""

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            y = project(_rows(batch.column("x"), size))
            total += y.T @ y
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width)), pa.array(list(total), pa.list_(pa.float64()))], ["i", "line"]
        )

    def summed(lines: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": lines["i"][:1], "line": [np.sum(np.stack(lines["line"].to_list()), axis=0)]})

    partial = points.mapInArrow(multiplied, "i long, line array<double>")
    total = np.zeros((width, width))
    for row in partial.groupBy("i").applyInPandas(summed, "i long, line array<double>").collect():
        total[row.i] = row.line
    return total


def fit(points: DataFrame, components: int = COMPONENTS) -> dict[int, Model]:
    """A model per length of ``points(size, x)``, each distinct vector counted once."""
    distinct = stored(points.distinct(), "grid")
    models = {}
    for size, (n, sums) in _sums(distinct).items():
        low = np.array([s // n for s in sums], np.int64)
        rest = np.array([s % n for s in sums], np.int64)
        same = distinct.where(F.col("size") == size)
        covariance = _moment(same, size, lambda x, n=n, low=low, rest=rest: centred(x, n, low, rest), size) / n
        values, vectors = refined_eigenvectors(covariance)
        kept = values[:components], vectors[:, :components]
        model = Model(n, low, rest, *kept, float(np.trace(covariance)))
        live = np.flatnonzero(model.live)
        if len(live):
            moment = _moment(same, size, lambda x, m=model, k=live: m.whitened(x)[:, k], len(live))
            error = float(np.abs(moment / n - np.eye(len(live))).max())
            model = Model(n, low, rest, *kept, model.trace, error)
        models[size] = model
    return models


def whitened(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
    components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT,
) -> DataFrame:
    """A row per vector and component: the whitened coordinate, and how good the model is."""
    onto = vectors.select(F.col(id_col).alias("vec_id"), grid(F.col(vector_col), scale, shift).alias("x"))
    onto = onto.where(F.size("x") > 0).withColumn("size", F.size("x").cast("long"))
    schema = OUT.format(id=onto.schema["vec_id"].dataType.simpleString())
    models = fit(onto.select("size", "x"), components)

    def of(size: int, model: Model) -> DataFrame:
        def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            k = len(model.values)
            share = [v / model.trace if model.trace > 0 else None for v in model.values.tolist()]
            for batch in batches:
                x = _rows(batch.column("x"), size)
                repeat = np.repeat(np.arange(len(x)), k)
                deviation = pa.array(model.deviation(x), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(pa.array(repeat)),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(repeat), model.n, np.int64)),
                        deviation.take(pa.array(repeat)),
                        pa.array(model.whitened(x).ravel(), pa.float64(), from_pandas=True),
                        pa.array(share * len(x), pa.float64()),
                        pa.array([model.identity_error] * len(repeat), pa.float64()),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

        return onto.where(F.col("size") == size).select("vec_id", "x").mapInArrow(projected, schema)

    parts = [of(size, model) for size, model in models.items()]
    return reduce(DataFrame.unionByName, parts) if parts else vectors.sparkSession.createDataFrame([], schema)
